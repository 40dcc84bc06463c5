"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from tidemark.functions.time import (  # noqa: F401
    duration_us, interval, to_micros, from_micros, ts_type_of, java_ts_string,
    local_day, next_local_midnight,
)
from tidemark.functions.hashing import bitmap_offset, salt  # noqa: F401
from tidemark.functions.predicates import pin_filter  # noqa: F401
