"""Sources: fixed record schemas, reference-shaped CSV/text scans, and the
mapping of the driver's parquet tables onto those record shapes."""

from tidemark.sources import schemas  # noqa: F401
from tidemark.sources.readers import (  # noqa: F401
    read_records, read_stream_records, parse_access_log, with_event_time,
)
