import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session(master="local[8]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ref(spark):
    """The four sample inputs as typed DataFrames with ts and file-order seq."""
    from tidemark.sources.readers import read_records, with_event_time
    out = {}
    for kind, fname in [("ad_click", "ad_click_log.csv"), ("login", "login_log.csv"),
                        ("order", "order_log.csv"), ("receipt", "receipt_log.csv")]:
        df = read_records(spark, kind, os.path.join(DATA, fname)).coalesce(1)
        out[kind] = with_event_time(df).cache()
    return out


def topn_rows(counts, key, n=5):
    """Run finished counts (append mode) through the top-N sink; its rows as a batch DataFrame."""
    from tidemark.streaming import windows as sw
    root = tempfile.mkdtemp(prefix="tidemark-test-top-")
    out = os.path.join(root, "top")
    (counts.writeStream.outputMode("append").foreachBatch(lambda b, i: sw.topn_sink(b, i, out, key, n))
     .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start().awaitTermination())
    return counts.sparkSession.read.parquet(out).drop("batch")
