"""Reference-shaped text inputs written from the driver tables and read
back through the fixed-schema readers."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.plans import jobs
from tidemark.sources import driver_tables as dt
from tidemark.sources.readers import parse_access_log, read_records, with_event_time
from tidemark.streaming import runner


def test_user_behavior_csv_roundtrip(spark, tmp_path):
    v = dt.item_views(spark, SF_SMALL).withColumn("category_id", F.lit(1)).withColumn(
        "ts_s", F.unix_seconds(F.col("ts").cast("timestamp")))
    path = str(tmp_path / "ub")
    v.orderBy("seq").select("user_id", "item_id", "category_id", "behavior", "ts_s").coalesce(1).write.csv(path)
    back = with_event_time(read_records(spark, "user_behavior", path).coalesce(1))
    want = jobs.hot_items(v.withColumn("ts", F.timestamp_seconds("ts_s")), "1 day", "6 hours")
    got = jobs.hot_items(back, "1 day", "6 hours")
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_strict_scan_rejects_bad_lines(spark, tmp_path):
    p = str(tmp_path / "bad.csv")
    with open(p, "w") as f:
        f.write("1,ip,fail,100\nx,ip,fail,notanumber\n")
    import pytest
    with pytest.raises(Exception):
        read_records(spark, "login", p, strict=True).collect()
    assert read_records(spark, "login", p, strict=False).where("user_id IS NULL").count() == 1


def test_access_log_text(spark, tmp_path):
    path = str(tmp_path / "log")
    os.makedirs(path)
    with open(os.path.join(path, "a.log"), "w") as f:
        f.write("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/images/kibana-search.png\n")
        f.write("83.149.9.216 - - 17/05/2015:10:05:43 +0000 GET /presentations/logstash-monitorama-2013/images/kibana-dashboard3.png\n")
    r = parse_access_log(spark.read.text(path)).collect()
    assert [x.method for x in r] == ["GET", "GET"]
    assert str(r[0].event_time) == "2015-05-17 10:05:03"


def test_channel_promotion_stream_event_time(spark):
    m = dt.market_rows(spark, SF_SMALL)
    root = runner.write_replay_files(m, 3, {"user_id": -1, "behavior": "~", "channel": -1, "seq": -1})
    s = runner.read_replay(spark, root, m.schema)
    got = runner.run_to_memory(jobs.channel_promotion_stream(s, "1 day", "6 hours", processing_time=False),
                               "t_chan").where("channel >= 0")
    want = jobs.channel_promotion(m, "1 day", "6 hours")
    got = got.select("channel", "behavior", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_file_order_over_split_files(spark, tmp_path):
    """Rows number in the order of file names and lines, whatever order the listing or the splits have."""
    want = []
    for name, n in (("b.csv", 3000), ("a.csv", 5000), ("c/0.csv", 10), ("d x.csv", 2000)):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"{i},{name},fail,{i}\n" for i in range(n)))
        want += [(name, i) for i in range(n)]
    want.sort()
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        df = read_records(spark, "login", [str(tmp_path / "in" / p) for p in ("d x.csv", "b.csv", "c", "a.csv")], seq="seq")
        assert df.rdd.getNumPartitions() > 5
        got = [(r["ip"], r["user_id"]) for r in df.orderBy("seq").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want and len({r["seq"] for r in df.collect()}) == len(want)


def test_split_malformed(spark):
    from tidemark.sources.readers import split_malformed
    lines = ["1,create,,100", "2,pay,tx,200", "x,pay,tx,1", "3,pay,tx", "4,pay,tx,1,2", "", None, ",pay,tx,5", "5,pay,tx,", "a"]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    good, bad = split_malformed(df, "order")
    assert [tuple(r) for r in good.orderBy("n").collect()] == [(0, 1, "create", "", 100), (1, 2, "pay", "tx", 200)]
    assert [(r["n"], r["value"]) for r in bad.orderBy("n").collect()] == list(enumerate(lines))[2:]
    good, bad = split_malformed(df.where("false"), "order")
    assert good.count() == bad.count() == 0
