"""End-to-end jobs on the reference samples: batch and streaming agree."""

from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.streaming import runner, windows as sw
from tidemark.streaming.upserts import UpsertTable


def test_ad_clicks_job_batch_and_stream(spark, ref):
    ad = ref["ad_click"]
    counts, warns = jobs.ad_clicks(ad, cap=100)
    assert counts.count() == 5988 and warns.count() == 1
    # streaming == batch, on 1 h / 1 min windows (a 720-way window
    # expansion is re-compiled by Spark in every micro-batch)
    counts, _ = jobs.ad_clicks(ad, cap=100, slide="1 minute")
    root = runner.write_replay_files(ad, 3, {"user_id": -1, "ad_id": -1, "province": "~", "city": "", "ts_s": 0, "seq": -1})
    s = runner.read_replay(spark, root, ad.schema)
    want = counts.select("province", F.col("window_end").cast("timestamp").alias("window_end"), "cnt")
    for salts in (1, 3):        # the cap of a key whole, and in parts first
        sc, sw_ = jobs.ad_clicks_stream(s, cap=100, slide="1 minute", salts=salts)
        got = runner.run_to_memory(sc, f"j_adc{salts}").where("province <> '~'")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_order_and_login_jobs(ref):
    r = jobs.order_timeout(ref["order"], "15 minutes", "pattern")
    assert r.where("matched").count() == 37 and r.where("NOT matched").count() == 2
    assert jobs.login_risk(ref["login"], "bursts", horizon="5 seconds").count() == 1
    assert jobs.login_risk(ref["login"], "pairs", within="2 seconds").count() == 3
    assert jobs.reconcile(ref["order"], ref["receipt"]).count() == 74


def test_tagged_fanout(spark, ref, tmp_path):
    tagged = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "tag string, v int")
    runner.write_tagged(tagged, 0, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1


def test_hot_urls_late_table(spark):
    from tests.conftest import SF_SMALL
    from tidemark.sources import driver_tables as dt
    hits = dt.access_hits(spark, SF_SMALL)
    hits = hits.withColumn("arrival", F.col("event_time") + F.make_dt_interval(
        secs=((F.col("seq") * 7919) % 7200).cast("decimal(18,6)")))
    top, late_rows = jobs.hot_urls(hits, "10 minutes", "10 minutes", 5, "10 minutes", "60 minutes", "arrival")
    assert top.count() > 0
    # with tumbling windows every GET row is counted in its window or is in the late table
    every, _ = jobs.hot_urls(hits, "10 minutes", "10 minutes", 1_000_000, "10 minutes", "60 minutes", "arrival")
    counted = every.agg({"cnt": "sum"}).first()[0]
    assert late_rows.count() > 0
    assert counted + late_rows.count() == hits.where("method = 'GET'").count()
    assert set(late_rows.columns) >= {"url", "ts", "arrival", "is_late"}


def test_daily_cap_keeps_rows_without_key_or_time(spark):
    from tidemark.operators import caps
    rows = [(None, 0.0, 1), (1, None, 2), (1, 5.0, 3)]
    df = spark.createDataFrame(rows, "user_id bigint, s double, seq bigint").selectExpr(
        "user_id", "timestamp_seconds(s) AS ts", "seq")
    assert caps.daily_cap(df, "user_id", cap=10).count() == 3



def test_hot_urls_stream_job_update_mode(spark, tmp_path):
    """Update mode with a fan-out above the pane threshold (24 windows per
    row) must use a single aggregation; the upserted top-N equals batch."""
    from tests.conftest import SF_SMALL
    from tidemark.sources import driver_tables as dt
    hits = dt.access_hits(spark, SF_SMALL)
    root = runner.write_replay_files(hits.withColumnRenamed("event_time", "ts"), 3,
                                     {"ip": "", "user": "", "method": "GET", "url": "~", "seq": -1})
    s = runner.read_replay(spark, root, hits.withColumnRenamed("event_time", "ts").schema)
    counts = jobs.hot_urls_stream_counts(s, "1 day", "1 hour", "0 seconds", "0 seconds").where("url <> '~'")
    cpath, tpath = str(tmp_path / "c"), str(tmp_path / "t")
    q = (counts.writeStream.outputMode("update")
         .foreachBatch(lambda b, i: sw.upsert_topn(b.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")),
                                                   i, cpath, tpath, "url", 5))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = UpsertTable(spark, tpath, ("window_end",)).read().select("window_end", "rank", "url", "cnt")
    want, _ = jobs.hot_urls(hits, "1 day", "1 hour", 5)
    want = want.select("window_end", "rank", "url", "cnt")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_wrappers(spark, ref):
    from tests.conftest import SF_SMALL, topn_rows
    from tidemark.sources import driver_tables as dt
    # hot items at the reference's 1 h / 5 min: pane count -> window sum -> top-N, all append mode
    v = dt.item_views(spark, SF_SMALL)
    root = runner.write_replay_files(v, 3, {"user_id": -1, "item_id": -1, "behavior": "pv", "seq": -1})
    got = topn_rows(jobs.hot_items_stream(runner.read_replay(spark, root, v.schema)), "item_id").where(
        "item_id >= 0").select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "rank", "item_id", "cnt")
    want = jobs.hot_items(v).select("window_end", "rank", "item_id", "cnt")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # login risk and reconciliation wrappers on the sample inputs
    lg = ref["login"]
    sent = {"user_id": -1, "ip": "", "event_type": "success", "ts_s": 0, "seq": -1}
    for method, expected in [("bursts", 1), ("pairs", 3), ("consecutive", 3)]:
        r = runner.write_replay_files(lg, 3, sent)
        out = runner.run_to_memory(jobs.login_risk_stream(runner.read_replay(spark, r, lg.schema), method,
                                                          within="2 seconds", horizon="5 seconds", n=2),
                                   f"j_lr_{method}").where("user_id >= 0")
        assert out.count() == expected, method
    o, rc = ref["order"], ref["receipt"]
    ro = runner.write_replay_files(o, 2, {"order_id": -1, "event_type": "pay", "tx_id": "~", "ts_s": 0, "seq": -1})
    rr = runner.write_replay_files(rc, 2, {"tx_id": "~~", "pay_channel": "", "ts_s": 0, "seq": -1})
    rec = runner.run_to_memory(jobs.reconcile_stream(runner.read_replay(spark, ro, o.schema),
                                                     runner.read_replay(spark, rr, rc.schema)), "j_rec")
    rec = rec.where("coalesce(o_seq, 0) >= 0 AND coalesce(r_seq, 0) >= 0")
    assert rec.where("tag = 'matched'").count() == 5 and rec.count() == 74


def test_page_views_and_visitors(spark):
    from tests.conftest import SF_SMALL
    from tidemark.sources import driver_tables as dt
    v = dt.item_views(spark, SF_SMALL)
    plain = jobs.page_views(v)
    assert plain.agg({"pv": "sum"}).first()[0] == v.where("behavior = 'pv'").count()
    assert plain.exceptAll(jobs.page_views(v, salted=True)).count() == 0
    e = dt.events(spark, SF_SMALL).select("user_id", "ts", F.col("event_id").alias("seq"))
    exact = jobs.unique_visitors(e)
    last = jobs.unique_visitors(e, method="running").groupBy("window_end").agg(F.max("uv").alias("uv"))
    assert exact.count() > 0 and exact.exceptAll(last).count() == 0
    near = exact.join(jobs.unique_visitors(e, method="hll").withColumnRenamed("uv", "h"), "window_end")
    assert near.count() == exact.count() and near.where("abs(uv - h) > 1 + 0.05 * uv").count() == 0
    root = runner.write_replay_files(e, 3, {"user_id": -1, "seq": -1})
    for method in ("exact", "bitmap"):
        s = runner.read_replay(spark, root, e.schema)
        got = runner.run_to_memory(jobs.unique_visitors_stream(s, method=method), f"j_uv_{method}")
        got = got.where("year(window_end) < 2100").select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "uv")
        want = jobs.unique_visitors(e, method=method)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_topn_sink_ranks_a_window_of_many_keys(spark, tmp_path):
    n = 100_000
    counts = spark.range(n).selectExpr("timestamp_seconds(3600) AS window_end", "id AS item_id", "id * 7919 % 1000 AS cnt")
    sw.topn_sink(counts, 0, str(tmp_path / "top"), "item_id", 3)
    sw.topn_sink(counts, 0, str(tmp_path / "top"), "item_id", 3)     # a replayed batch replaces its rows
    got = spark.read.parquet(str(tmp_path / "top")).orderBy("rank").collect()
    best = sorted(((i * 7919) % 1000 * -1, i) for i in range(n))[:3]
    assert [(r["rank"], -r.cnt, r.item_id) for r in got] == [(k + 1, *b) for k, b in enumerate(best)]
