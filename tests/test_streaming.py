"""Streaming forms replayed from files (with sentinel flush) equal the
batch forms."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, topn_rows
from tidemark.operators import caps, distinct, joins, patterns, topn, windows
from tidemark.sources import driver_tables as dt
from tidemark.streaming import joins as sj, processors, runner, windows as sw
from tidemark.streaming.upserts import UpsertTable


def _ms(c):
    return (F.unix_micros(F.col(c).cast("timestamp")) / 1000).cast("bigint")


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _replay(spark, df, sentinel, n=4, delay="0 seconds"):
    root = runner.write_replay_files(df, n, sentinel)
    return sw.event_time(runner.read_replay(spark, root, df.schema), "ts", delay)


def test_order_timeout_stream(spark, ref):
    o = ref["order"]
    s = _replay(spark, o, {"order_id": -1, "event_type": "create", "tx_id": "", "ts_s": 0, "seq": -1})
    got = runner.run_to_memory(processors.order_timeout_stream(s, "15 minutes"), "t_ot").where("order_id >= 0")
    want = patterns.order_timeout_state(o, within="15 minutes")
    _same(got.select("order_id", "create_ms", "status"),
          want.select("order_id", _ms("create_ts").alias("create_ms"), "status"))


def test_fail_bursts_and_pairs_stream(spark, ref):
    lg = ref["login"]
    sent = {"user_id": -1, "ip": "", "event_type": "success", "ts_s": 0, "seq": -1}
    s = _replay(spark, lg, sent, delay="2 seconds")
    got = runner.run_to_memory(processors.fail_bursts_stream(s, "5 seconds"), "t_fb").where("user_id >= 0")
    want = patterns.login_fail_bursts(lg, horizon="5 seconds")
    _same(got, want.select("user_id", _ms("first_ts").alias("first_ms"), _ms("last_ts").alias("last_ms"), "n_fails"))
    s2 = _replay(spark, lg, sent)
    got2 = runner.run_to_memory(processors.fail_pairs_stream(s2, "2 seconds"), "t_fp").where("user_id >= 0")
    want2 = patterns.login_fail_pairs(lg, within="2 seconds")
    _same(got2, want2.select("user_id", _ms("first_ts").alias("first_ms"), _ms("last_ts").alias("last_ms")))


def test_daily_cap_then_province_stream(spark, ref):
    ad = ref["ad_click"]
    s = _replay(spark, ad, {"user_id": -1, "ad_id": -1, "province": "", "city": "", "ts_s": 0, "seq": -1})
    tagged = processors.daily_cap_stream(s, 100)
    got = runner.run_to_memory(tagged, "t_cap").where("user_id >= 0")
    assert got.where("tag = 'pass'").count() == 122
    w = got.where("tag = 'warning'").collect()
    assert [(r.user_id, r.ad_id, r.ts_ms // 1000) for r in w] == [(937166, 1715, 1511661700)]
    want = caps.daily_cap(ad, ["user_id", "ad_id"], "ts", "seq", 100)
    _same(got.where("tag = 'pass'").select("seq"), want.select("seq"))


def test_chained_topn_stream(spark):
    v = dt.item_views(spark, SF_SMALL).where("behavior = 'pv'")
    s = _replay(spark, v, {"user_id": -1, "item_id": -1, "behavior": "pv", "seq": -1}, n=5)
    counts = sw.sliding_count_stream(s, "item_id", "ts", "1 day", "6 hours")
    got = topn_rows(sw.finished_counts(counts, "item_id"), "item_id").where("item_id >= 0")
    want = topn.topn_per_window(windows.sliding_count(v, "item_id", "ts", "1 day", "6 hours"), "item_id", 5)
    _same(got.select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "rank", "item_id", "cnt"),
          want.select("window_end", "rank", "item_id", "cnt"))


def test_uv_stream(spark):
    e = dt.events(spark, SF_SMALL).select("user_id", "ts", F.col("event_id").alias("seq"))
    s = _replay(spark, e, {"user_id": -1, "seq": -1})
    got = runner.run_to_memory(sw.uv_stream(s, "user_id", "ts", "1 hour"), "t_uv")
    got = got.where(F.year("window_end") < 2100)
    want = distinct.uv_exact(e, "user_id", "ts", "1 hour")
    _same(got.select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "uv"), want)


def test_reconcile_stream(spark, ref):
    o, r = ref["order"], ref["receipt"]
    so = _replay(spark, o, {"order_id": -1, "event_type": "pay", "tx_id": "~", "ts_s": 0, "seq": -1})
    sr = _replay(spark, r, {"tx_id": "~~", "pay_channel": "", "ts_s": 0, "seq": -1})
    got = runner.run_to_memory(sj.reconcile_stream(so, sr, "5 seconds", "5 seconds"), "t_rec")
    got = got.where("coalesce(o_seq, 0) >= 0 AND coalesce(r_seq, 0) >= 0")
    want = joins.reconcile(o, r, "5 seconds", "5 seconds")
    cols = ["tag", "o_seq", "r_seq"]
    _same(got.select(*cols), want.select(*cols))


@pytest.mark.parametrize("n_files", [3])
def test_late_refined_topn_upsert(spark, tmp_path, n_files):
    """update-mode counts + foreachBatch upsert give the fully refined
    counts once every row has arrived within the lateness bound."""
    e = dt.access_hits(spark, SF_SMALL).withColumnRenamed("event_time", "ts").where("method = 'GET'")
    s = _replay(spark, e.select("url", "ts", "seq"), {"url": "~", "seq": -1}, n=n_files, delay="1 day")
    counts = sw.sliding_count_stream(s, "url", "ts", "1 day", "6 hours").select(
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "url", "cnt")
    path = str(tmp_path / "counts")
    q = (counts.writeStream.outputMode("update")
         .foreachBatch(lambda b, i: sw.upsert_counts(b, i, path, ("window_end", "url")))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    table = UpsertTable(spark, path, ("window_end", "url")).read().where("url <> '~'")
    want = windows.sliding_count(e, "url", "ts", "1 day", "6 hours")
    _same(table.select("window_end", "url", "cnt"), want.select("window_end", "url", "cnt"))
    _same(sw.topn_from_counts(table, "url"), topn.topn_per_window(want, "url", 5).select(
        "window_end", "rank", "url", "cnt"))


def test_late_split_stream_equals_batch(spark, tmp_path):
    from tidemark.operators import late
    e = dt.events(spark, SF_SMALL).select("event_id", "ts", F.col("event_id").alias("seq"))
    e = e.withColumn("arrival", F.col("ts") + F.make_dt_interval(
        secs=((F.col("seq") * 7919) % 7200).cast("decimal(18,6)")))
    root = runner.write_replay_files(e, 4, None, order_col="arrival")
    s = runner.read_replay(spark, root, e.schema)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    q = (s.writeStream.foreachBatch(lambda b, i: sw.split_late_batch(
            b, i, state, out, "ts", "arrival", "10 minutes", None, "10 minutes", "60 minutes"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out + "/late").select("event_id")
    want = late.split_late(e, "ts", "arrival", "seq", "10 minutes", None, "10 minutes", "60 minutes")
    want = want.where("is_late").select("event_id")
    assert want.count() > 0
    _same(got, want)


def test_running_uv_update_mode_and_upsert(spark, tmp_path):
    e = dt.events(spark, SF_SMALL).select("user_id", "ts", F.col("event_id").alias("seq"))
    s = _replay(spark, e, {"user_id": -1, "seq": -1})
    path = str(tmp_path / "uv")
    q = (sw.uv_stream(s, "user_id", "ts", "1 hour").writeStream.outputMode("update")
         .foreachBatch(lambda b, i: sw.uv_upsert(b, i, path))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = UpsertTable(spark, path, ("window_end",)).read().where(F.year("window_end") < 2100).select(
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "uv")
    _same(got, distinct.uv_exact(e, "user_id", "ts", "1 hour"))


def test_hll_rollup(spark):
    e = dt.events(spark, SF_SMALL)
    daily = distinct.uv_rollup(distinct.uv_sketches(e, "user_id", "ts", "1 hour", 12), "1 day")
    exact = distinct.uv_exact(e, "user_id", "ts", "1 day").withColumnRenamed("uv", "ex")
    j = daily.join(exact, "window_end")
    assert j.count() == exact.count()
    assert j.where("abs(uv - ex) > greatest(1, ex * 0.05)").count() == 0


def test_reconcile_one_to_one_stream(spark, ref):
    o, r = ref["order"], ref["receipt"]
    pays = o.where("tx_id <> ''").select("tx_id", "ts", "seq")
    rc = r.select("tx_id", "ts", "seq")
    sp = _replay(spark, pays, {"tx_id": "~p", "seq": -1})
    sr = _replay(spark, rc, {"tx_id": "~r", "seq": -1})
    got = runner.run_to_memory(processors.reconcile_1to1_stream(sp, sr), "t_r11").where("tx_id NOT LIKE '~%'")
    tags = {x.tag: x.n for x in got.groupBy("tag").agg(F.count("*").alias("n")).collect()}
    assert tags == {"matched": 5, "pay_without_receipt": 34, "receipt_without_pay": 35}


def test_one_to_one_consumes_partner(spark, tmp_path):
    # two pays and one receipt of the same id: one match, one unmatched pay
    rows = [("t", 100, 1, "pay"), ("t", 101, 2, "pay"), ("t", 103, 3, "receipt")]
    df = spark.createDataFrame(rows, "tx_id string, ts_s bigint, seq bigint, side string").withColumn(
        "ts", F.timestamp_seconds("ts_s"))
    p = df.where("side = 'pay'").select("tx_id", "ts", "seq")
    r = df.where("side = 'receipt'").select("tx_id", "ts", "seq")
    sp = _replay(spark, p, {"tx_id": "~p", "seq": -1}, n=1)
    sr = _replay(spark, r, {"tx_id": "~r", "seq": -1}, n=1)
    got = runner.run_to_memory(processors.reconcile_1to1_stream(sp, sr), "t_r11b").where("tx_id = 't'")
    res = sorted((x.tag, x.pay_seq, x.receipt_seq) for x in got.collect())
    assert res == [("matched", 1, 3), ("pay_without_receipt", 2, None)]


def test_upsert_topn(spark, tmp_path):
    e = dt.access_hits(spark, SF_SMALL).withColumnRenamed("event_time", "ts").where("method = 'GET'")
    s = _replay(spark, e.select("url", "ts", "seq"), {"url": "~", "seq": -1}, n=3, delay="1 day")
    counts = sw.sliding_count_stream(s, "url", "ts", "1 day", "6 hours").select(
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "url", "cnt")
    cpath, tpath = str(tmp_path / "counts"), str(tmp_path / "top")
    q = (counts.writeStream.outputMode("update")
         .foreachBatch(lambda b, i: sw.upsert_topn(b.where("url <> '~'"), i, cpath, tpath, "url", 5))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = UpsertTable(spark, tpath, ("window_end",)).read()
    want = topn.topn_per_window(windows.sliding_count(e, "url", "ts", "1 day", "6 hours"), "url", 5)
    _same(got.select("window_end", "rank", "url", "cnt"), want.select("window_end", "rank", "url", "cnt"))


def test_consecutive_fails_stream(spark):
    lg = dt.logins(spark, SF_SMALL)
    s = _replay(spark, lg, {"user_id": -1, "event_type": "success", "seq": -1})
    got = runner.run_to_memory(processors.consecutive_fails_stream(s, 3, "12 hours"), "t_c3").where("user_id >= 0")
    want = patterns.match_consecutive(lg, 3, within="12 hours")
    assert want.count() > 0
    _same(got, want.select("user_id", _ms("first_ts").alias("first_ms"), _ms("last_ts").alias("last_ms"), "n_fails"))


def test_followed_by_stream(spark, ref):
    o = ref["order"]
    s = _replay(spark, o, {"order_id": -1, "event_type": "create", "tx_id": "", "ts_s": 0, "seq": -1})
    got = runner.run_to_memory(processors.followed_by_stream(s, "15 minutes"), "t_fby").where("order_id >= 0")
    want = patterns.followed_by(o, "order_id", within="15 minutes")
    _same(got.select("order_id", "start_ms", "matched"),
          want.select("order_id", _ms("start_ts").alias("start_ms"), "matched"))
    e = dt.order_events(spark, SF_SMALL)
    s2 = _replay(spark, e, {"order_id": -1, "event_type": "create", "tx_id": "", "seq": -1})
    got2 = runner.run_to_memory(processors.followed_by_stream(s2, "1 day"), "t_fby2").where("order_id >= 0")
    want2 = patterns.followed_by(e, "order_id", within="1 day")
    _same(got2.select("order_id", "start_ms", "matched"),
          want2.select("order_id", _ms("start_ts").alias("start_ms"), "matched"))


def _disordered(spark, df, sentinel, by: int, n=6):
    """Replay of ``df`` with each row up to ``by`` seconds late, in any order within that bound."""
    late = F.make_dt_interval(secs=F.pmod(F.xxhash64("seq", "ts"), F.lit(by)).cast("decimal(18,6)"))
    df = df.withColumn("arrival", F.col("ts") + late)
    root = runner.write_replay_files(df, n, {**sentinel, "arrival": None}, order_col="arrival")
    return sw.event_time(runner.read_replay(spark, root, df.schema), "ts", f"{by} seconds")


def test_processors_under_disorder(spark):
    """Rows that arrive in another order within the watermark delay give the batch rows."""
    day = 86_400
    lg, oe = dt.logins(spark, SF_SMALL), dt.order_events(spark, SF_SMALL)
    user, order = {"user_id": -1, "event_type": "success", "seq": -1}, {"order_id": -1, "event_type": "", "seq": -1}
    ms = [_ms("first_ts").alias("first_ms"), _ms("last_ts").alias("last_ms")]
    for name, make, want in (
            ("pair", lambda s: processors.fail_pairs_stream(s, "12 hours"),
             patterns.login_fail_pairs(lg, within="12 hours").select("user_id", *ms)),
            ("run", lambda s: processors.consecutive_fails_stream(s, 3, "2 days"),
             patterns.match_consecutive(lg, 3, within="2 days").select("user_id", *ms, "n_fails")),
            ("burst", lambda s: processors.fail_bursts_stream(s, "1 day"),
             patterns.login_fail_bursts(lg, horizon="1 day").select("user_id", *ms, "n_fails"))):
        got = runner.run_to_memory(make(_disordered(spark, lg, user, day)), f"t_dis_{name}").where("user_id >= 0")
        assert want.count() > 0
        _same(got, want)
    got = runner.run_to_memory(processors.order_timeout_stream(_disordered(spark, oe, order, day), "1 day"), "t_dis_ot")
    _same(got.where("order_id >= 0").select("order_id", "create_ms", "status"),
          patterns.order_timeout_state(oe, within="1 day").select("order_id", _ms("create_ts").alias("create_ms"), "status"))
    got = runner.run_to_memory(processors.followed_by_stream(_disordered(spark, oe, order, day), "1 day"), "t_dis_fb")
    _same(got.where("order_id >= 0").select("order_id", "start_ms", "matched"),
          patterns.followed_by(oe, "order_id", within="1 day").select("order_id", _ms("start_ts").alias("start_ms"), "matched"))


def test_daily_cap_under_disorder(spark, ref):
    ad = ref["ad_click"]
    s = _disordered(spark, ad, {"user_id": -1, "ad_id": -1, "seq": -1}, 3600)
    got = runner.run_to_memory(processors.daily_cap_stream(s, 5), "t_dis_cap").where("user_id >= 0 AND tag = 'pass'")
    _same(got.select("seq"), caps.daily_cap(ad, ["user_id", "ad_id"], "ts", "seq", 5).select("seq"))


def test_salted_daily_cap_under_disorder(spark, ref):
    """Capped in parts first, then whole: the same clicks and the same warnings, also of a hot key."""
    ad = ref["ad_click"].withColumn("user_id", F.when(F.col("seq") % 3 == 0, 7).otherwise(F.col("user_id"))) \
        .withColumn("ad_id", F.when(F.col("user_id") == 7, 7).otherwise(F.col("ad_id")))
    s = _disordered(spark, ad, {"user_id": -1, "ad_id": -1, "seq": -1}, 3600)
    got = runner.run_to_memory(processors.daily_cap_stream(s, 5, salts=4), "t_salt_cap").where("user_id >= 0")
    _same(got.where("tag = 'pass'").select("seq"), caps.daily_cap(ad, ["user_id", "ad_id"], "ts", "seq", 5).select("seq"))
    warned = caps.daily_cap_warnings(ad, ["user_id", "ad_id"], "ts", "seq", 5)
    assert got.where("tag = 'warning'").count() == warned.count() > 0


def test_late_partner_in_a_later_batch(spark):
    """A row that comes in the batch after its successor still takes its place in time."""
    def run(rows, make, name):
        df = spark.createDataFrame(rows, "arrival bigint, k bigint, event_type string, s bigint")
        df = df.select("arrival", F.col("k").alias("user_id"), F.col("k").alias("order_id"), "event_type",
                       F.timestamp_seconds("s").alias("ts"), F.monotonically_increasing_id().alias("seq"))
        root = runner.write_replay_files(df, 2, {"arrival": 9, "user_id": -1, "order_id": -1, "event_type": "", "seq": -1},
                                         order_col="arrival")
        s = sw.event_time(runner.read_replay(spark, root, df.schema), "ts", "5 seconds")
        return runner.run_to_memory(make(s), name).collect()
    fails = [(1, 7, "fail", 100), (1, 7, "fail", 102), (2, 7, "success", 101)]
    assert run(fails, processors.fail_pairs_stream, "t_lp1") == []
    assert run(fails, lambda s: processors.consecutive_fails_stream(s, 2, "5 seconds"), "t_lp2") == []
    paid = run([(1, 7, "pay", 101), (2, 7, "create", 100)], processors.order_timeout_stream, "t_lp3")
    assert [(r.order_id, r.status) for r in paid] == [(7, "payed")]
