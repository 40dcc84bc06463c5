"""Hand-made edge cases (quirk decisions) and properties."""

import datetime as dtm

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, topn_rows
from tidemark.operators import caps, distinct, joins, patterns, topn, windows
from tidemark.sources import driver_tables as dt


def _df(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.timestamp_seconds("ts_s"))


def test_cap_resets_at_local_midnight_only(spark):
    # 2024-01-01 16:30 UTC is 00:30 on 2024-01-02 in UTC+8; 15:59 UTC is the day before.
    base = int(dtm.datetime(2024, 1, 1, 16, 30, tzinfo=dtm.timezone.utc).timestamp())
    rows = [(1, 7, base - 31 * 60, 0), (1, 7, base, 1), (1, 7, base + 3600, 2), (1, 7, base + 7 * 3600, 3),
            (1, 7, base + 8 * 3600, 4)]
    df = _df(spark, rows, "user_id bigint, ad_id bigint, ts_s bigint, seq bigint")
    passed = caps.daily_cap(df, ["user_id", "ad_id"], "ts", "seq", 2)
    # day 1: seq 0; day 2 (local): seq 1, 2 pass, 3 and 4 (still the same local day) dropped
    assert sorted(r.seq for r in passed.collect()) == [0, 1, 2]
    w = caps.daily_cap_warnings(df, ["user_id", "ad_id"], "ts", "seq", 2).collect()
    assert [r.warn_seq for r in w] == [2]


def test_pair_bound_inclusive_vs_strict(spark):
    rows = [(1, "fail", 100, 0), (1, "fail", 102, 1)]
    df = _df(spark, rows, "user_id bigint, event_type string, ts_s bigint, seq bigint")
    assert patterns.login_fail_pairs(df, within="2 seconds").count() == 1
    assert patterns.login_fail_pairs(df, within="2 seconds", inclusive=False).count() == 0
    assert patterns.match_consecutive(df, 2, within="2 seconds").count() == 0
    assert patterns.match_next(df, within="2 seconds").count() == 0
    assert patterns.match_next(df, within="3 seconds").count() == 1


def test_pay_at_deadline_times_out_and_latest_create_wins(spark):
    rows = [(1, "create", 0, 0), (1, "pay", 900, 1),            # exactly at the deadline
            (2, "create", 0, 2), (2, "create", 100, 3), (2, "pay", 950, 4)]
    df = _df(spark, rows, "order_id bigint, event_type string, ts_s bigint, seq bigint")
    st = {(r.order_id, int(r.create_ts.timestamp())): r.status
          for r in patterns.order_timeout_state(df, within="15 minutes").collect()}
    assert st == {(1, 0): "timeout", (2, 100): "payed"}  # order 2's first create is replaced
    paid = patterns.order_paid(df, within="15 minutes").collect()
    # followed-by: both creates of order 2 see the pay; only the later one is in time
    assert sorted((r.order_id, int(r.start_ts.timestamp())) for r in paid) == [(2, 100)]


def test_interval_join_bounds_and_duplicates(spark):
    pays = _df(spark, [("a", 100, 0), ("b", 100, 1), ("c", 100, 2)], "tx_id string, ts_s bigint, seq bigint")
    rec = _df(spark, [("a", 95, 10), ("b", 105, 11), ("c", 106, 12), ("a", 105, 13)],
              "tx_id string, ts_s bigint, seq bigint")
    inner = joins.interval_join(pays, rec, "tx_id", "tx_id", lower="5 seconds", upper="5 seconds")
    assert sorted((r.l_tx_id, r.r_seq) for r in inner.collect()) == [("a", 10), ("a", 13), ("b", 11)]
    full = joins.interval_join(pays, rec, "tx_id", "tx_id", lower="5 seconds", upper="5 seconds", how="full")
    assert full.count() == 3 + 1 + 1  # pairs + pay c + receipt c


def test_topn_ties_by_key(spark):
    counts = spark.createDataFrame([(1, "b", 3), (1, "a", 3), (1, "c", 2)], "window_end int, key string, cnt bigint")
    r = topn.topn_per_window(counts, "key", 2).orderBy("rank").collect()
    assert [x.key for x in r] == ["a", "b"]


def test_properties_on_driver_tables(spark):
    e = dt.events(spark, SF_SMALL)
    v = dt.item_views(spark, SF_SMALL).where("behavior = 'pv'")
    plain = windows.tumbling_count(v, None, "ts", "1 hour", out="pv")
    salted = windows.salted_count(v, None, "ts", "1 hour", 8, ["seq"], out="pv")
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    ex = distinct.uv_exact(e, "user_id", "ts", "1 hour").withColumnRenamed("uv", "ex")
    bm = distinct.uv_bitmap(e, "user_id", "ts", "1 hour").withColumnRenamed("uv", "bm")
    assert ex.join(bm, "window_end").where("bm > ex").count() == 0
    hll = distinct.uv_hll(e, "user_id", "ts", "1 hour", 0.01).withColumnRenamed("uv", "hl")
    assert ex.join(hll, "window_end").where("abs(hl - ex) > greatest(1, ex * 0.05)").count() == 0
    # every create is either paid or timed out, never both
    o = dt.order_events(spark, SF_SMALL)
    fb = patterns.followed_by(o, "order_id", within="1 day")
    assert fb.count() == o.where("event_type = 'create'").count()
    # reconcile = pairs + left-only + right-only
    pays = o.where("tx_id <> ''")
    r = dt.receipts(spark, SF_SMALL)
    full = joins.reconcile(o, r, "1 hour", "1 hour")
    parts = [joins.interval_join(pays, r, "tx_id", "tx_id", "ts", "ts", "1 hour", "1 hour", h, "o_", "r_").count()
             for h in ("inner", "left_anti", "right_anti")]
    assert full.count() == sum(parts)
    # pane and direct sliding counts agree
    a = windows.sliding_count(v, "item_id", "ts", "1 day", "1 hour", panes=True)
    b = windows.sliding_count(v, "item_id", "ts", "1 day", "1 hour", panes=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_order_permutation_within_file_does_not_matter(spark):
    e = dt.logins(spark, SF_SMALL)
    a = patterns.login_fail_bursts(e, horizon="5 hours")
    b = patterns.login_fail_bursts(e.orderBy(F.rand(7)).repartition(5), horizon="5 hours")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_running_uv_bitmap_collision(spark):
    # 487219231975 and 678895977082 share the 29-bit offset 349607502
    rows = [(487219231975, 10, 0), (678895977082, 20, 1), (5, 30, 2)]
    df = _df(spark, rows, "user_id bigint, ts_s bigint, seq bigint")
    from tidemark.functions.hashing import bitmap_offset
    assert {r[0] for r in df.select(bitmap_offset("user_id")).collect()} >= {349607502}
    by_user = [r.uv for r in distinct.uv_running(df, "user_id", "ts", "seq", "1 hour").orderBy("seq").collect()]
    by_bits = [r.uv for r in distinct.uv_running(df, "user_id", "ts", "seq", "1 hour",
                                                 distinct_on="bitmap").orderBy("seq").collect()]
    assert by_user == [1, 2, 3] and by_bits == [1, 1, 2]
    assert distinct.uv_bitmap(df, "user_id", "ts", "1 hour").first().uv == 2


def test_bitmap_aggregates_equal_distinct_offsets(spark):
    e = dt.events(spark, "/root/testdata/sf0.01")
    a = distinct.uv_bitmap(e, "user_id", "ts", "1 hour")
    b = distinct.uv_bitmap(e, "user_id", "ts", "1 hour", method="bitmaps")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_hit_within_and_beyond_lateness(spark):
    from tidemark.operators import late
    # tumbling 10 s windows (size = slide), disorder 1 s, lateness 60 s.
    # arrival order: t=0 (url a), t=100 (b) moves the watermark to 99 s,
    # then a late hit at t=45 (window [40,50): closed at 49.999+60 = 109.999 > 99 -> still open)
    # then t=200 (b) moves the watermark to 199 s, then a hit at t=46 (closed: 109.999 <= 199 -> late)
    rows = [("a", 0, 0, 0), ("b", 100, 1, 1), ("a", 45, 2, 2), ("b", 200, 3, 3), ("a", 46, 4, 4)]
    df = spark.createDataFrame(rows, "url string, ts_s bigint, arr_s bigint, seq bigint").withColumn(
        "ts", F.timestamp_seconds("ts_s")).withColumn("arrival", F.timestamp_seconds("arr_s"))
    split = {r.seq: r.is_late for r in late.split_late(df, "ts", "arrival", "seq", "10 seconds", None,
                                                        "1 second", "60 seconds").collect()}
    assert split == {0: False, 1: False, 2: False, 3: False, 4: True}
    counts = late.sliding_count_with_lateness(df, "url", "ts", "arrival", "seq", "10 seconds", "10 seconds",
                                              disorder="1 second", lateness="60 seconds")
    got = {(r.url, int(r.window_end.timestamp())): r.cnt for r in counts.collect()}
    assert got[("a", 50)] == 1  # the hit within lateness refines the window, the one beyond does not
    assert got[("a", 10)] == 1 and got[("b", 110)] == 1 and got[("b", 210)] == 1


def test_unflushed_tail_needs_sentinel(spark):
    from tidemark.streaming import runner, windows as sw
    v = dt.item_views(spark, SF_SMALL).where("behavior = 'pv'")
    last_end = windows.sliding_count(v, "item_id", "ts", "1 day", "6 hours").agg(F.max("window_end")).first()[0]

    def run(sentinel, name):
        root = runner.write_replay_files(v, 3, sentinel)
        s = sw.event_time(runner.read_replay(spark, root, v.schema), "ts", "0 seconds")
        out = topn_rows(sw.finished_counts(sw.sliding_count_stream(s, "item_id", "ts", "1 day", "6 hours"), "item_id"),
                        "item_id")
        return out.where("item_id >= 0").agg(F.max("window_end")).first()[0]

    unflushed = run(None, "t_tail0")  # the watermark never passes the last windows
    assert unflushed is None or unflushed.replace(tzinfo=None) < last_end.replace(tzinfo=None)
    flushed = run({"user_id": -1, "item_id": -1, "behavior": "pv", "seq": -1}, "t_tail2")
    assert flushed.replace(tzinfo=None) == last_end.replace(tzinfo=None)


def test_null_keys_and_times_keep_their_rows(spark):
    from tidemark.operators import sequence
    rows = [(None, 10, 1), (None, 100, 2), (1, None, 3), (1, 20, 4), (None, None, 5)]
    df = spark.createDataFrame(rows, "user_id bigint, s bigint, seq bigint").select(
        "user_id", F.timestamp_seconds("s").alias("ts"), "seq", F.lit(1).alias("one"))
    summed = sequence.running_sum(df, "user_id", "ts", "seq", "one", "n")
    assert {r.seq: r.n for r in summed.collect()} == {5: 1, 1: 2, 2: 3, 3: 1, 4: 2}
    near = sequence.with_neighbors(df, "user_id", "ts", "seq", [], 1, "_p")
    assert {r.seq: [p.seq for p in r["_p"]] for r in near.collect()} == {5: [], 1: [5], 2: [1], 3: [], 4: [3]}
    assert sequence.next_match(df, "user_id", "ts", "seq", F.col("seq") == 2).count() == 5
    assert sequence.running_max_before(df, "ts", "seq", "seq", "m").count() == 5


def test_sliding_rows_are_late_only_when_every_window_is_closed(spark):
    from tidemark.operators import late
    # 30 s windows every 10 s: t=5 lies in the windows that end at 10, 20 and 30 s
    rows = [(5, w, w) for w in (None, 8, 9, 28, 29, 30, 31)]
    df = spark.createDataFrame(rows, "t int, w int, seq int").selectExpr(
        "timestamp_seconds(t) AS ts", "timestamp_seconds(w) AS wm", "seq")
    got = {r.seq: r.is_late for r in late.mark_late(df, "ts", "wm", "30 seconds", "10 seconds", 0).collect()}
    assert got == {None: False, 8: False, 9: False, 28: False, 29: False, 30: True, 31: True}


def test_sweep_over_chunk_borders(spark):
    # 3 chunks of ends, ranges that start, end and lie across their borders
    slide = 10
    edge = windows.SWEEP_CHUNK * slide
    rows = [("a", edge - 20, edge + 20, 2), ("a", edge, edge + 10, 1), ("a", 2 * edge - 10, 2 * edge, 5),
            ("b", 0, 3 * edge, 1), (None, edge - 10, edge, 7), ("c", 5, 5, 1)]
    df = spark.createDataFrame(rows, "k string, _a bigint, _z bigint, _n bigint")
    got = {(r.k, r.us): r.cnt for r in windows.sweep_ranges(df, "k", slide, False).selectExpr(
        "k", "unix_micros(window_end) AS us", "cnt").collect()}
    want = {}
    for k, a, z, n in rows:
        for t in range(a, z, slide):
            want[k, t] = want.get((k, t), 0) + n
    assert got == want
