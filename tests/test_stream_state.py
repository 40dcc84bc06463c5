"""Counts held in state: the pane ring, one late decision, running visitors, salted page views."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_streaming import _disordered, _replay, _same
from tidemark.operators import distinct, windows
from tidemark.plans import jobs
from tidemark.sources import driver_tables as dt
from tidemark.streaming import runner, sliding, visitors, windows as sw

MINUTE = 60_000_000


def plain_windows(times, size, slide, first, last):
    out = []
    for e in range(first - first % slide, last + 1, slide):
        n = sum(e - size <= t < e for t in times)
        if n and e >= first:
            out.append((e, n))
    return out


@pytest.mark.parametrize("size, slide", [(10, 5), (5, 5), (60, 5), (100, 20)])
def test_pane_ring(size, slide):
    rng = random.Random(size)
    times = sorted(rng.choices(range(100, 500), k=40) + rng.choices(range(3000, 3050), k=9))
    ring = sliding.PaneRing(size, slide)
    for t in times:
        ring.panes[ring.pane(t)] = ring.panes.get(ring.pane(t), 0) + 1
    got = []
    for until in (99, 130, 131, 260, 300, 1000, 3020, 5000):
        got += ring.due(until)
        ring.drop_before(ring.reported + slide)
    assert got == plain_windows(times, size, slide, 100, 5000)
    assert not ring.panes and ring.next_due() is None


def test_sliding_counts_equal_batch_at_720_windows_a_row(spark):
    v = dt.item_views(spark, SF_SMALL).where("behavior = 'pv'")
    s = _replay(spark, v, {"user_id": -1, "item_id": -1, "behavior": "pv", "seq": -1}, n=4)
    counts = sliding.sliding_counts(s, "item_id", "ts", "1 hour", "5 seconds")
    assert "Expand" not in counts._jdf.queryExecution().analyzed().toString()
    got = runner.run_to_memory(counts, "t_ring").where("item_id >= 0")
    want = windows.sliding_count(v, "item_id", "ts", "1 hour", "5 seconds")
    _same(got.select("item_id", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt"),
          want.select("item_id", "window_end", "cnt"))


def test_sliding_counts_under_disorder(spark):
    v = dt.item_views(spark, SF_SMALL).where("behavior = 'pv'").withColumn("item_id", F.col("item_id") % 7)
    s = _disordered(spark, v, {"user_id": -1, "item_id": -1, "behavior": "pv", "seq": -1}, 7200)
    got = runner.run_to_memory(sliding.sliding_counts(s, "item_id", "ts", "6 hours", "30 minutes"), "t_ring_dis")
    want = windows.sliding_count(v, "item_id", "ts", "6 hours", "30 minutes")
    _same(got.where("item_id >= 0").select("item_id", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "cnt"),
          want.select("item_id", "window_end", "cnt"))


def replay_batches(spark, batches, delay):
    """A stream of ``batches`` of (seconds, url, seq, method), one micro-batch each."""
    rows = [(i, *r) for i, b in enumerate(batches) for r in b]
    df = spark.createDataFrame(rows, "b int, s double, url string, seq bigint, method string")
    df = df.withColumn("event_time", F.timestamp_micros((F.col("s") * 1_000_000).cast("bigint"))).drop("s")
    root = runner.write_replay_files(df, len(batches), None, order_col="b", ts="event_time")
    return runner.read_replay(spark, root, df.schema)


def plain_late(batches, size, slide, delay, lateness):
    """Final count per (url, window end) and the late rows, deciding row by row."""
    panes, late, top = {}, [], 0
    for batch in batches:
        wm = max(0, (top // 1000 - delay // 1000) * 1000) if top else 0
        for s, url, seq, method in batch:
            t = round(s * 1_000_000)
            ends = [e for e in range(t - t % slide + slide, t - t % slide + size + slide, slide)
                    if e - 1000 + lateness > wm]
            if method == "GET":
                for e in ends:
                    panes[url, e] = panes.get((url, e), 0) + 1
                if not ends:
                    late.append(seq)
            top = max(top, t)
    wm = (top // 1000 - delay // 1000) * 1000
    return {k: n for k, n in panes.items() if k[1] - 1000 <= wm}, sorted(late)


@pytest.mark.parametrize("seed, n_batches", [(0, 3), (1, 6), (2, 9)])
def test_one_late_decision_for_any_split(spark, tmp_path, seed, n_batches):
    """Each GET row is counted or late, as one watermark says, however the rows are split."""
    rng = random.Random(seed)
    rows = [(max(0.0, 3000.0 + 20 * i - rng.choice([0, 0, 30, 400, 2500])), f"/{rng.randrange(3)}", i,
             rng.choice(["GET", "GET", "POST"])) for i in range(150)]
    cuts = sorted(rng.sample(range(1, len(rows)), n_batches - 1))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    size, slide, delay, lateness = 10 * MINUTE, 5 * MINUTE, 1_000_000, MINUTE
    s = replay_batches(spark, batches, delay)
    tagged = jobs.hot_urls_stream(s, "10 minutes", "5 minutes", "1 second", "60 seconds")
    seen = []
    (tagged.writeStream.outputMode("update").foreachBatch(
        lambda b, i: seen.extend((i, *r) for r in b.select(
            "tag", "url", F.unix_micros("window_end").alias("e"), "cnt", "seq", "method").collect()))
     .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination())
    last = {}
    for i, tag, url, e, cnt, _, _ in sorted(seen, key=lambda r: r[0]):
        if tag == "count":
            last[url, e] = cnt
    late = sorted(r[5] for r in seen if r[1] == "late")
    want, want_late = plain_late(batches, size, slide, delay, lateness)
    assert (last, late) == (want, want_late) and late
    assert {r[6] for r in seen if r[1] == "late"} == {"GET"}
    assert len({(r[0], r[2], r[3]) for r in seen if r[1] == "count"}) == sum(r[1] == "count" for r in seen)


def test_sub_millisecond_rows_are_not_left_waiting(spark):
    """The last row of a file, a fraction of a millisecond beyond its watermark, still comes out."""
    from tidemark.streaming import processors
    rows = [(7, "fail", 1_000_000_400, 1), (8, "fail", 2_000_000_300, 2), (7, "fail", 1_000_500_000, 3)]
    df = spark.createDataFrame(rows, "user_id bigint, event_type string, us bigint, seq bigint").select(
        "user_id", "event_type", F.timestamp_micros("us").alias("ts"), "seq")
    s = _replay(spark, df, {"user_id": -1, "event_type": "success", "seq": -1}, n=2)
    got = runner.run_to_memory(processors.fail_pairs_stream(s, "2 seconds"), "t_subms").where("user_id >= 0")
    assert [(r.user_id, r.last_ms) for r in got.collect()] == [(7, 1_000_500)]


@pytest.mark.parametrize("method", ["running", "running_bitmap"])
def test_running_visitors_equal_batch(spark, method):
    e = dt.events(spark, SF_SMALL).select("user_id", "ts", F.col("event_id").alias("seq"))
    s = runner.read_replay(spark, runner.write_replay_files(e, 3, {"user_id": -1, "seq": -1}), e.schema)
    got = runner.run_to_memory(jobs.unique_visitors_stream(s, "6 hours", method), f"t_{method}").where("seq >= 0")
    on = "bitmap" if method == "running_bitmap" else "user"
    want = distinct.uv_running(e, "user_id", "ts", "seq", "6 hours", distinct_on=on)
    _same(got.select("seq", F.col("window_end").cast("timestamp_ntz").alias("window_end"), "uv"),
          want.select("seq", "window_end", "uv"))


def test_running_visitors_under_disorder_with_ties_and_collisions(spark):
    rows = [(u, s, i) for i, (u, s) in enumerate([(1, 10), (1, 10), (2, 10), (None, 11), (None, 12), (33, 12), (2, 4000),
                                                  (1, 3999), (34, 13), (1, 4000)] * 3)]
    e = spark.createDataFrame(rows, "user_id bigint, s bigint, seq bigint").select(
        "user_id", F.timestamp_seconds("s").alias("ts"), "seq")
    for on, bits in (("user", 29), ("bitmap", 5)):
        known = e if on == "user" else e.where("user_id IS NOT NULL")
        s = _disordered(spark, known, {"user_id": -1, "seq": -1}, 600, n=3)
        got = runner.run_to_memory(visitors.uv_running_stream(s, distinct_on=on, bits=bits), f"t_rd_{on}")
        want = distinct.uv_running(known, distinct_on=on, bits=bits)
        _same(got.where("seq >= 0").select("seq", "window_end", "uv"), want.select("seq", "window_end", "uv"))


def test_salted_page_views_stream(spark):
    v = dt.item_views(spark, SF_SMALL)
    root = runner.write_replay_files(v, 3, {"user_id": -1, "item_id": -1, "behavior": "pv", "seq": -1})
    got = runner.run_to_memory(jobs.page_views_stream(runner.read_replay(spark, root, v.schema)), "t_pvs")
    got = got.where("year(window_end) < 2100").select(
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "pv")
    _same(got, jobs.page_views(v, salted=True))


def test_replay_reads_its_source_in_one_write_and_keeps_order(spark):
    import datetime as dt
    rows = [(None, -5), (dt.datetime(2150, 1, 1), 3)] + [(dt.datetime(2024, 1, 1) + dt.timedelta(days=9 * i), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "ts timestamp, seq bigint").repartition(6)
    root = runner.write_replay_files(df, 7, {"seq": -1})
    back = spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(root)
    assert back.where("seq <> -1").exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert {r["ts"].year for r in back.where("seq = -1").collect()} == {2151}       # beyond the last row
    seen = []
    (runner.read_replay(spark, root, df.schema).writeStream.foreachBatch(
        lambda b, i: seen.append([(r["ts"], r["seq"]) for r in b.collect()])).trigger(availableNow=True)
     .option("checkpointLocation", runner.scratch_path(spark, "ck")).start().awaitTermination())
    assert len(seen) == 9 and [len(b) for b in seen[-2:]] == [1, 1] and (None, -5) in seen[0]
    tops = [max(t for t, _ in b if t) for b in seen]
    lows = [min(t for t, _ in b if t) for b in seen]
    assert tops == sorted(tops) and all(a < b for a, b in zip(tops, lows[1:-1]))


@pytest.mark.parametrize("name", ["pair", "run", "paid", "timeout"])
def test_hot_key_spread_over_buckets(spark, name):
    """All rows of one key: the same results from (key, time bucket) states, in more than one of them."""
    from tidemark.operators import patterns
    from tidemark.streaming import processors
    rng = random.Random(9)
    us = sorted(rng.sample(range(0, 400_000_000, 250), 700))
    order = name in ("paid", "timeout")
    kinds = ["create", "pay", "pay"] if order else ["fail", "fail", "fail", "success"]
    key = "order_id" if order else "user_id"
    df = spark.createDataFrame([(7, rng.choice(kinds), t, i) for i, t in enumerate(us)],
                               f"{key} bigint, event_type string, us bigint, seq bigint").select(
        key, "event_type", F.timestamp_micros("us").alias("ts"), "seq")
    flush = {key: -1, "event_type": "", "seq": -1}
    ms = [F.expr(f"unix_millis({c})").alias(c.replace("_ts", "_ms")) for c in ("first_ts", "last_ts")]
    make, want = {
        "pair": (lambda s: processors.fail_pairs_stream(s, "1 second", spread=True),
                 lambda: patterns.login_fail_pairs(df, within="1 second").select("user_id", *ms)),
        "run": (lambda s: processors.consecutive_fails_stream(s, 3, "2 seconds", spread=True).drop("n_fails"),
                lambda: patterns.match_consecutive(df, 3, within="2 seconds").select("user_id", *ms)),
        "paid": (lambda s: processors.followed_by_stream(s, "700 milliseconds", spread=True).select("order_id", "start_ms", "matched"),
                 lambda: patterns.followed_by(df, within="700 milliseconds").select(
                     "order_id", F.expr("unix_millis(start_ts)").alias("start_ms"), "matched")),
        "timeout": (lambda s: processors.order_timeout_stream(s, "700 milliseconds", spread=True).select("order_id", "create_ms", "status"),
                    lambda: patterns.order_timeout_state(df, within="700 milliseconds").select(
                        "order_id", F.expr("unix_millis(create_ts)").alias("create_ms"), "status"))}[name]
    s = _disordered(spark, df, flush, 5, n=3)
    got = runner.run_to_memory(make(s), f"t_spread_{name}").where(f"{key} >= 0")
    assert want().count() > 20
    _same(got, want())
