"""Hot keys: a third of the rows on one key.  The bucketed operators must
agree with plain per-key window formulations, and the burst detector with
a walk over each key."""

import random

from pyspark.sql import Window, functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import caps, distinct, late, patterns
from tidemark.sources import driver_tables as dt

SF = "/root/testdata/sf0.01"


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _hot(df):
    # every third event belongs to user 0
    return df.withColumn("user_id", F.when(F.col("seq") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def test_hot_key_pairs_match_plain_lag(spark):
    lg = _hot(dt.logins(spark, SF))
    got = patterns.login_fail_pairs(lg, within="2 hours")
    w = Window.partitionBy("user_id").orderBy("ts", "seq")
    p = lg.withColumn("pt", F.lag("ts").over(w)).withColumn("pe", F.lag("event_type").over(w))
    want = p.where("event_type = 'fail' AND pe = 'fail' AND ts <= pt + INTERVAL 2 HOURS").select(
        "user_id", F.col("pt").alias("first_ts"), F.col("ts").alias("last_ts"), F.lit(2).cast("bigint").alias("n_fails"))
    assert want.where("user_id = 0").count() > 0
    _same(got, want)


def test_hot_key_cap_matches_row_number(spark):
    c = _hot(dt.ad_clicks(spark, SF))
    got = caps.daily_cap(c, ["user_id"], "ts", "seq", 40).select("seq")
    d = c.withColumn("day", F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Shanghai")))
    rn = F.row_number().over(Window.partitionBy("user_id", "day").orderBy("ts", "seq"))
    want = d.withColumn("rn", rn).where("rn <= 40").select("seq")
    _same(got, want)


def test_hot_key_running_uv_matches_plain_window(spark):
    e = _hot(dt.events(spark, SF).withColumnRenamed("event_id", "seq"))
    got = distinct.uv_running(e, "user_id", "ts", "seq", "1 hour").select("seq", "uv")
    d = e.withColumn("we", F.date_trunc("hour", "ts"))
    first = (F.row_number().over(Window.partitionBy("we", "user_id").orderBy("ts", "seq")) == 1).cast("int")
    run = Window.partitionBy("we").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = d.withColumn("f", first).withColumn("uv", F.sum("f").over(run).cast("bigint")).select("seq", "uv")
    _same(got, want)


def _bursts_by_hand(rows, horizon_us):
    out = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r.user_id, []).append(r)
    for key, rs in by_key.items():
        open_ = None
        for r in sorted(rs, key=lambda r: (r.m, r.seq)):
            if open_ and r.m > open_[0] + horizon_us:
                out.append((key, *open_))
                open_ = None
            if r.event_type == "fail":
                open_ = (open_[0], r.m, open_[2] + 1) if open_ else (r.m, r.m, 1)
            else:
                open_ = None
        if open_:
            out.append((key, *open_))
    return sorted(r for r in out if r[3] >= 2)


def test_bursts_of_hot_key_match_a_walk(spark):
    lg = _hot(dt.logins(spark, SF))
    # the same rows squeezed in time: long segments with many bursts each
    dense = lg.withColumn("ts", F.timestamp_micros((F.unix_micros(F.col("ts").cast("timestamp")) / 60).cast("bigint")))
    for d in (lg, dense):
        rows = d.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("m"), "seq", "event_type").collect()
        want = _bursts_by_hand(rows, 5 * 3600 * 10**6)
        got = patterns.login_fail_bursts(d, horizon="5 hours")
        got = got.select("user_id", F.unix_micros(F.col("first_ts").cast("timestamp")).alias("a"),
                         F.unix_micros(F.col("last_ts").cast("timestamp")).alias("z"), "n_fails").collect()
        assert want and sorted(tuple(r) for r in got) == want


def test_halo_and_stitched_forms_agree(spark):
    """Partners exactly at, one microsecond inside and outside a border of the buckets."""
    rows, seq = [], 0
    for k in range(1, 12):               # halo buckets of 2 s patterns are 8 s wide
        for off in (-2_000_000, -1_999_999, -1, 0, 1, 1_999_999, 2_000_000, 2_000_001):
            rows.append((k % 3, "fail" if (seq * 7) % 5 else "success", 8_000_000 * k + off, seq))
            seq += 1
    rows += [(1, "fail", None, seq), (None, "fail", 8_000_000, seq + 1), (None, "fail", 8_000_001, seq + 2)]
    df = spark.createDataFrame(rows, "user_id bigint, event_type string, us bigint, seq bigint").withColumn(
        "ts", F.timestamp_micros("us"))
    for fn, kw in ((patterns.login_fail_pairs, {}), (patterns.login_fail_pairs, {"inclusive": False}),
                   (patterns.match_next, {}), (patterns.match_consecutive, {"n": 2}), (patterns.match_consecutive, {"n": 3})):
        got = fn(df, within="2 seconds", **kw)
        assert got.count() > 0
        _same(got, fn(df, within="2 seconds", bucket="1 second", **kw))
    names = dict(key="user_id", start="fail", end="success", within="2 seconds")
    for fn in (patterns.followed_by, patterns.order_timeout_state):
        got = fn(df.where("us IS NOT NULL"), **names)
        assert got.count() > 0
        _same(got, fn(df.where("us IS NOT NULL"), bucket="1 second", **names))


def test_bursts_long_segment(spark):
    # 600 failures one second apart (one segment): greedy 5 s bursts of 6 failures each, the
    # k-th starting at 1000 + 6(k-1); the last one covers 1594..1599.
    def run(success_ts):
        rows = [(7, "fail", 1000 + i, i) for i in range(600)] + [(7, "success", success_ts, 600)]
        df = spark.createDataFrame(rows, "user_id bigint, event_type string, ts_s bigint, seq bigint").withColumn(
            "ts", F.timestamp_seconds("ts_s"))
        return patterns.login_fail_bursts(df, horizon="5 seconds").orderBy("first_ts").collect()
    late_success = run(1601)       # after the last deadline: all 100 bursts reported
    assert len(late_success) == 100 and all(r.n_fails == 6 for r in late_success)
    assert int(late_success[-1].first_ts.timestamp()) == 1594
    inside = run(1599)             # inside the last burst's horizon: it is cancelled
    assert len(inside) == 99


def test_newest_closed_window_equals_row_watermarks(spark):
    """Buckets of arrivals settle most rows; all get what their own watermark says, whatever the buckets."""
    rng = random.Random(3)
    base = 1_700_000_000
    rows = []
    for i in range(4000):
        at = base + rng.randrange(0, 1200) if i % 3 else base + 300     # a third of the rows arrive in one second
        ts = None if i % 97 == 0 else at - rng.choice([0, 0, 1, 5, 40, 400]) + rng.random()
        rows.append((i, f"u{i % 7}", ts, None if i % 211 == 0 else at))
    df = spark.createDataFrame(rows, "seq bigint, url string, t double, a bigint").select(
        "seq", "url", F.timestamp_seconds("t").alias("ts"), F.timestamp_seconds("a").alias("arrival"))
    for size, slide, disorder, lateness in (("60 seconds", "10 seconds", "2 seconds", "0 seconds"),
                                            ("10 minutes", None, "1 second", "60 seconds"),
                                            ("25 seconds", "10 seconds", "3 seconds", "5 seconds")):
        wm = late.with_row_watermark(df, "ts", "arrival", "seq", disorder)
        want = {r.seq: r.is_late for r in late.mark_late(wm, "ts", "wm", size, slide, lateness).collect()}
        for bucket in ("1 second", "1 minute", "1 hour"):
            got = late.split_late(df, "ts", "arrival", "seq", size, slide, disorder, lateness, bucket).collect()
            assert len(got) == len(rows) and {r.seq: r.is_late for r in got} == want
    # counts: every open window of every row, by brute force over the row watermarks
    rows = late.with_row_watermark(df, "ts", "arrival", "seq", "2 seconds").collect()
    want = {}
    for r in rows:
        if r.ts is None:
            continue
        us = round(r.ts.timestamp() * 1e6)
        wm = None if r.wm is None else round(r.wm.timestamp() * 1e6)
        for start in range(us // 10**7 * 10**7, us - 6 * 10**7, -10**7):
            end = start + 6 * 10**7
            if wm is None or end - 1000 + 5 * 10**6 > wm:
                want[r.url, end] = want.get((r.url, end), 0) + 1
    got = late.sliding_count_with_lateness(df, "url", "ts", "arrival", "seq", "60 seconds", "10 seconds", "2 seconds",
                                           "5 seconds").collect()
    assert {(r.url, round(r.window_end.timestamp() * 1e6)): r.cnt for r in got} == want


def test_newest_closed_window_joins_long_bucket_tables(spark, monkeypatch):
    """Beyond the bound the table of buckets is joined, not broadcast; the rows are the same."""
    df = spark.range(500).select(F.col("id").alias("seq"), F.lit("u").alias("url"),
                                 F.timestamp_seconds(F.col("id") * 37 % 500).alias("ts"),
                                 F.timestamp_seconds(F.col("id")).alias("arrival"))
    args = ("ts", "arrival", "seq", "20 seconds", "5 seconds", "1 second", "3 seconds", "c", "10 seconds")
    want = sorted(map(tuple, late.with_newest_closed(df, *args).collect()))
    monkeypatch.setattr(late, "BROADCAST_BUCKETS", 0)
    assert sorted(map(tuple, late.with_newest_closed(df, *args).collect())) == want


def test_running_visitors_across_empty_sub_buckets(spark):
    """Sub-buckets without first sightings, or without rows, carry the count on; null users are one visitor."""
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 2, 3, None, 50 + i // 20]), 3600 + rng.choice([1, 2, 900, 901, 3599]) + rng.random())
            for i in range(300)] + [(1000, 1, None), (1001, 9, None)]
    df = spark.createDataFrame(rows, "seq bigint, user_id bigint, t double").select(
        "seq", "user_id", F.timestamp_seconds("t").alias("ts"))
    got = {r.seq: r.uv for r in distinct.uv_running(df, size="1 hour", sub_bucket="7 seconds").collect()}
    want, seen = {}, set()
    for i, u, t in sorted(rows[:300], key=lambda r: (int(round(r[2] * 1e6)), r[0])):
        seen.add(u)
        want[i] = len(seen)
    assert got == {**want, 1000: 1, 1001: 2}
