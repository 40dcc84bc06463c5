"""Query catalog over the driver's tables: one Spark plan per operator key,
and the equivalent DuckDB SQL used as the correctness oracle.

Parameters are widened from the reference's seconds-scale settings to suit
the sparse ``events`` table (30 days, minutes between a user's events); the
mapping of ``events`` onto the reference's record shapes is in
``tidemark.sources.driver_tables``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.time import local_day, next_local_midnight
from tidemark.operators import caps, distinct, joins, late, matching, patterns, topn, windows
from tidemark.plans import jobs
from tidemark.sources import driver_tables as dt
from tidemark.session import scratch_path
from tidemark.sources.readers import parse_access_log, read_records, split_malformed, with_event_time

# Fixed parameters of the catalog queries.
TOP_N = 5
TZ = "Asia/Shanghai"
CAP = 3
ARRIVAL_PRIME, ARRIVAL_SPAN_S = 7919, 7200

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ORIGIN = "TIMESTAMP '1970-01-01'"


def _sliding_sql(select_key: str, where: str, slide_h: int, fan: int, key_cols: str) -> str:
    return f"""
SELECT {key_cols}, window_end, CAST(count(*) AS BIGINT) AS cnt FROM (
  SELECT {select_key},
         time_bucket(INTERVAL {slide_h} HOUR, ts, {ORIGIN}) + to_hours(CAST({slide_h} * (g + 1) AS BIGINT)) AS window_end
  FROM events, range(0, {fan}) t(g) WHERE {where}) x
GROUP BY {key_cols}, window_end"""


def _topn_sql(counts_sql: str, key: str) -> str:
    return f"""
SELECT window_end, rank, {key}, cnt FROM (
  SELECT window_end, {key}, cnt,
         CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key} ASC) AS BIGINT) AS rank
  FROM ({counts_sql}) c) r
WHERE rank <= {TOP_N}"""


# --------------------------------------------------------------- filters / scans

@register("filter_event_type", """
SELECT event_id, ts, user_id, event_type FROM events WHERE event_type = 'view'""")
def q_filter_event_type(spark, sf):
    return dt.events(spark, sf).where(F.col("event_type") == "view").select(
        "event_id", "ts", "user_id", "event_type")


@register("parse_access_log", """
SELECT event_id AS seq, '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip, CAST(user_id AS VARCHAR) AS "user",
       date_trunc('second', ts) AS event_time,
       CASE WHEN event_type = 'click' THEN 'GET' ELSE 'POST' END AS method,
       '/k/' || CAST(""" + K_SQL + """ AS VARCHAR) AS url
FROM events""")
def q_parse_access_log(spark, sf):
    hits = dt.access_hits(spark, sf)
    # Render each hit as an access-log text line, then parse it back.
    line = F.concat_ws(" ", "ip", "user", F.lit("-"),
                       F.date_format("event_time", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), "method", "url")
    return parse_access_log(hits.select("seq", line.alias("value")), keep=["seq"], ntz=True)


def _scanned(df: DataFrame, kind: str, columns: list[str]) -> DataFrame:
    """``df`` rendered as comma-separated text files and scanned back under the fixed schema."""
    path = scratch_path(df.sparkSession, f"scan-{kind}")
    df.select(*columns, F.unix_seconds(F.col("ts").cast("timestamp"))).write.csv(path)
    return with_event_time(read_records(df.sparkSession, kind, path), seq_col=None, ntz=True).drop("ts_s")


SECOND_SQL = "date_trunc('second', ts) AS ts"


@register("scan_user_behavior", f"""
SELECT user_id, {K_SQL} AS item_id, CAST({K_SQL} % 10 AS INTEGER) AS category_id,
       CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, {SECOND_SQL} FROM events""")
def q_scan_user_behavior(spark, sf):
    v = dt.item_views(spark, sf).withColumn("category_id", F.col("item_id") % 10)
    return _scanned(v, "user_behavior", ["user_id", "item_id", "category_id", "behavior"])


@register("scan_ad_click", f"""
SELECT e.user_id, {K_SQL} AS ad_id, n.n_name AS province, 'city-' || CAST(e.user_id % 7 AS VARCHAR) AS city, {SECOND_SQL}
FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25 WHERE event_type = 'click'""")
def q_scan_ad_click(spark, sf):
    c = dt.ad_clicks(spark, sf).join(dt.provinces(spark, sf), "nation_key").withColumn(
        "city", F.concat(F.lit("city-"), (F.col("user_id") % 7).cast("string")))
    return _scanned(c, "ad_click", ["user_id", "ad_id", "province", "city"])


@register("scan_login", f"""
SELECT user_id, '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip,
       CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, {SECOND_SQL} FROM events""")
def q_scan_login(spark, sf):
    lg = dt.logins(spark, sf).withColumn("ip", F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")))
    return _scanned(lg, "login", ["user_id", "ip", "event_type"])


@register("scan_order", f"""
SELECT user_id AS order_id, CASE WHEN event_type = 'purchase' THEN 'pay' ELSE 'create' END AS event_type,
       CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) ELSE '' END AS tx_id, {SECOND_SQL}
FROM events WHERE event_type IN ('signup', 'purchase')""")
def q_scan_order(spark, sf):
    return _scanned(dt.order_events(spark, sf), "order", ["order_id", "event_type", "tx_id"])


@register("scan_receipt", f"""
SELECT CAST(user_id AS VARCHAR) AS tx_id, 'click' AS pay_channel, {SECOND_SQL} FROM events WHERE event_type = 'click'""")
def q_scan_receipt(spark, sf):
    return _scanned(dt.receipts(spark, sf), "receipt", ["tx_id", "pay_channel"])


# Login lines of which some are cut short, have a letter in a number, a field too many, or an empty number.
LINE_SQL = """
SELECT event_id, ts, CASE
  WHEN event_id % 97 = 0 THEN CAST(user_id AS VARCHAR) || ',' || event_type
  WHEN event_id % 89 = 0 THEN 'x' || CAST(user_id AS VARCHAR) || ',10.0.0.1,' || event_type || ',' || CAST(floor(epoch(ts))::BIGINT AS VARCHAR)
  WHEN event_id % 83 = 0 THEN CAST(user_id AS VARCHAR) || ',10.0.0.1,' || event_type || ',1,2'
  WHEN event_id % 79 = 0 THEN ',10.0.0.1,' || event_type || ',7'
  ELSE CAST(user_id AS VARCHAR) || ',10.0.0.1,' || event_type || ',' || CAST(floor(epoch(ts))::BIGINT AS VARCHAR) END AS line,
  event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0 OR event_id % 79 = 0 AS bad,
  user_id, event_type FROM events"""


@register("scan_quarantine", f"""
SELECT 'record' AS kind, user_id, '10.0.0.1' AS ip, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s, '' AS line
FROM ({LINE_SQL}) l WHERE NOT bad
UNION ALL
SELECT 'malformed', -1, '', '', 0, line FROM ({LINE_SQL}) l WHERE bad""")
def q_scan_quarantine(spark, sf):
    e = dt.events(spark, sf)
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    sec = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")

    def line(*fields):
        return F.concat_ws(",", *[F.lit(f) if isinstance(f, str) else f for f in fields])
    text = (F.when(F.col("event_id") % 97 == 0, line(user, kind))
            .when(F.col("event_id") % 89 == 0, line(F.concat(F.lit("x"), user), "10.0.0.1", kind, sec))
            .when(F.col("event_id") % 83 == 0, line(user, "10.0.0.1", kind, "1", "2"))
            .when(F.col("event_id") % 79 == 0, line("", "10.0.0.1", kind, "7"))
            .otherwise(line(user, "10.0.0.1", kind, sec)))
    path = scratch_path(spark, "scan-quarantine")
    e.select(text.alias("value")).write.text(path)
    good, bad = split_malformed(spark.read.text(path), "login")
    columns = ["kind", "user_id", "ip", "event_type", "ts_s", "line"]
    return (good.select(F.lit("record").alias("kind"), *columns[1:5], F.lit("").alias("line"))
            .unionByName(bad.selectExpr("'malformed' AS kind", "-1L AS user_id", "'' AS ip", "'' AS event_type", "0L AS ts_s",
                                        "value AS line").select(*columns)))


@register("local_day", """
SELECT event_id, CAST(ts + INTERVAL 8 HOUR AS DATE) AS local_day,
       CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) - INTERVAL 8 HOUR AS next_local_midnight
FROM events""")
def q_local_day(spark, sf):
    e = dt.events(spark, sf)
    return e.select("event_id", local_day("ts", TZ).alias("local_day"),
                    next_local_midnight("ts", TZ).alias("next_local_midnight"))


# --------------------------------------------------------------- hot items

def _item_views(spark, sf):
    # pv filter expressed on the raw column so that it reaches the scan
    return dt.item_views(spark, sf, where=F.col("event_type") == dt.VIEW)


HOT_ITEMS_COUNTS_SQL = _sliding_sql(f"{K_SQL} AS item_id", "event_type = 'view'", 6, 4, "item_id")


@register("hot_items_counts", HOT_ITEMS_COUNTS_SQL)
def q_hot_items_counts(spark, sf):
    return windows.sliding_count(_item_views(spark, sf), "item_id", "ts", "1 day", "6 hours", method="panes")


@register("hot_items_topn", _topn_sql(HOT_ITEMS_COUNTS_SQL, "item_id"))
def q_hot_items_topn(spark, sf):
    return topn.topn_per_window(q_hot_items_counts(spark, sf), "item_id", TOP_N).select(
        "window_end", "rank", "item_id", "cnt")


@register("topn_report", f"""
SELECT window_end, rank, item_id, cnt,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' AS window_end_text,
       'TOP ' || CAST(rank AS VARCHAR) || ' ItemId=' || CAST(item_id AS VARCHAR) || ' heat=' || CAST(cnt AS VARCHAR) AS line
FROM ({_topn_sql(HOT_ITEMS_COUNTS_SQL, "item_id")}) t""")
def q_topn_report(spark, sf):
    return topn.topn_report(q_hot_items_topn(spark, sf), "item_id")


# --------------------------------------------------------------- hot urls

def _gets(spark, sf):
    # GET lines are the click events; filter on the raw column (pushed down)
    return dt.access_hits(spark, sf, where=F.col("event_type") == dt.CLICK).withColumnRenamed("event_time", "ts")


URL_SQL = f"'/k/' || CAST({K_SQL} AS VARCHAR) AS url"
HOT_URLS_COUNTS_SQL = _sliding_sql(URL_SQL, "event_type = 'click'", 1, 24, "url")


@register("hot_urls_counts", HOT_URLS_COUNTS_SQL)
def q_hot_urls_counts(spark, sf):
    return windows.sliding_count(_gets(spark, sf), "url", "ts", "1 day", "1 hour")


@register("hot_urls_topn", _topn_sql(HOT_URLS_COUNTS_SQL, "url"))
def q_hot_urls_topn(spark, sf):
    return topn.topn_per_window(q_hot_urls_counts(spark, sf), "url", TOP_N).select(
        "window_end", "rank", "url", "cnt")


def _arrival(df, seq="seq"):
    """Synthetic arrival time: up to two hours after the event time."""
    secs = (F.col(seq) * ARRIVAL_PRIME) % ARRIVAL_SPAN_S
    return df.withColumn("arrival", F.col("ts") + F.make_dt_interval(secs=secs.cast("decimal(18,6)")))


ARRIVAL_SQL = f"ts + to_seconds(CAST((event_id * {ARRIVAL_PRIME}) % {ARRIVAL_SPAN_S} AS BIGINT)) AS arrival"

HOT_URLS_LATE_COUNTS_SQL = f"""
SELECT url, window_end, CAST(count(*) AS BIGINT) AS cnt FROM (
  SELECT url, window_end, wm FROM (
    SELECT {URL_SQL}, ts, event_type,
           max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             - INTERVAL 10 MINUTE AS wm
    FROM (SELECT *, {ARRIVAL_SQL} FROM events) a) b,
  LATERAL (SELECT time_bucket(INTERVAL 1 HOUR, b.ts, {ORIGIN}) + to_hours(CAST(g + 1 AS BIGINT)) AS window_end
           FROM range(0, 24) t(g)) w
  WHERE b.event_type = 'click'
    AND NOT COALESCE(window_end - INTERVAL 1 MILLISECOND + INTERVAL 60 MINUTE <= wm, false)) x
GROUP BY url, window_end"""


@register("hot_urls_topn_late", _topn_sql(HOT_URLS_LATE_COUNTS_SQL, "url"))
def q_hot_urls_topn_late(spark, sf):
    # The watermark advances on every access-log line (all methods); the
    # GET filter applies to what is counted.
    hits = _arrival(dt.access_hits(spark, sf).withColumnRenamed("event_time", "ts"))
    marked = late.with_newest_closed(hits, "ts", "arrival", "seq", "1 day", "1 hour", "10 minutes", "60 minutes")
    counts = late.sliding_count_with_lateness(
        marked.where(F.col("method") == "GET"), "url", "ts", "arrival", "seq", "1 day", "1 hour",
        newest_closed="newest_closed")
    return topn.topn_per_window(counts, "url", TOP_N).select("window_end", "rank", "url", "cnt")


@register("hot_urls_late_rows", f"""
SELECT event_id AS seq, {URL_SQL}, ts, arrival FROM (
  SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - INTERVAL 10 MINUTE AS wm
  FROM (SELECT *, {ARRIVAL_SQL} FROM events) a) b
WHERE event_type = 'click' AND time_bucket(INTERVAL 10 MINUTE, ts, {ORIGIN}) + INTERVAL 30 MINUTE
      - INTERVAL 1 MILLISECOND + INTERVAL 5 MINUTE <= wm""")
def q_hot_urls_late_rows(spark, sf):
    # 30 min / 10 min windows: GET rows all of whose windows were closed on arrival
    hits = _arrival(dt.access_hits(spark, sf).withColumnRenamed("event_time", "ts"))
    _, late_rows = jobs.hot_urls(hits, "30 minutes", "10 minutes", TOP_N, "10 minutes", "5 minutes", "arrival")
    return late_rows.select("seq", "url", "ts", "arrival")


@register("late_events_split", f"""
SELECT event_id, arrival,
       COALESCE(time_bucket(INTERVAL 10 MINUTE, ts, {ORIGIN}) + INTERVAL 10 MINUTE - INTERVAL 1 MILLISECOND
                + INTERVAL 60 MINUTE <= wm, false) AS is_late
FROM (SELECT event_id, ts, arrival,
             max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 10 MINUTE AS wm
      FROM (SELECT *, {ARRIVAL_SQL} FROM events) a) b""")
def q_late_events_split(spark, sf):
    e = _arrival(dt.events(spark, sf).withColumnRenamed("event_id", "seq"))
    r = late.split_late(e, "ts", "arrival", "seq", size="10 minutes", disorder="10 minutes",
                        lateness="60 minutes")
    return r.select(F.col("seq").alias("event_id"), "arrival", "is_late")


# --------------------------------------------------------------- page views

PV_SQL = f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts, {ORIGIN}) + INTERVAL 1 HOUR AS window_end, CAST(count(*) AS BIGINT) AS pv
FROM events WHERE event_type = 'view' GROUP BY 1"""


@register("pv_hourly", PV_SQL)
def q_pv_hourly(spark, sf):
    return windows.tumbling_count(_item_views(spark, sf), None, "ts", "1 hour", out="pv")


@register("pv_hourly_salted", PV_SQL)
def q_pv_hourly_salted(spark, sf):
    return windows.salted_count(_item_views(spark, sf), None, "ts", "1 hour", buckets=8,
                                salt_cols=["seq"], out="pv")


# --------------------------------------------------------------- unique visitors

HOUR_END_SQL = f"time_bucket(INTERVAL 1 HOUR, ts, {ORIGIN}) + INTERVAL 1 HOUR"


@register("uv_hourly_exact", f"""
SELECT {HOUR_END_SQL} AS window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv FROM events GROUP BY 1""")
def q_uv_hourly_exact(spark, sf):
    return distinct.uv_exact(dt.events(spark, sf), "user_id", "ts", "1 hour")


BITMAP_SQL = ("list_reduce(list_prepend(0::BIGINT, list_transform(string_split(user_id::VARCHAR, ''), "
              "lambda x: ascii(x)::BIGINT)), lambda a, c: (a * 31 + c) & 536870911)")


@register("uv_hourly_bitmap", f"""
SELECT {HOUR_END_SQL} AS window_end, CAST(count(DISTINCT {BITMAP_SQL}) AS BIGINT) AS uv FROM events GROUP BY 1""")
def q_uv_hourly_bitmap(spark, sf):
    return distinct.uv_bitmap(dt.events(spark, sf), "user_id", "ts", "1 hour")


@register("uv_hourly_bitmap_agg", f"""
SELECT {HOUR_END_SQL} AS window_end, CAST(count(DISTINCT {BITMAP_SQL}) AS BIGINT) AS uv FROM events GROUP BY 1""")
def q_uv_hourly_bitmap_agg(spark, sf):
    return distinct.uv_bitmap(dt.events(spark, sf), "user_id", "ts", "1 hour", method="bitmaps")


def _beside_exact(approx, exact):
    """Exact counts, and whether the approximate ones lie within 5 percent of them."""
    near = F.abs(F.col("_approx") - F.col("uv")) <= F.greatest(F.lit(1), F.col("uv") * 0.05)
    return (exact.join(approx.withColumnRenamed("uv", "_approx"), "window_end", "full")
            .select("window_end", "uv", F.coalesce(near, F.lit(False)).alias("within_5_percent")))


@register("uv_hourly_hll", f"""
SELECT {HOUR_END_SQL} AS window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv, true AS within_5_percent
FROM events GROUP BY 1""")
def q_uv_hourly_hll(spark, sf):
    e = dt.events(spark, sf)
    return _beside_exact(distinct.uv_hll(e, "user_id", "ts", "1 hour", rsd=0.01),
                         distinct.uv_exact(e, "user_id", "ts", "1 hour"))


@register("uv_daily_hll_rollup", """
SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, CAST(count(DISTINCT user_id) AS BIGINT) AS uv,
       true AS within_5_percent
FROM events GROUP BY 1""")
def q_uv_daily_hll_rollup(spark, sf):
    """Hourly mergeable sketches rolled up to days by sketch union."""
    e = dt.events(spark, sf)
    hourly = distinct.uv_sketches(e, "user_id", "ts", "1 hour", lg_k=12)
    return _beside_exact(distinct.uv_rollup(hourly, "1 day"), distinct.uv_exact(e, "user_id", "ts", "1 day"))


@register("uv_running", f"""
SELECT event_id, window_end,
       CAST(sum(is_first) OVER (PARTITION BY window_end ORDER BY ts, event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS uv
FROM (SELECT event_id, ts, {HOUR_END_SQL} AS window_end,
             CASE WHEN row_number() OVER (PARTITION BY {HOUR_END_SQL}, {BITMAP_SQL} ORDER BY ts, event_id) = 1
                  THEN 1 ELSE 0 END AS is_first
      FROM events) f""")
def q_uv_running(spark, sf):
    # running count of distinct bitmap offsets, as the running bitmap job reports
    e = dt.events(spark, sf).withColumnRenamed("event_id", "seq")
    r = distinct.uv_running(e, "user_id", "ts", "seq", "1 hour", distinct_on="bitmap")
    return r.select(F.col("seq").alias("event_id"), "window_end", "uv")


# --------------------------------------------------------------- channel promotion

@register("channel_counts", _sliding_sql(f"{K_SQL} % 4 AS channel, event_type AS behavior",
                                         "event_type <> 'error'", 6, 4, "channel, behavior"))
def q_channel_counts(spark, sf):
    m = dt.market_rows(spark, sf, where=~F.col("event_type").eqNullSafe(dt.ERROR))
    return windows.sliding_count(m, ["channel", "behavior"], "ts", "1 day", "6 hours", method="panes")


# --------------------------------------------------------------- ad clicks

CLICK_RANK_SQL = f"""
SELECT event_id, user_id, {K_SQL} AS ad_id, ts, CAST(ts + INTERVAL 8 HOUR AS DATE) AS local_day,
       row_number() OVER (PARTITION BY user_id, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY ts, event_id) AS rn
FROM events WHERE event_type = 'click'"""


@register("ad_click_filter", f"""
SELECT event_id, user_id, ad_id, ts, local_day FROM ({CLICK_RANK_SQL}) r WHERE rn <= {CAP}""")
def q_ad_click_filter(spark, sf):
    c = dt.ad_clicks(spark, sf)
    r = caps.daily_cap(c, ["user_id"], "ts", "seq", CAP, TZ)
    return r.select(F.col("seq").alias("event_id"), "user_id", "ad_id", "ts", "local_day")


@register("ad_click_warnings", f"""
SELECT user_id, local_day, ts AS warn_ts, event_id AS warn_seq,
       'clicked {CAP} times or more today' AS warning
FROM ({CLICK_RANK_SQL}) r WHERE rn = {CAP}""")
def q_ad_click_warnings(spark, sf):
    return caps.daily_cap_warnings(dt.ad_clicks(spark, sf), ["user_id"], "ts", "seq", CAP, TZ)


@register("ad_clicks_by_province", f"""
SELECT n.n_name AS province, window_end, CAST(count(*) AS BIGINT) AS cnt
FROM (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, {ORIGIN}) + to_hours(CAST(6 * (g + 1) AS BIGINT)) AS window_end
      FROM ({CLICK_RANK_SQL}) r, range(0, 4) t(g) WHERE rn <= {CAP}) x
JOIN nation n ON n.n_nationkey = x.user_id % 25
GROUP BY n.n_name, window_end""")
def q_ad_clicks_by_province(spark, sf):
    passed = caps.daily_cap(dt.ad_clicks(spark, sf), ["user_id"], "ts", "seq", CAP, TZ)
    return jobs_ad_clicks_by_province(passed, dt.provinces(spark, sf), "1 day", "6 hours")


def jobs_ad_clicks_by_province(passed: DataFrame, provinces: DataFrame, size, slide) -> DataFrame:
    """Attach the province to each click, then count per province and
    window.  The nation table is a fixed-size dimension (25 rows), so the
    planner's size check broadcasts it and the join is a map-side lookup;
    a large dimension would be planned as a shuffle join instead."""
    named = passed.join(provinces, "nation_key")
    return windows.sliding_count(named, "province", "ts", size, slide)


# --------------------------------------------------------------- login risk

LOGIN_LAG_SQL = """
SELECT user_id, event_type, ts,
       lag(event_type, 1) OVER w AS p1_type, lag(ts, 1) OVER w AS p1_ts,
       lag(event_type, 2) OVER w AS p2_type, lag(ts, 2) OVER w AS p2_ts,
       lead(event_type, 1) OVER w AS n1_type, lead(ts, 1) OVER w AS n1_ts
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@register("login_fail_pairs", f"""
SELECT user_id, p1_ts AS first_ts, ts AS last_ts, CAST(2 AS BIGINT) AS n_fails FROM ({LOGIN_LAG_SQL}) l
WHERE event_type = 'error' AND p1_type = 'error' AND ts <= p1_ts + INTERVAL 2 HOUR""")
def q_login_fail_pairs(spark, sf):
    return patterns.login_fail_pairs(dt.logins(spark, sf), within="2 hours")


@register("match_consecutive", f"""
SELECT user_id, p2_ts AS first_ts, ts AS last_ts, CAST(3 AS BIGINT) AS n_fails FROM ({LOGIN_LAG_SQL}) l
WHERE event_type = 'error' AND p1_type = 'error' AND p2_type = 'error' AND ts < p2_ts + INTERVAL 12 HOUR""")
def q_match_consecutive(spark, sf):
    return patterns.match_consecutive(dt.logins(spark, sf), 3, within="12 hours")


@register("match_next", f"""
SELECT user_id, ts AS first_ts, n1_ts AS last_ts FROM ({LOGIN_LAG_SQL}) l
WHERE event_type = 'error' AND n1_type = 'error' AND n1_ts < ts + INTERVAL 2 HOUR""")
def q_match_next(spark, sf):
    return patterns.match_next(dt.logins(spark, sf), within="2 hours")


# --------------------------------------------------------------- orders

ORDER_NEXT_PAY_SQL = """
SELECT c.user_id AS order_id, c.ts AS start_ts, min(p.ts) AS next_pay_ts
FROM events c LEFT JOIN events p
  ON p.user_id = c.user_id AND p.event_type = 'purchase'
 AND (p.ts > c.ts OR (p.ts = c.ts AND p.event_id > c.event_id))
WHERE c.event_type = 'signup'
GROUP BY c.user_id, c.ts, c.event_id"""


@register("order_paid", f"""
SELECT order_id, start_ts, next_pay_ts AS end_ts FROM ({ORDER_NEXT_PAY_SQL}) x
WHERE next_pay_ts < start_ts + INTERVAL 1 DAY""")
def q_order_paid(spark, sf):
    return patterns.order_paid(dt.order_events(spark, sf), within="1 day")


@register("order_timeout", f"""
SELECT order_id, start_ts, start_ts + INTERVAL 1 DAY AS deadline FROM ({ORDER_NEXT_PAY_SQL}) x
WHERE next_pay_ts IS NULL OR next_pay_ts >= start_ts + INTERVAL 1 DAY""")
def q_order_timeout(spark, sf):
    return patterns.order_timeout(dt.order_events(spark, sf), within="1 day")


@register("order_timeout_state", """
SELECT order_id, create_ts, deadline, status FROM (
  SELECT user_id AS order_id, ts AS create_ts, ts + INTERVAL 1 DAY AS deadline,
         CASE WHEN n_ts IS NULL OR n_ts >= ts + INTERVAL 1 DAY THEN 'timeout'
              WHEN n_type = 'purchase' THEN 'payed' END AS status, event_type
  FROM (SELECT user_id, ts, event_type,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n_ts,
               lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n_type
        FROM events WHERE event_type IN ('signup', 'purchase')) o) s
WHERE event_type = 'signup' AND status IS NOT NULL""")
def q_order_timeout_state(spark, sf):
    return patterns.order_timeout_state(dt.order_events(spark, sf), within="1 day")


# --------------------------------------------------------------- reconciliation

PAYS_SQL = "SELECT CAST(user_id AS VARCHAR) AS tx_id, ts, event_id FROM events WHERE event_type = 'purchase'"
RCPT_SQL = "SELECT CAST(user_id AS VARCHAR) AS tx_id, ts, event_id FROM events WHERE event_type = 'click'"
WITHIN_SQL = "r.tx_id = p.tx_id AND r.ts BETWEEN p.ts - INTERVAL 1 HOUR AND p.ts + INTERVAL 1 HOUR"


def _reconcile(spark, sf):
    return joins.reconcile(dt.order_events(spark, sf, pays_only=True), dt.receipts(spark, sf), "1 hour", "1 hour")


@register("reconcile_interval_join", f"""
SELECT p.tx_id AS tx_id, p.ts AS pay_ts, p.event_id AS pay_seq, r.ts AS receipt_ts, r.event_id AS receipt_seq
FROM ({PAYS_SQL}) p JOIN ({RCPT_SQL}) r ON {WITHIN_SQL}""")
def q_reconcile_interval_join(spark, sf):
    pays = dt.order_events(spark, sf, pays_only=True)
    j = joins.interval_join(pays, dt.receipts(spark, sf), "tx_id", "tx_id", "ts", "ts",
                            "1 hour", "1 hour", "inner", "o_", "r_")
    return j.select(F.col("o_tx_id").alias("tx_id"), F.col("o_ts").alias("pay_ts"),
                    F.col("o_seq").alias("pay_seq"), F.col("r_ts").alias("receipt_ts"),
                    F.col("r_seq").alias("receipt_seq"))


@register("reconcile_full", f"""
SELECT CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'matched'
            WHEN r.tx_id IS NULL THEN 'pay_without_receipt' ELSE 'receipt_without_pay' END AS tag,
       COALESCE(p.tx_id, r.tx_id) AS tx_id, p.ts AS pay_ts, p.event_id AS pay_seq,
       r.ts AS receipt_ts, r.event_id AS receipt_seq
FROM ({PAYS_SQL}) p FULL OUTER JOIN ({RCPT_SQL}) r ON {WITHIN_SQL}""")
def q_reconcile_full(spark, sf):
    r = _reconcile(spark, sf)
    return r.select("tag", F.coalesce("o_tx_id", "r_tx_id").alias("tx_id"),
                    F.col("o_ts").alias("pay_ts"), F.col("o_seq").alias("pay_seq"),
                    F.col("r_ts").alias("receipt_ts"), F.col("r_seq").alias("receipt_seq"))


@register("pay_without_receipt", f"""
SELECT p.tx_id AS tx_id, p.ts AS pay_ts, p.event_id AS pay_seq FROM ({PAYS_SQL}) p
WHERE NOT EXISTS (SELECT 1 FROM ({RCPT_SQL}) r WHERE {WITHIN_SQL})""")
def q_pay_without_receipt(spark, sf):
    pays = dt.order_events(spark, sf, pays_only=True)
    j = joins.interval_join(pays, dt.receipts(spark, sf), "tx_id", "tx_id", "ts", "ts",
                            "1 hour", "1 hour", "left_anti", "o_", "r_")
    return j.select(F.col("o_tx_id").alias("tx_id"), F.col("o_ts").alias("pay_ts"),
                    F.col("o_seq").alias("pay_seq"))


@register("receipt_without_pay", f"""
SELECT r.tx_id AS tx_id, r.ts AS receipt_ts, r.event_id AS receipt_seq FROM ({RCPT_SQL}) r
WHERE NOT EXISTS (SELECT 1 FROM ({PAYS_SQL}) p WHERE {WITHIN_SQL})""")
def q_receipt_without_pay(spark, sf):
    pays = dt.order_events(spark, sf, pays_only=True)
    j = joins.interval_join(pays, dt.receipts(spark, sf), "tx_id", "tx_id", "ts", "ts",
                            "1 hour", "1 hour", "right_anti", "o_", "r_")
    return j.select(F.col("r_tx_id").alias("tx_id"), F.col("r_ts").alias("receipt_ts"),
                    F.col("r_seq").alias("receipt_seq"))


# Both sides of each transaction walked in order; ``q`` holds the waiting rows, all of side ``s``,
# ``p`` / ``r`` what a step matches, ``gone`` (of side ``gs``) what it gives up.
ONE_TO_ONE_SQL = f"""
WITH RECURSIVE ev AS (
  SELECT tx_id, ts, event_id, side, row_number() OVER (PARTITION BY tx_id ORDER BY ts, event_id, side) AS rn FROM (
    SELECT tx_id, ts, event_id, 'p' AS side FROM ({PAYS_SQL}) a
    UNION ALL SELECT tx_id, ts, event_id, 'r' AS side FROM ({RCPT_SQL}) b
    UNION ALL SELECT DISTINCT CAST(user_id AS VARCHAR), TIMESTAMP '9000-01-01', CAST(NULL AS BIGINT), 'z' FROM events) x),
walk AS (
  SELECT tx_id, CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(ts TIMESTAMP, id BIGINT)[]) AS q, 'p' AS s,
         CAST(NULL AS STRUCT(ts TIMESTAMP, id BIGINT)) AS p, CAST(NULL AS STRUCT(ts TIMESTAMP, id BIGINT)) AS r,
         CAST([] AS STRUCT(ts TIMESTAMP, id BIGINT)[]) AS gone, 'p' AS gs
  FROM (SELECT DISTINCT tx_id FROM ev) t
  UNION ALL
  SELECT tx_id, rn,
         CASE WHEN hit THEN alive[2:] WHEN side = 'z' THEN alive ELSE alive || [me] END,
         CASE WHEN hit THEN s ELSE side END,
         CASE WHEN hit THEN (CASE WHEN side = 'p' THEN me ELSE alive[1] END) END,
         CASE WHEN hit THEN (CASE WHEN side = 'r' THEN me ELSE alive[1] END) END,
         expired, s
  FROM (
    SELECT *, len(alive) > 0 AND s <> side AND side <> 'z' AS hit FROM (
      SELECT w.tx_id, e.rn, e.side, w.s, struct_pack(ts := e.ts, id := e.event_id) AS me,
             list_filter(w.q, lambda x: x.ts + INTERVAL 1 HOUR >= e.ts) AS alive,
             list_filter(w.q, lambda x: x.ts + INTERVAL 1 HOUR < e.ts) AS expired
      FROM walk w JOIN ev e ON e.tx_id = w.tx_id AND e.rn = w.rn + 1) a) b)"""


@register("reconcile_one_to_one", f"""{ONE_TO_ONE_SQL}
SELECT tx_id, 'matched' AS tag, p.ts AS pay_ts, p.id AS pay_seq, r.ts AS receipt_ts, r.id AS receipt_seq
FROM walk WHERE p IS NOT NULL
UNION ALL
SELECT tx_id, CASE WHEN gs = 'p' THEN 'pay_without_receipt' ELSE 'receipt_without_pay' END,
       CASE WHEN gs = 'p' THEN g.ts END, CASE WHEN gs = 'p' THEN g.id END,
       CASE WHEN gs = 'r' THEN g.ts END, CASE WHEN gs = 'r' THEN g.id END
FROM (SELECT tx_id, gs, unnest(gone) AS g FROM walk) u""")
def q_reconcile_one_to_one(spark, sf):
    return matching.reconcile_one_to_one(dt.order_events(spark, sf, pays_only=True), dt.receipts(spark, sf),
                                         "1 hour", "1 hour")


@register("login_fail_bursts", """
WITH RECURSIVE ev AS (
  SELECT user_id, ts, f, rn FROM (
    SELECT user_id, ts, event_type = 'error' AS f,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
    UNION ALL
    SELECT user_id, TIMESTAMP '9000-01-01' AS ts, false AS f, count(*) + 1 AS rn FROM events GROUP BY user_id) x),
walk AS (
  SELECT user_id, rn, CASE WHEN f THEN ts END AS os, CASE WHEN f THEN 1 ELSE 0 END AS n,
         CASE WHEN f THEN ts END AS lt,
         CAST(NULL AS TIMESTAMP) AS e_first, CAST(NULL AS TIMESTAMP) AS e_last, CAST(NULL AS BIGINT) AS e_n
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn,
         CASE WHEN w.os IS NOT NULL AND e.ts <= w.os + INTERVAL 5 HOUR
              THEN (CASE WHEN e.f THEN w.os END) ELSE (CASE WHEN e.f THEN e.ts END) END,
         CASE WHEN w.os IS NOT NULL AND e.ts <= w.os + INTERVAL 5 HOUR
              THEN (CASE WHEN e.f THEN w.n + 1 ELSE 0 END) ELSE (CASE WHEN e.f THEN 1 ELSE 0 END) END,
         CASE WHEN e.f THEN e.ts END,
         CASE WHEN w.os IS NOT NULL AND e.ts > w.os + INTERVAL 5 HOUR AND w.n >= 2 THEN w.os END,
         CASE WHEN w.os IS NOT NULL AND e.ts > w.os + INTERVAL 5 HOUR AND w.n >= 2 THEN w.lt END,
         CASE WHEN w.os IS NOT NULL AND e.ts > w.os + INTERVAL 5 HOUR AND w.n >= 2 THEN w.n END
  FROM walk w JOIN ev e ON e.user_id = w.user_id AND e.rn = w.rn + 1)
SELECT user_id, e_first AS first_ts, e_last AS last_ts, CAST(e_n AS BIGINT) AS n_fails
FROM walk WHERE e_n IS NOT NULL""")
def q_login_fail_bursts(spark, sf):
    return patterns.login_fail_bursts(dt.logins(spark, sf), horizon="5 hours")


# --------------------------------------------------------------- reference window sizes
# The reference's own window parameters (1 h / 5 min for items, 1 h / 5 s
# for ad clicks): 12- and 720-way fan-out, both on the pane path.

HOT_ITEMS_REF_COUNTS_SQL = f"""
SELECT item_id, window_end, CAST(count(*) AS BIGINT) AS cnt FROM (
  SELECT {K_SQL} AS item_id,
         time_bucket(INTERVAL 5 MINUTE, ts, {ORIGIN}) + to_minutes(CAST(5 * (g + 1) AS BIGINT)) AS window_end
  FROM events, range(0, 12) t(g) WHERE event_type = 'view') x
GROUP BY item_id, window_end"""


@register("hot_items_topn_ref", _topn_sql(HOT_ITEMS_REF_COUNTS_SQL, "item_id"))
def q_hot_items_topn_ref(spark, sf):
    counts = windows.sliding_count(_item_views(spark, sf), "item_id", "ts", "1 hour", "5 minutes")
    return topn.topn_per_window(counts, "item_id", TOP_N).select("window_end", "rank", "item_id", "cnt")


@register("ad_clicks_by_province_ref", f"""
SELECT n.n_name AS province, window_end, CAST(count(*) AS BIGINT) AS cnt
FROM (SELECT user_id, time_bucket(INTERVAL 5 SECOND, ts, {ORIGIN}) + to_seconds(CAST(5 * (g + 1) AS BIGINT)) AS window_end
      FROM ({CLICK_RANK_SQL}) r, range(0, 720) t(g) WHERE rn <= {CAP}) x
JOIN nation n ON n.n_nationkey = x.user_id % 25
GROUP BY n.n_name, window_end""")
def q_ad_clicks_by_province_ref(spark, sf):
    passed = caps.daily_cap(dt.ad_clicks(spark, sf), ["user_id"], "ts", "seq", CAP, TZ)
    return jobs_ad_clicks_by_province(passed, dt.provinces(spark, sf), "1 hour", "5 seconds")
