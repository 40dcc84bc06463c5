"""The nine end-to-end jobs, as a user calls them.

Batch functions take bounded DataFrames of the record shapes in
``tidemark.sources.schemas`` (with ``ts`` and ``seq``; see
``with_event_time``) and return DataFrames.  ``*_stream`` functions take
streaming DataFrames and return streaming DataFrames to be started by the
caller (``writeStream`` / ``streaming.runner``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.hashing import BITMAP_BITS, bitmap_offset
from tidemark.operators import caps, distinct, joins, late, patterns, topn, windows
from tidemark.streaming import joins as sjoins, processors, sliding, visitors, windows as swin


# ------------------------------------------------------------ hot items / urls

def hot_items(behavior: DataFrame, size="1 hour", slide="5 minutes", n: int = 5) -> DataFrame:
    """Top ``n`` items by page views per sliding window."""
    pv = behavior.where(F.col("behavior") == "pv")
    return topn.topn_per_window(windows.sliding_count(pv, "item_id", "ts", size, slide), "item_id", n)


def hot_items_stream(behavior: DataFrame, size="1 hour", slide="5 minutes",
                     delay="0 seconds") -> DataFrame:
    """Page views per item and finished window, in append mode (ascending
    timestamps: zero delay).  Feed to ``foreachBatch(topn_sink)``, which ranks them."""
    s = swin.event_time(behavior, "ts", delay)
    pv = s.where(F.when(F.col("ts").isNotNull(), F.col("behavior") == "pv"))
    return sliding.sliding_counts(pv, "item_id", "ts", size, slide).select("window_end", "item_id", "cnt")


def hot_urls(log: DataFrame, size="10 minutes", slide="5 seconds", n: int = 5, disorder="1 second",
             lateness="60 seconds", arrival: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Top ``n`` GET urls per sliding window and the late-row table.

    Without an ``arrival`` column the input order is event order and
    nothing is late.  With it, each row counts only in windows that were
    still open when it arrived (watermark = max earlier event time -
    ``disorder``, window open until its end + ``lateness``); rows whose
    windows were all closed form the late table.
    """
    d = log.withColumnRenamed("event_time", "ts") if "event_time" in log.columns else log
    if arrival is None:
        counts = windows.sliding_count(d.where(F.col("method") == "GET"), "url", "ts", size, slide)
        return topn.topn_per_window(counts, "url", n), d.where(F.lit(False)).withColumn("is_late", F.lit(True))
    marked = late.with_newest_closed(d, "ts", arrival, "seq", size, slide, disorder, lateness)
    gets = marked.where(F.col("method") == "GET")
    counts = late.sliding_count_with_lateness(gets, "url", "ts", arrival, "seq", size, slide,
                                              newest_closed="newest_closed")
    # the same watermark decides both: a GET row counts in a window or is in the late table
    gone = gets.withColumn("is_late", late.all_closed("ts", "newest_closed", size, slide)).where("is_late")
    return topn.topn_per_window(counts, "url", n), gone.drop("newest_closed")


def hot_urls_stream(log: DataFrame, size="10 minutes", slide="5 seconds", disorder="1 second",
                    lateness="60 seconds") -> DataFrame:
    """Tagged rows for ``update`` mode: ``count`` rows (url, window_end, cnt), each replacing earlier ones
    of its url and window until the window's end + ``lateness``, and ``late`` rows, the GET rows whose
    windows had all closed by then, with the columns of ``log``.  One operator counts and tells what is
    late, so every GET row is in one of the two.  The watermark advances on rows of all methods."""
    d = log.withColumnRenamed("event_time", "ts") if "event_time" in log.columns else log
    s = swin.event_time(d, "ts", disorder)
    gets = s.where(F.when(F.col("ts").isNotNull(), F.col("method") == "GET"))
    return sliding.sliding_counts(gets, "url", "ts", size, slide, lateness,
                                  carried=[c for c in gets.columns if c != "url"])


def hot_urls_stream_counts(log: DataFrame, size="10 minutes", slide="5 seconds", disorder="1 second",
                           lateness="60 seconds") -> DataFrame:
    """The ``count`` rows of :func:`hot_urls_stream`; feed to ``foreachBatch(upsert_topn)``."""
    return hot_urls_stream(log, size, slide, disorder, lateness).where("tag = 'count'").select("window_end", "url", "cnt")


# ------------------------------------------------------------ page views / visitors

def page_views(behavior: DataFrame, size="1 hour", salted: bool = False, buckets: int = 8) -> DataFrame:
    pv = behavior.where(F.col("behavior") == "pv")
    if salted:
        return windows.salted_count(pv, None, "ts", size, buckets, out="pv")
    return windows.tumbling_count(pv, None, "ts", size, out="pv")


def page_views_stream(behavior: DataFrame, size="1 hour", buckets: int = 8, delay="0 seconds",
                      salt_cols=("seq",)) -> DataFrame:
    """(window_end, pv) per finished window: counts per (salt, window), then their sums (append mode),
    so no task counts a whole window's rows."""
    s = swin.event_time(behavior, "ts", delay)
    pv = s.where(F.when(F.col("ts").isNotNull(), F.col("behavior") == "pv"))
    return swin.salted_count_stream(pv, "ts", size, buckets, list(salt_cols), out="pv")


def unique_visitors(events: DataFrame, size="1 hour", method: str = "exact", rsd: float = 0.01) -> DataFrame:
    if method == "exact":
        return distinct.uv_exact(events, "user_id", "ts", size)
    if method == "bitmap":
        return distinct.uv_bitmap(events, "user_id", "ts", size)
    if method == "hll":
        return distinct.uv_hll(events, "user_id", "ts", size, rsd)
    if method == "running":
        return distinct.uv_running(events, "user_id", "ts", "seq", size)
    raise ValueError(method)


def unique_visitors_stream(events: DataFrame, size="1 hour", method: str = "exact",
                           delay="0 seconds", rsd: float = 0.01) -> DataFrame:
    s = swin.event_time(events, "ts", delay)
    if method == "exact":
        return swin.uv_stream(s, "user_id", "ts", size)
    if method == "bitmap":  # ids whose hashes meet count once, as in the batch form
        return swin.uv_stream(s, bitmap_offset("user_id", BITMAP_BITS), "ts", size)
    if method == "running":     # a row per input row
        return visitors.uv_running_stream(s, "user_id", "ts", "seq", size)
    if method == "running_bitmap":
        return visitors.uv_running_stream(s, "user_id", "ts", "seq", size, distinct_on="bitmap")
    if method == "hll":
        from tidemark.functions.time import duration_us
        w = F.window("ts", f"{duration_us(size)} microseconds")
        return s.groupBy(w.alias("w")).agg(F.approx_count_distinct("user_id", rsd).alias("uv")).select(
            F.col("w.end").alias("window_end"), "uv")
    raise ValueError(method)


# ------------------------------------------------------------ market

def channel_promotion(market: DataFrame, size="1 hour", slide="5 seconds") -> DataFrame:
    m = market.where(~F.col("behavior").eqNullSafe("UNINSTALL"))
    return windows.sliding_count(m, ["channel", "behavior"], "ts", size, slide)


def channel_promotion_stream(market: DataFrame, size="1 hour", slide="5 seconds",
                             processing_time: bool = True, disorder="0 seconds") -> DataFrame:
    """Processing-time windows stamp each row with ``current_timestamp()``
    at ingest (the reference job uses processing time)."""
    m = market.withColumn("ts", F.current_timestamp()) if processing_time else market
    m = swin.event_time(m, "ts", disorder)
    m = m.where(F.when(F.col("ts").isNotNull(), ~F.col("behavior").eqNullSafe("UNINSTALL")))
    return sliding.sliding_counts(m, ["channel", "behavior"], "ts", size, slide)


def ad_clicks(clicks: DataFrame, cap: int = 100, size="1 hour", slide="5 seconds",
              tz: str = "Asia/Shanghai", keys=("user_id", "ad_id")) -> tuple[DataFrame, DataFrame]:
    """(clicks per province and sliding window after the cap, warnings)."""
    passed = caps.daily_cap(clicks, list(keys), "ts", "seq", cap, tz)
    counts = windows.sliding_count(passed, "province", "ts", size, slide)
    return counts, caps.daily_cap_warnings(clicks, list(keys), "ts", "seq", cap, tz)


def ad_clicks_stream(clicks: DataFrame, cap: int = 100, size="1 hour", slide="5 seconds",
                     tz: str = "Asia/Shanghai", disorder="0 seconds", salts: int = 1) -> tuple[DataFrame, DataFrame]:
    """(windowed clicks per province after the cap, warnings).  The cap
    processor keeps the event time (``eventTimeColumnName``), so the
    windowed count chains after it in append mode.  Input needs
    ``province``.  ``salts``: parts that a key's clicks are capped in first, for hot keys."""
    s = swin.event_time(clicks, "ts", disorder)
    tagged = processors.daily_cap_stream(s, cap, tz, extra=("province",), salts=salts)
    counts = sliding.sliding_counts(tagged.where(F.col("tag") == "pass"), "province", "ts", size, slide)
    return counts, tagged.where(F.col("tag") == "warning")


# ------------------------------------------------------------ risk / orders / payments

def login_risk(logins: DataFrame, method: str = "bursts", within="2 seconds", horizon="5 seconds",
               n: int = 2) -> DataFrame:
    if method == "bursts":
        return patterns.login_fail_bursts(logins, horizon=horizon, min_fails=n)
    if method == "pairs":
        return patterns.login_fail_pairs(logins, within=within)
    if method == "consecutive":
        return patterns.match_consecutive(logins, n, within=within)
    if method == "next":
        return patterns.match_next(logins, within=within)
    raise ValueError(method)


def login_risk_stream(logins: DataFrame, method: str = "bursts", within="2 seconds",
                      horizon="5 seconds", disorder="2 seconds", n: int = 2, spread: bool = False) -> DataFrame:
    """``spread`` deals a user with very many rows over time buckets (not for bursts, which
    depend on all that came before)."""
    s = swin.event_time(logins, "ts", disorder)
    if method == "bursts":
        return processors.fail_bursts_stream(s, horizon, n)
    if method == "pairs":
        return processors.fail_pairs_stream(s, within, spread)
    if method in ("consecutive", "next"):
        return processors.consecutive_fails_stream(s, n if method == "consecutive" else 2, within, spread)
    raise ValueError(method)


def order_timeout(orders: DataFrame, within="15 minutes", method: str = "pattern") -> DataFrame:
    """``pattern``: every create with ``matched`` / deadline; ``state``:
    timer semantics (one open order per key)."""
    if method == "pattern":
        return patterns.followed_by(orders, "order_id", within=within)
    return patterns.order_timeout_state(orders, "order_id", within=within)


def order_timeout_stream(orders: DataFrame, within="15 minutes", method: str = "pattern",
                         disorder="0 seconds", spread: bool = False) -> DataFrame:
    """``spread`` deals an order id with very many rows over time buckets."""
    s = swin.event_time(orders, "ts", disorder)
    if method == "pattern":
        return processors.followed_by_stream(s, within, spread=spread)
    return processors.order_timeout_stream(s, within, spread=spread)


def reconcile(orders: DataFrame, receipts: DataFrame, within="5 seconds") -> DataFrame:
    return joins.reconcile(orders, receipts, within, within)


def reconcile_stream(orders: DataFrame, receipts: DataFrame, within="5 seconds", disorder="0 seconds") -> DataFrame:
    return sjoins.reconcile_stream(swin.event_time(orders, "ts", disorder),
                                   swin.event_time(receipts, "ts", disorder), within, within)
