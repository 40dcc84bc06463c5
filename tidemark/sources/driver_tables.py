"""Map the driver's star-schema tables onto the reference record shapes.

``events(event_id, ts, user_id, event_type, value, props)`` plays every
reference stream: ``view`` is a page/item view, ``click`` an HTTP GET and an
ad click, ``error`` a failed login (any other type a success), ``signup`` an
order creation and ``purchase`` a payment; ``click`` rows double as payment
receipts.  Item / url / ad id is ``k`` from ``props``; the tie-break ``seq``
is ``event_id``; a user's province is ``nation.n_name`` with
``n_nationkey = user_id % 25``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values of the mapping.
VIEW, CLICK, ERROR, SIGNUP, PURCHASE = "view", "click", "error", "signup", "purchase"
N_NATIONS = 25
N_CHANNELS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def k_col() -> F.Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _raw(spark, sf_dir, where=None) -> DataFrame:
    """``events``, optionally filtered on its own columns first: a predicate
    on raw columns reaches the parquet scan, one on a mapped (CASE) column
    does not."""
    e = events(spark, sf_dir)
    return e if where is None else e.where(where)


def item_views(spark, sf_dir, where=None) -> DataFrame:
    """UserBehavior-shaped rows: (user_id, item_id, behavior, ts, seq)."""
    e = _raw(spark, sf_dir, where)
    return e.select(
        "user_id", k_col().alias("item_id"),
        F.when(F.col("event_type") == VIEW, F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        "ts", F.col("event_id").alias("seq"))


def access_hits(spark, sf_dir, where=None) -> DataFrame:
    """ApacheLog-shaped rows: (ip, user, event_time, method, url, seq)."""
    e = _raw(spark, sf_dir, where)
    return e.select(
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.col("user_id").cast("string").alias("user"),
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == CLICK, F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
        F.concat(F.lit("/k/"), k_col().cast("string")).alias("url"),
        F.col("event_id").alias("seq"))


def market_rows(spark, sf_dir, where=None) -> DataFrame:
    """MarketUserBehavior-shaped rows; ``error`` plays the uninstall."""
    e = _raw(spark, sf_dir, where)
    return e.select(
        "user_id",
        F.when(F.col("event_type") == ERROR, F.lit("UNINSTALL")).otherwise(F.col("event_type")).alias("behavior"),
        (k_col() % N_CHANNELS).alias("channel"),
        "ts", F.col("event_id").alias("seq"))


def ad_clicks(spark, sf_dir) -> DataFrame:
    """AdClickEvent-shaped rows: (user_id, ad_id, nation_key, ts, seq)."""
    e = events(spark, sf_dir).where(F.col("event_type") == CLICK)
    return e.select("user_id", k_col().alias("ad_id"),
                    (F.col("user_id") % N_NATIONS).cast("int").alias("nation_key"),
                    "ts", F.col("event_id").alias("seq"))


def provinces(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("province"))


def logins(spark, sf_dir, where=None) -> DataFrame:
    """LoginEvent-shaped rows: (user_id, event_type fail/success, ts, seq)."""
    e = _raw(spark, sf_dir, where)
    return e.select(
        "user_id",
        F.when(F.col("event_type") == ERROR, F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        "ts", F.col("event_id").alias("seq"))


def order_events(spark, sf_dir, pays_only: bool = False) -> DataFrame:
    """OrderEvent-shaped rows: (order_id, event_type create/pay, tx_id, ts, seq)."""
    e = events(spark, sf_dir).where(
        (F.col("event_type") == PURCHASE) if pays_only else F.col("event_type").isin(SIGNUP, PURCHASE))
    is_pay = F.col("event_type") == PURCHASE
    return e.select(
        F.col("user_id").alias("order_id"),
        F.when(is_pay, F.lit("pay")).otherwise(F.lit("create")).alias("event_type"),
        F.when(is_pay, F.col("user_id").cast("string")).otherwise(F.lit("")).alias("tx_id"),
        "ts", F.col("event_id").alias("seq"))


def receipts(spark, sf_dir) -> DataFrame:
    """ReceiptEvent-shaped rows: (tx_id, pay_channel, ts, seq)."""
    e = events(spark, sf_dir).where(F.col("event_type") == CLICK)
    return e.select(F.col("user_id").cast("string").alias("tx_id"),
                    F.lit("click").alias("pay_channel"), "ts", F.col("event_id").alias("seq"))
