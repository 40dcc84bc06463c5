"""Fixed, hand-declared record schemas (nothing is inferred).

Epoch-second fields are kept as ``bigint`` at the scan; ``with_event_time``
adds the typed event-time column ``ts`` and an arrival sequence ``seq``.
"""

from pyspark.sql import types as T

USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

LOGIN = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

ORDER = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("tx_id", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

RECEIPT = T.StructType([
    T.StructField("tx_id", T.StringType()),
    T.StructField("pay_channel", T.StringType()),
    T.StructField("ts_s", T.LongType()),
])

MARKET_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

ACCESS_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])

BY_KIND = {
    "user_behavior": USER_BEHAVIOR,
    "ad_click": AD_CLICK,
    "login": LOGIN,
    "order": ORDER,
    "receipt": RECEIPT,
}
