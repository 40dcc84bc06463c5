"""Golden values on the four reference-shaped sample inputs."""

from pyspark.sql import functions as F

from tidemark.functions.hashing import bitmap_offset
from tidemark.operators import caps, joins, patterns, windows


def test_bitmap_offsets(spark):
    df = spark.createDataFrame([(543462,), (937166,), (99999999999,), (-5,)], "u bigint")
    got = [r[0] for r in df.select(bitmap_offset("u")).collect()]
    assert got == [493197308, 70035764, 460005529, 1448]


def test_order_paid_and_timeout(ref):
    o = ref["order"]
    paid = patterns.order_paid(o, within="15 minutes")
    late = patterns.order_timeout(o, within="15 minutes")
    assert paid.count() == 37
    assert sorted(r.order_id for r in late.collect()) == [34756, 34767]


def test_order_timeout_state(ref):
    r = patterns.order_timeout_state(ref["order"], within="15 minutes")
    st = {x.order_id: x.status for x in r.collect()}
    assert st[34756] == "timeout" and st[34767] == "timeout"
    assert 34768 not in st  # pay without create: ignored
    assert sum(v == "payed" for v in st.values()) == 37


def test_interval_join_pairs(ref):
    pays = ref["order"].where(F.col("tx_id") != "")
    j = joins.interval_join(pays, ref["receipt"], "tx_id", "tx_id", "ts", "ts",
                            "5 seconds", "5 seconds", "inner", "o_", "r_")
    got = {r.o_tx_id: r.r_ts_s - r.o_ts_s for r in j.collect()}
    assert got == {"sd76f87d6": 3, "3hu3k2432": 3, "435kjb45d": -4, "3243hr9h9": -3, "329d09f9f": 0}


def test_reconcile_full(ref):
    r = joins.reconcile(ref["order"], ref["receipt"], "5 seconds", "5 seconds")
    tags = {x.tag: x.n for x in r.groupBy("tag").agg(F.count("*").alias("n")).collect()}
    assert tags == {"matched": 5, "pay_without_receipt": 34, "receipt_without_pay": 35}


def test_login_pairs_and_consecutive(ref):
    lg = ref["login"]
    pairs = patterns.login_fail_pairs(lg, within="2 seconds").collect()
    assert sorted((p.user_id, p.first_ts.timestamp() - 1558430000, p.last_ts.timestamp() - 1558430000)
                  for p in pairs) == [(1035, 842, 842), (1035, 845, 845), (1035, 845, 846)]
    assert patterns.match_consecutive(lg, 2, within="2 seconds").count() == 3
    assert patterns.match_consecutive(lg, 3, within="2 seconds").count() == 1
    assert patterns.match_consecutive(lg, 3, within="5 seconds").count() == 3


def test_login_bursts(ref):
    b = patterns.login_fail_bursts(ref["login"], horizon="5 seconds").collect()
    assert [(r.user_id, int(r.first_ts.timestamp()), int(r.last_ts.timestamp()), r.n_fails) for r in b] == [
        (1035, 1558430842, 1558430846, 5)]


def test_ad_click_cap_and_province(ref):
    ad = ref["ad_click"]
    passed = caps.daily_cap(ad, ["user_id", "ad_id"], "ts", "seq", 100, "Asia/Shanghai")
    assert passed.count() == 122
    w = caps.daily_cap_warnings(ad, ["user_id", "ad_id"], "ts", "seq", 100, "Asia/Shanghai").collect()
    assert [(r.user_id, r.ad_id, int(r.warn_ts.timestamp())) for r in w] == [(937166, 1715, 1511661700)]
    counts = windows.sliding_count(passed, "province", "ts", "1 hour", "5 seconds")
    assert counts.count() == 5988
    per = {r.province: r.n for r in counts.groupBy("province").agg(F.count("*").alias("n")).collect()}
    assert per == {"beijing": 1460, "guangdong": 828, "shanghai": 780, "zhejiang": 735,
                   "henan": 735, "jiangsu": 730, "hebei": 720}
    assert counts.agg(F.max("cnt")).first()[0] == 101
    direct = windows.sliding_count(passed, "province", "ts", "1 hour", "5 seconds", panes=False)
    assert direct.exceptAll(counts).count() == 0 and counts.exceptAll(direct).count() == 0
