"""One-to-one reconciliation: the batch form against a plain walk and against the stream form."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import _replay
from tidemark.operators import matching
from tidemark.streaming import processors, runner

SCHEMA = "tx_id string, ts_us bigint, seq bigint, waiting int"


def plain(pays, receipts, lo, hi):
    """Walk each key's rows in order with one list of all that waits."""
    out, keys = [], {}
    for is_pay, rows in ((True, pays), (False, receipts)):
        for k, t, s in rows:
            if t is None or k is None or (is_pay and k == ""):
                if not (is_pay and not k):
                    out.append((k, "pay_without_receipt", t, s, None, None) if is_pay
                               else (k, "receipt_without_pay", None, None, t, s))
            else:
                keys.setdefault(k, []).append((t, s, not is_pay))
    for k, rows in keys.items():
        waiting = []
        for t, s, receipt in sorted(rows):
            other = next((w for w in waiting if w[2] != receipt and (t <= w[0] + (hi if not w[2] else lo))), None)
            if other is None:
                waiting.append((t, s, receipt))
                continue
            waiting.remove(other)
            p, r = (other, (t, s)) if receipt else ((t, s), other)
            out.append((k, "matched", p[0], p[1], r[0], r[1]))
        out += [(k, "receipt_without_pay", None, None, t, s) if r else (k, "pay_without_receipt", t, s, None, None)
                for t, s, r in waiting]
    return sorted(out, key=str)


def frames(spark, pays, receipts):
    return tuple(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).withColumn("ts", F.timestamp_micros("ts_us"))
                 for rows in (pays, receipts))


def found(df):
    us = [F.unix_micros(c).alias(c) for c in ("pay_ts", "receipt_ts")]
    return sorted(map(tuple, df.select("tx_id", "tag", us[0], "pay_seq", us[1], "receipt_seq").collect()), key=str)


def dense(seed, n, keys, span):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), rng.randrange(span), i) for i in range(n)]
    return rows[::2], rows[1::2]


@pytest.mark.parametrize("lo, hi, bucket, keys, span", [
    (50, 50, None, ["a"], 20_000), (50, 50, 60e-6, ["a"], 20_000), (10, 300, 400e-6, ["a", "b"], 9_000),
    (300, 0, 301e-6, ["a"], 20_000), (0, 0, None, ["a", "b"], 500), (5000, 5000, 5001e-6, ["a"], 40_000)])
def test_batch_equals_plain_walk(spark, lo, hi, bucket, keys, span):
    pays, receipts = dense(1, 1500, keys, span)
    got = matching.reconcile_one_to_one(*frames(spark, pays, receipts), lo / 1e6, hi / 1e6, bucket=bucket)
    assert found(got) == plain(pays, receipts, lo, hi)


def test_chain_over_many_buckets(spark):
    """Receipts one bucket behind their pays: every bucket depends on the one before."""
    pays = [("hot", 100 * i, i) for i in range(60)] + [("hot", 20, 100)]
    receipts = [("hot", 100 * i + 90, 200 + i) for i in range(60)]
    got = matching.reconcile_one_to_one(*frames(spark, pays, receipts), 95e-6, 95e-6, bucket=100e-6)
    assert found(got) == plain(pays, receipts, 95, 95)


def test_odd_rows(spark):
    pays = [("a", 10, 1), ("a", 10, 1), ("", 5, 2), (None, 5, 3), ("n", None, 4), ("a", -7, 5), ("z", 1, None)]
    receipts = [("a", 10, 1), ("a", 12, 8), ("a", 12, 8), (None, 5, 9), ("", 6, 10), ("n", None, 11), ("z", 2, None)]
    got = matching.reconcile_one_to_one(*frames(spark, pays, receipts), 5e-6, 5e-6)
    want = [r for r in plain(pays[:6], receipts[:6], 5, 5)] + [("z", "matched", 1, None, 2, None)]
    assert found(got) == sorted(want, key=str)
    none = frames(spark, [], [])
    assert matching.reconcile_one_to_one(*none).count() == 0
    assert found(matching.reconcile_one_to_one(frames(spark, pays[:1], [])[0], none[1])) == [
        ("a", "pay_without_receipt", 10, 1, None, None)]
    with pytest.raises(ValueError):
        matching.reconcile_one_to_one(*none, 5, 5, bucket=5)


def test_batch_equals_stream(spark):
    pays, receipts = ([(k, t * 1000, s) for k, t, s in rows] for rows in dense(2, 600, ["a", "b", "c"], 60_000))
    p, r = (d.drop("waiting", "ts_us") for d in frames(spark, pays, receipts))
    stream = processors.reconcile_1to1_stream(_replay(spark, p, {"tx_id": "~p", "seq": -1}, n=3),
                                              _replay(spark, r, {"tx_id": "~r", "seq": -1}, n=3), 0.3, 0.3)
    got = runner.run_to_memory(stream, "t_r11_dense").where("tx_id NOT LIKE '~%'")
    want = matching.reconcile_one_to_one(p, r, 0.3, 0.3)
    ms = [F.expr(f"unix_millis({c}_ts)").alias(f"{c}_ms") for c in ("pay", "receipt")]
    want = want.select("tx_id", "tag", ms[0], "pay_seq", ms[1], "receipt_seq")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
