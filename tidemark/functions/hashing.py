"""Hash expressions: the bitmap offset used for hash-bitmap distinct counts
and a deterministic salt for two-phase aggregation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the hash-bitmap distinct count: a 31-multiplier polynomial
# string hash over the decimal digits of the id, masked to 2^29 bits.
BITMAP_BITS = 29
HASH_MULTIPLIER = 31


def bitmap_offset(c, bits: int = BITMAP_BITS) -> Column:
    """Offset of an id in a ``2**bits`` bitmap: polynomial hash (multiplier 31,
    64-bit wrap-around) of its decimal string, masked to ``bits`` bits.

    Masking after every step gives the same low bits as masking once at the
    end, because the low ``bits`` bits of a product/sum depend only on the
    low ``bits`` bits of the operands.
    """
    c = F.col(c) if isinstance(c, str) else c
    mask = (1 << bits) - 1
    chars = F.split(c.cast("string"), "")
    return F.aggregate(
        chars, F.lit(0).cast("bigint"),
        lambda acc, ch: (acc * HASH_MULTIPLIER + F.ascii(ch)).bitwiseAND(F.lit(mask).cast("bigint")),
    )


def salt(cols, buckets: int = 8) -> Column:
    """Deterministic salt in ``[0, buckets)`` from the given columns."""
    cols = [F.col(x) if isinstance(x, str) else x for x in cols]
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")
