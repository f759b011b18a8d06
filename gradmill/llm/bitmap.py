"""A fixed-size bitmap of hashes, as a constant inside expressions.

One bit per hash value modulo ``bits``: a filter without false negatives that
takes 512 KB (2 MB) whatever the number of hashes, so it may go to every task. It
spares a shuffle of rows that cannot find a partner; an exact join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 22
MANY_BITS = 1 << 24


def of_hashes(hashes: DataFrame, column: str, bits: int = BITS) -> Column:
    """The bitmap of a long column, as a scalar ``array<long>``; NULLs are passed over."""
    h = F.col(column)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    at = F.shiftrightunsigned(h, 6).bitwiseAND(bits // 64 - 1)
    words = hashes.where(h.isNotNull()).groupBy(at.alias("at")).agg(F.bit_or(bit).alias("word"))
    every = hashes.sparkSession.range(bits // 64).withColumnRenamed("id", "at")
    dense = every.join(words, "at", "left").select("at", F.coalesce("word", F.lit(0)).alias("word"))
    packed = dense.agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("all"))
    return packed.select(F.col("all.word")).scalar()


def may_hold(bitmap: Column, h: Column, bits: int = BITS) -> Column:
    """False only if no value like ``h`` went into the bitmap of so many bits."""
    word = F.get(bitmap, F.shiftrightunsigned(h, 6).bitwiseAND(bits // 64 - 1).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    return word.bitwiseAND(bit) != 0
