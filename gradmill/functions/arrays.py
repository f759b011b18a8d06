"""Expressions over dense array columns (class scores, samples, parameters)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that names a computed array would otherwise compute it anew for
    every element, and every further use multiplies that.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def argmax(scores: Column) -> Column:
    """0-based index of the first maximum; NULL for an empty array."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def top_k(scores: Column, k: int = 5) -> Column:
    """The ``k`` best ``(class_id, score)`` structs, best first, ties to the lower class.

    Plain values are sorted to find the k-th best; only what reaches it is
    turned into structs and sorted again.
    """

    def pick(s: Column, least: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.get(s, i) >= least)
        keyed = F.transform(
            at, lambda i: F.struct(F.get(s, i).alias("score"), (-i).alias("neg"))
        )
        return F.transform(
            F.slice(F.sort_array(keyed, asc=False), 1, k),
            lambda b: F.struct((-b["neg"]).alias("class_id"), b["score"].alias("score")),
        )

    def kth(s: Column) -> Column:
        return F.get(F.sort_array(s, asc=False), F.least(F.size(s), F.lit(k)) - 1)

    return let(scores, lambda s: let(kth(s), lambda least: pick(s, least)))


def reshape2d(values: Column, rows: int, cols: int) -> Column:
    """Row-major split of a flat array into ``rows`` arrays of ``cols`` values."""
    return let(
        values,
        lambda v: F.transform(
            F.sequence(F.lit(0), F.lit(rows - 1)),
            lambda r: F.slice(v, r * cols + 1, F.lit(cols)),
        ),
    )


def zscore(values: Column, mean, std) -> Column:
    """``(x - mean) / std`` for every element, in double precision."""
    return F.transform(values, lambda x: (x.cast("double") - mean) / std)


def minmax(values: Column, low, high) -> Column:
    """``(x - low) / (high - low)`` for every element."""
    return F.transform(values, lambda x: (x.cast("double") - low) / (high - low))


def log_softmax(scores: Column) -> Column:
    """Log-probabilities of a score vector, shifted by its maximum."""

    def from_peak(s: Column, peak: Column) -> Column:
        total = F.aggregate(s, F.lit(0.0), lambda acc, v: acc + F.exp(v - peak))
        return let(peak + F.log(total), lambda shift: F.transform(s, lambda v: v - shift))

    return let(scores, lambda s: let(F.array_max(s), lambda peak: from_peak(s, peak)))
