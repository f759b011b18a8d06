"""Lookups in dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmill.operators.samples import with_position


def lookup(facts: DataFrame, dim: DataFrame, key: str, join: str | None = None) -> DataFrame:
    """Left join of ``facts`` to ``dim`` on ``key`` (unique in ``dim``).

    Spark broadcasts the dimension if its size, known or measured at run time, is
    under the session's threshold; else both sides are shuffled, and adaptive
    execution splits the partitions of hot keys. ``join`` may name a strategy
    hint, such as ``merge``, for dimensions that are known to be large.
    """
    return facts.join(dim.hint(join) if join else dim, key, "left")


def numbered_values(df: DataFrame, value: str, into: str) -> DataFrame:
    """``(value, into)``: the distinct values in order, numbered from 0."""
    return with_position(df.select(value).distinct(), value, into)


def with_class_name(
    df: DataFrame, names: DataFrame, class_id: str = "class_id", name: str = "name",
    join: str | None = None,
) -> DataFrame:
    """Add the name of a class index; unknown classes stay with a NULL name."""
    dim = names.select(F.col("class_id").alias(class_id), name)
    return lookup(df, dim, class_id, join)


def collapse_by_name(
    scored: DataFrame, names: DataFrame, keys: list[str], classes: int
) -> DataFrame:
    """``(keys…, name, score)`` of ``scores`` arrays; where names repeat, the highest class id wins.

    ``names`` is reduced to one of the ``classes`` per name first, so that scores
    need no grouping. Classes without a name are left out.
    """
    last = names.where(F.col("class_id").between(0, classes - 1)).groupBy("name").agg(F.max("class_id").alias("class_id"))
    flat = scored.select(*keys, F.posexplode("scores").alias("class_id", "score"))
    return flat.join(last, "class_id").select(*keys, "name", "score")
