"""Looking into parameter tables: shapes, ranges and distributions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradmill.functions import arrays

#: Buckets of a parameter histogram, besides one on either side.
BINS = 20


def param_shapes(params: DataFrame) -> DataFrame:
    """``(layer, param, shape, n_values)`` of a parameter table."""
    return params.select("layer", "param", "shape", F.size("values").alias("n_values"))


def value_range(df: DataFrame, values: str) -> tuple[float, float]:
    """Smallest and largest element of an array column."""
    row = df.agg(F.min(F.array_min(values)), F.max(F.array_max(values))).first()
    return float(row[0]), float(row[1])


def minmax_scale(df: DataFrame, values: str, into: str = "scaled") -> DataFrame:
    """Scale every element to [0, 1] by the range of the whole column."""
    low, high = value_range(df, values)
    return df.withColumn(into, arrays.minmax(F.col(values), low, high))


def value_histogram(
    df: DataFrame, values: str, low: float, high: float, bins: int, by: list[str]
) -> DataFrame:
    """``(by…, bucket, n)`` over fixed edges; values outside go to -1 and ``bins``.

    The edges do not depend on the data, so partial counts of any two runs or
    partitions add up exactly.
    """
    width = (high - low) / bins
    cell = F.floor((F.col("v").cast("double") - low) / width)
    cell = F.least(F.greatest(cell, F.lit(-1)), F.lit(bins)).cast("int")
    flat = df.select(*by, F.explode(values).alias("v"))
    return flat.groupBy(*by, cell.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def bucket_counts(values: np.ndarray, low: float, high: float, bins: int = BINS) -> np.ndarray:
    """The counts of :func:`value_histogram` for values inside a task, buckets -1 to ``bins`` in order."""
    cells = np.nan_to_num(np.floor((values - low) / ((high - low) / bins)))
    return np.bincount(np.clip(cells, -1, bins).astype(np.int64) + 1, minlength=bins + 2)


def counted_buckets(counts: DataFrame, params: list[tuple[str, str]], keep: list[str], bins: int = BINS) -> DataFrame:
    """``(keep…, layer, param, bucket, n)`` out of ``(keep…, part)``, the bucket counts of all ``params`` in a row.

    Counts of the same ``keep`` are added up; empty buckets have no row.
    """
    names = F.array(*(F.struct(F.lit(layer).alias("layer"), F.lit(param).alias("param")) for layer, param in params))
    sums = counts.select(*keep, F.posexplode("part").alias("at", "n")).groupBy(*keep, "at").agg(F.sum("n").alias("n"))
    named = F.element_at(names, (F.floor(F.col("at") / (bins + 2)) + 1).cast("int"))
    return sums.where("n > 0").withColumn("of", named).select(
        *keep, "of.layer", "of.param", (F.col("at") % (bins + 2) - 1).alias("bucket"), F.col("n").cast("bigint").alias("n")
    )


def param_histogram(params: DataFrame, low: float, high: float, bins: int = BINS) -> DataFrame:
    """The value distribution of every parameter."""
    return value_histogram(params, "values", low, high, bins, ["layer", "param"])
