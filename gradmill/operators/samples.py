"""Sample tables: positional pairing, global normalization and label bases."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradmill.functions import arrays
from gradmill.session import scratch_dir


@dataclass(frozen=True)
class Normalizer:
    """Scalar mean and population deviation of all training values."""

    mean: float
    std: float


def normalizer_stats(df: DataFrame, values: str) -> DataFrame:
    """One row ``(n, mean, std)`` over every element of every array."""
    flat = df.select(F.explode(values).alias("v"))
    v = F.col("v").cast("double")
    return flat.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


def fit_normalizer(df: DataFrame, values: str) -> Normalizer:
    """Run :func:`normalizer_stats`; only its two scalars reach the driver."""
    row = normalizer_stats(df, values).first()
    return Normalizer(row["mean"], row["std"])


def normalize(df: DataFrame, stats: Normalizer, values: str, into: str = "features") -> DataFrame:
    """Apply training statistics to any split."""
    return df.withColumn(into, arrays.zscore(F.col(values), stats.mean, stats.std))


def to_one_based(label: Column) -> Column:
    return label.cast("int") + 1


def to_zero_based(label1: Column) -> Column:
    return (label1 - 1).cast("int")


def labelled_samples(
    df: DataFrame, stats: Normalizer, key: str, values: str, label: str
) -> DataFrame:
    """``(id, features, label1)`` ready for training or scoring."""
    return normalize(df, stats, values).select(
        F.col(key).alias("id"), "features", to_one_based(F.col(label)).alias("label1")
    )


def self_target(df: DataFrame, key: str = "id", features: str = "features") -> DataFrame:
    """Autoencoder samples: the target is the input."""
    return df.select(key, features, F.col(features).alias("target"))


def _ranked(df: DataFrame, key: str, ranges: int | None) -> tuple[DataFrame, DataFrame]:
    """``(rows, sizes)``: ``df`` sorted into key ranges and written, and the rows before each range.

    Every row knows its range ``_range`` and its place ``_place`` in it. One scan
    and one shuffle; what follows reads the written table.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = df.schema.fields + [T.StructField("_range", T.IntegerType()), T.StructField("_place", T.LongType())]
    schema = T.StructType(fields)

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(at, at + batch.num_rows, dtype=np.int64)
            at += batch.num_rows
            whole = [*batch.columns, pa.array(np.full(len(places), part, np.int32)), pa.array(places)]
            yield pa.RecordBatch.from_arrays(whole, schema.names)

    path = scratch_dir(spark, "ranges")
    df.repartitionByRange(n, key).sortWithinPartitions(key).mapInArrow(number, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    # one row per range, so this window stays small
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return rows, sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_first"), "n")


def _numbered(rows: DataFrame, sizes: DataFrame, into: str) -> DataFrame:
    firsts = sizes.select("_range", "_first")
    position = (F.col("_first") + F.col("_place")).alias(into)
    names = [c for c in rows.columns if c not in ("_range", "_place")]
    return rows.join(firsts, "_range").select(*names, position)


def with_position(
    df: DataFrame, key: str, into: str = "pos", ranges: int | None = None
) -> DataFrame:
    """Number the rows 0, 1, … in the order of a unique key.

    Rows are sorted into key ranges (as many as the session has shuffle
    partitions), each is numbered where it lies and shifted by the number of rows
    before it. Any cuts give the same numbers.
    """
    return _numbered(*_ranked(df, key, ranges), into)


def running_total(df: DataFrame, key: str, value: str, into: str, ranges: int | None = None) -> DataFrame:
    """The sum of ``value`` over all rows with a smaller ``key``, summed by key ranges like ``with_position``."""
    rows, _ = _ranked(df, key, ranges)
    totals = rows.groupBy("_range").agg(F.sum(value).alias("_n"))
    # one row per range, so this window stays small
    earlier = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("_range", F.coalesce(earlier, F.lit(0)).alias("_before"))
    within = F.sum(value).over(
        Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1))
    total = (F.col("_before") + F.coalesce(within, F.lit(0))).alias(into)
    return rows.join(totals, "_range").select(*df.columns, total)


def zip_by_position(
    a: DataFrame, b: DataFrame, key_a: str, key_b: str, ranges: int | None = None
) -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b``; sizes must agree."""
    ranked_a, ranked_b = _ranked(a, key_a, ranges), _ranked(b, key_b, ranges)
    n_a, n_b = (sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for _, sizes in (ranked_a, ranked_b))
    if n_a != n_b:
        raise ValueError(f"cannot zip {n_a} rows with {n_b} rows")
    return _numbered(*ranked_a, "pos").join(_numbered(*ranked_b, "pos"), "pos")
