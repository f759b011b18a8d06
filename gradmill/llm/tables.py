"""Shared small helpers: reading input tables and keeping intermediate ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmill.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage, survives the loss of executors, and lets Spark know the
    real size of the table when it chooses how to join it.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is; NULL as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def slices(batches, rows: int = 256):
    """Arrow batches cut to at most ``rows`` rows: what a task builds from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
