"""Rows from driver collections and lines from text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def from_rows(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """A small driver-side collection as a DataFrame with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)


def text_lines(spark: SparkSession, source: str | Iterable[str]) -> DataFrame:
    """One ``line`` column from a text path, or from strings kept as they are."""
    if isinstance(source, str):
        return spark.read.text(source).withColumnRenamed("value", "line")
    return from_rows(spark, [(line,) for line in source], "line string")


def lines_of(df: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """Split a text column into ``(…keep, line_no, line)``."""
    return df.select(*keep, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
