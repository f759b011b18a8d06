"""Counting, filtering and view queries over plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_count(df: DataFrame, text: str) -> DataFrame:
    """``(word, count)`` of single-space tokens; empty tokens count too."""
    words = df.select(F.explode(F.split(text, " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def like_count(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Number of rows whose ``col`` is LIKE ``pattern``, as ``matches``."""
    return df.where(F.col(col).like(pattern)).agg(F.count(F.lit(1)).alias("matches"))


def row_count(df: DataFrame, *by: Column) -> DataFrame:
    """Number of rows, optionally per group, as ``rows``."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def take_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def view_filter(df: DataFrame, view: str, col: str, value) -> DataFrame:
    """Register ``df``, select everything from the view, filter through ``df``'s column."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT * FROM {view}").filter(df[col] == value)
