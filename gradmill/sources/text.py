"""Class-name files: the line number is the class."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    # one class list is one file; a final line break does not open a new class
    body = F.regexp_replace("value", r"\r?\n\z", "")
    return text.select(F.posexplode(F.split(body, r"\r?\n")).alias("class_id", "line"))


def class_list(spark: SparkSession, path: str) -> DataFrame:
    """``(class_id, synonyms)``: comma-separated names, trimmed; blank line = no names.

    A name in double quotes may hold commas, and quotes written twice.
    """
    # a field is quoted or has no comma; quotes inside a plain field are part of it
    field = r'(?:^|,)\s*("(?:[^"]|"")*"(?=\s*(?:,|$))|[^,]*)'
    names = F.transform(F.regexp_extract_all("line", F.lit(field), F.lit(1)), lambda name: F.trim(name))
    names = F.transform(names, lambda name: F.when(
        name.rlike(r'^".*"$') & (F.length(name) > 1),
        F.trim(F.replace(F.substring(name, F.lit(2), F.length(name) - 2), F.lit('""'), F.lit('"'))),
    ).otherwise(name))
    blank = F.array().cast("array<string>")
    return _numbered_lines(spark, path).select(
        "class_id", F.when(F.col("line") == "", blank).otherwise(names).alias("synonyms")
    )


def label_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(class_id, name)`` with trailing white space removed."""
    return _numbered_lines(spark, path).select(
        "class_id", F.regexp_replace("line", r"\s+\z", "").alias("name")
    )
