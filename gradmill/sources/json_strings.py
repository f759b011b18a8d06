"""JSON held in a string column."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def infer_json_schema(df: DataFrame, col: str) -> T.StructType:
    """The schema that fits every string of ``col``: one aggregate with partial results.

    Strings that are no JSON are passed over; numbers with a fraction are doubles.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(col)).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()  # no string holds an object
    for variant, plain in ((r"\bOBJECT<", "STRUCT<"), (r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE"), (r"\bVOID\b", "STRING")):
        found = re.sub(variant, plain, found)
    return T.StructType.fromDDL(f"s {found}")["s"].dataType


def read_json_strings(
    df: DataFrame, col: str, schema: T.StructType | str | None = None, into: str = "parsed"
) -> DataFrame:
    """Add the parsed document as a struct column, next to the other columns.

    Parsing itself always runs in ``from_json``; give the schema whenever it is
    known, since finding it costs an extra pass.
    """
    return df.withColumn(into, F.from_json(col, schema or infer_json_schema(df, col)))
