"""Parameter tables: ``(layer, param, shape array<int>, values array<double>)``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmill.functions.names import model_file_name
from gradmill.plans.models import Model

SCHEMA = "layer string, param string, shape array<int>, values array<double>"
KEY = ["layer", "param", "shape"]
#: A model must fit the memory of one task; checked before anything is fetched.
MAX_BYTES = 1 << 30


def to_table(spark: SparkSession, model: Model, vector: np.ndarray) -> DataFrame:
    """The parameters of a model as rows."""
    parts = model.split(vector)
    ends = np.cumsum([0, *(value.size for value in parts.values())]).astype(np.int32)
    flat = np.concatenate([value.ravel() for value in parts.values()]).astype(np.float64)
    table = pa.table({
        "layer": [layer for layer, _ in parts], "param": [param for _, param in parts],
        "shape": pa.array([list(v.shape) for v in parts.values()], pa.list_(pa.int32())),
        "values": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
    })
    return spark.createDataFrame(table, SCHEMA)


def to_vector(model: Model, params: DataFrame | np.ndarray) -> np.ndarray:
    """The flat vector of a parameter table.

    Only rows that fit a parameter of the model in name and length are fetched,
    so the size of the model, which is checked, bounds what reaches the driver.
    """
    if isinstance(params, np.ndarray):
        return params
    if 8 * model.size > MAX_BYTES:
        raise ValueError(f"model of {8 * model.size} bytes is over the bound of {MAX_BYTES}")
    shapes = model.shapes()
    fits = F.lit(False)
    for (layer, param), shape in shapes.items():
        named = (F.col("layer") == layer) & (F.col("param") == param)
        fits = fits | (named & (F.size("values") == int(np.prod(shape))))
    rows = params.where(fits).select("layer", "param", "shape", "values").limit(len(shapes) + 1)
    found = {}
    table = rows.toArrow()
    heads = zip(*(table.column(c).to_pylist() for c in ("layer", "param", "shape")))
    for n, (layer, param, shape) in enumerate(heads):
        key = layer, param
        if key in found:
            raise ValueError(f"parameter {key} is in the table twice")
        values = table.column("values")[n].values.to_numpy(zero_copy_only=False)
        found[key] = values.astype(np.float64).reshape(shape)
    for key, shape in shapes.items():
        if key not in found or found[key].shape != shape:
            raise ValueError(f"parameter {key} of shape {shape} is missing from the table")
    return model.join(found)


def save(params: DataFrame, folder: str, name: str) -> str:
    """Write a parameter table under a time-stamped name and return its path."""
    path = f"{folder.rstrip('/')}/{model_file_name(name)}"
    params.write.mode("errorifexists").parquet(path)
    return path


def load(spark: SparkSession, path: str) -> DataFrame:
    """Read a saved parameter table."""
    return spark.read.schema(SCHEMA).parquet(path)


def warm_start(target: DataFrame, source: DataFrame, match_all: bool = False) -> DataFrame:
    """Copy ``source`` values into ``target`` where layer, parameter and shape agree.

    What does not match keeps the values of ``target``; with ``match_all`` it is
    an error instead.
    """
    if match_all:
        left = target.join(source, KEY, "left_anti").select("layer", "param").take(5)
        if left:
            raise ValueError(f"no pretrained values for {[tuple(r) for r in left]}")
    given = source.select(*KEY, F.col("values").alias("_given"))
    chosen = F.coalesce("_given", "values").alias("values")
    return target.join(given, KEY, "left").select(*KEY, chosen)
