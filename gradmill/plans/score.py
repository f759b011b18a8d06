"""Scoring tables with a model."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradmill.functions import arrays
from gradmill.functions.pixels import Pixels, sliced
from gradmill.operators.lookup import with_class_name
from gradmill.operators.model_store import to_vector
from gradmill.plans.models import Model

Params = DataFrame | np.ndarray


def rows_of(column: pa.Array, width: int, keys: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(x, good)``: the complete rows of a list column as float64, and which rows they are.

    Lists may be nested to any depth. A row that is NULL or has a NULL inside is
    not complete; a complete row without exactly ``width`` values is an error
    that names its key.
    """
    n = len(column)
    owner, missing = np.arange(n), np.zeros(n, bool)
    while True:
        missing[owner[column.is_null().to_numpy(zero_copy_only=False)]] = True
        if not (pa.types.is_list(column.type) or pa.types.is_large_list(column.type)):
            break
        owner = np.repeat(owner, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        column = column.flatten()
    good = ~missing
    counts = np.bincount(owner, minlength=n)
    if (wrong := np.flatnonzero(good & (counts != width))).size:
        at = int(wrong[0])
        raise ValueError(f"{_row_name(at, keys)}: {counts[at]} values where {width} are expected")
    values = column.to_numpy(zero_copy_only=False).astype(np.float64)
    return values[good[owner]].reshape(-1, width), good


def check_labels(label1: np.ndarray, classes: int, keys: pa.Array | None = None) -> None:
    """Raise, naming the key, unless all labels are whole numbers from 1 to ``classes``."""
    good = (label1 >= 1) & (label1 <= classes) & (label1 == np.floor(label1))
    if (wrong := np.flatnonzero(~good)).size:
        at = int(wrong[0])
        raise ValueError(f"{_row_name(at, keys)}: label {label1[at]:g} is not one of 1 to {classes}")


def _row_name(at: int, keys: pa.Array | None) -> str:
    return f"row {at} of its batch" if keys is None else f"key {keys[at].as_py()!r}"


def _placed(out: pa.Array, good: np.ndarray) -> pa.Array:
    """``out`` at the good rows, NULL at the others."""
    if good.all():
        return out
    return out.take(pa.array(np.where(good, np.cumsum(good) - 1, 0), mask=~good))


def _list_array(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    ends = np.arange(n + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _best_array(out: np.ndarray, k: int) -> pa.Array:
    """The ``k`` best (class, score) pairs per row, best first, ties to the lower class.

    Equal to nine digits is a tie, as in :func:`decided_class`.
    """
    order = np.argsort(-np.round(out, 9), axis=1, kind="stable")[:, :k].astype(np.int32)
    ends = np.arange(len(out) + 1, dtype=np.int32) * order.shape[1]
    pairs = pa.StructArray.from_arrays(
        [pa.array(order.ravel()), pa.array(np.take_along_axis(out, order, 1).ravel())],
        names=["class_id", "score"],
    )
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


def _scored(df, model, params, keep, features, kind: str, emit) -> DataFrame:
    vectors = {name: to_vector(model, p) for name, p in params.items()}
    shared = df.sparkSession.sparkContext.broadcast(vectors)
    kind = T.StructType.fromDDL(f"v {kind}")["v"].dataType
    schema = T.StructType(
        [f for f in df.select(*keep).schema] + [T.StructField(name, kind) for name in vectors]
    )

    if isinstance(features, Pixels):
        inputs, pixels = features.inputs(), features.reader()
    else:
        inputs, pixels = [F.col(features)], None
    n_keep = len(keep)

    def read(columns, keys):
        if pixels is None:
            return rows_of(columns[0], model.inputs, keys)
        there = columns[0].is_valid()
        good = there.to_numpy(zero_copy_only=False)
        x = pixels([c.filter(there) for c in columns]) if good.any() else np.zeros((0, model.inputs))
        return x, good

    def score(batches):
        for batch in batches if pixels is None else sliced(batches):
            if not batch.num_rows:
                continue
            columns = batch.columns[:n_keep]
            x, good = read(batch.columns[n_keep:], columns[0] if columns else None)
            for vector in shared.value.values():
                out = model.forward(vector, x).reshape(len(x), -1) if len(x) else np.zeros((0, 0))
                columns.append(_placed(emit(out), good))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    named = [c.alias(f"_x{i}") for i, c in enumerate(inputs)]
    return df.select(*keep, *named).mapInArrow(score, schema)


def predict(
    df: DataFrame,
    model: Model,
    params: Params | Mapping[str, Params],
    keep: list[str],
    features: str | Pixels = "features",
) -> DataFrame:
    """``keep`` plus the output vector of the model as ``scores``.

    ``features`` is an array column, or images to be transformed on the way in.
    Lazy and shuffle-free: keys and labels travel with their row, so nothing has
    to be paired afterwards. Rows whose array is NULL or has a NULL inside get NULL;
    a length that the model does not take is an error. A mapping ``{column: params}`` scores several
    versions of the model in the same pass.
    """
    versions = params if isinstance(params, Mapping) else {"scores": params}
    return _scored(df, model, versions, keep, features, "array<double>", _list_array)


def predict_top_k(
    df: DataFrame, model: Model, params: Params, keep: list[str], k: int = 5,
    features: str | Pixels = "features",
) -> DataFrame:
    """``keep`` plus the ``k`` best ``(class_id, score)`` pairs as ``best``.

    The choice is made where the scores are, so a row with a thousand classes
    brings back ``k`` values only.
    """
    kind = "array<struct<class_id:int,score:double>>"
    return _scored(
        df, model, {"best": params}, keep, features, kind, lambda out: _best_array(out, k)
    )


def predict_class(scores: Column) -> Column:
    """1-based class of the best score; ties as in :func:`decided_class`."""
    return decided_class(scores) + 1


def decided_class(scores: Column, digits: int = 9) -> Column:
    """0-based best class where scores equal to ``digits`` digits go to the lower class."""
    return arrays.argmax(F.transform(scores, lambda s: F.round(s, digits)))


def top_k_named(best: DataFrame, names: DataFrame, keep: list[str]) -> DataFrame:
    """``(keep…, rank, class_id, score, name)`` out of the pairs in ``best``."""
    pairs = best.select(*keep, F.posexplode("best").alias("rank", "b"))
    flat = pairs.select(*keep, (F.col("rank") + 1).alias("rank"), "b.class_id", "b.score")
    return with_class_name(flat, names)


def write_predictions(scored: DataFrame, path: str) -> None:
    """Store a scored table."""
    scored.write.mode("errorifexists").parquet(path)


def save_table(scored: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store a scored table as ``name`` of the session's catalog, at ``path``.

    Rows lie in buckets by ``key`` and are sorted in them: tables with the same buckets
    are joined on it without a shuffle. One file per bucket. A table of this name is an error.
    """
    rows = scored.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("errorifexists").saveAsTable(name)
