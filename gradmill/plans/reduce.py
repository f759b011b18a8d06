"""Summing one vector per task over the cluster."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values per row: long vectors travel as blocks that different tasks can add up.
BLOCK = 1 << 16
#: Vectors that one task of the last level may add up without a level before it.
FAN = 16
#: In this slot are notes: rows beside the vectors, which nothing adds up.
NOTES = -1
SCHEMA = "block int, slot int, n bigint, loss double, part array<double>"

Partial = tuple[int, float, np.ndarray]


def _batch(rows: list[tuple[int, int, int, float, np.ndarray]]) -> pa.RecordBatch:
    block, slot, n, loss, part = zip(*rows)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in part])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(block, pa.int32()), pa.array(slot, pa.int32()), pa.array(n, pa.int64()),
            pa.array(loss, pa.float64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part))),
        ],
        names=["block", "slot", "n", "loss", "part"],
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> dict[int, list]:
    """Running sums by block: memory is one vector, however many rows stream in."""
    sums: dict[int, list] = {}
    for batch in batches:
        flat = batch.column("part").flatten().to_numpy()
        ends = np.cumsum(batch.column("part").value_lengths().to_numpy())
        heads = zip(*(batch.column(c).to_pylist() for c in ("block", "n", "loss")))
        for (block, n, loss), part in zip(heads, np.split(flat, ends[:-1])):
            if block in sums:
                sums[block][0] += n
                sums[block][1] += loss
                sums[block][2] += part
            else:
                sums[block] = [n, loss, part.copy()]
    return sums


def _add(batches):
    for block, (n, loss, part) in _fold(batches).items():
        yield _batch([(block, 0, n, loss, part)])


def vector_sum(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Partial | None],
    parts: int,
    size: int,
    notes: Callable[[DataFrame], None] | None = None,
) -> Partial | None:
    """Run ``work`` once per partition and add up its ``(n, loss, vector)`` results.

    ``parts`` is the number of partitions of ``df``, ``size`` the length of a
    vector. The vectors pass through a tree: one level that adds up to ``FAN``
    of them per block, or for more a level of about ``sqrt(parts)`` slots before
    it, so that the driver receives one vector whatever the size of the
    cluster. A single partition has nothing to add. None if no task had rows.

    With ``notes``, ``work`` also returns a list of ``(number, values)``. These rows
    come out of the same pass, stay on the executors and are handed over as a table
    ``(number, part)``; it can be read while ``notes`` runs.
    """
    fan = math.isqrt(max(parts, 1) - 1) + 1 if parts > FAN else 1
    blocks = max(1, min(parts, -(-size // BLOCK)))

    def task(batches):
        done = work(batches)
        if done is None:
            return
        n, loss, vector, *noted = done
        for number, values in noted[0] if noted else ():
            yield _batch([(0, NOTES, number, 0.0, np.asarray(values, float))])
        slot = TaskContext.get().partitionId() % fan
        for block, at in enumerate(range(0, max(1, len(vector)), BLOCK)):
            yield _batch([(block, slot, n, loss, vector[at : at + BLOCK])])

    partials = df.mapInArrow(task, SCHEMA)
    if notes:
        passed = partials.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            done = _summed(passed.where(F.col("slot") != NOTES), parts, fan, blocks)
            notes(passed.where(F.col("slot") == NOTES).select(F.col("n").alias("number"), "part"))
            return done
        finally:
            passed.unpersist()
    return _summed(partials, parts, fan, blocks)


def _summed(partials: DataFrame, parts: int, fan: int, blocks: int) -> Partial | None:
    if fan > 1:
        partials = partials.repartition(fan, "slot", "block").mapInArrow(_add, SCHEMA)
    if parts > 1:
        partials = partials.repartition(blocks, "block").mapInArrow(_add, SCHEMA)
    sums = _fold(partials.toArrow().to_batches())
    if not sums:
        return None
    n, loss, _ = sums[0]
    return n, loss, np.concatenate([sums[b][2] for b in sorted(sums)])
