"""Sample tables laid out on disk for minibatches.

Every row belongs to a fine class, a hash of its key. Classes lie in folders of one
written table, sorted by class within their files. An epoch deals whole classes to its
batches, in an order that a hash of class and epoch gives, so batches differ from epoch
to epoch while no row moves. A step names its classes: Spark reads their folders only, in
as many tasks as the batch needs, whatever the size of the table. Batches so small that one task
takes several are read as a run of them, one after the other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.functions.hashing import keyed_hash
from gradmill.session import scratch_dir

#: Classes in a batch: what one epoch puts together, another takes apart.
FINE = 4
#: Folders at most; with more classes a folder holds several, told apart by the statistics of its files.
FOLDERS = 4096
#: Rows in a file, and in a task of a step.
TASK_ROWS = 8192
#: Batches in a run at most: a query names the classes of all of them.
RUN = 64
FOLDER, CLASS, BATCH = "_folder", "_class", "_batch"


def dealt(classes: int, n_batches: int, seed: int, epoch: int) -> list[list[int]]:
    """The classes of every batch of an epoch."""

    def draw(c: int) -> tuple[int, int]:
        return int(hashlib.md5(f"{c}:{seed}:{epoch}".encode()).hexdigest()[:8], 16), c

    order = sorted(range(classes), key=draw)
    return [order[b::n_batches] for b in range(n_batches)]


@dataclass
class Batches:
    """A written table of ``classes`` classes for ``n_batches`` batches, and the tasks a batch takes."""

    table: DataFrame
    classes: int
    n_batches: int
    seed: int
    tasks: int
    #: Batches that one task takes.
    in_task: int = 1

    def of(self, epoch: int) -> list[list[int]]:
        return dealt(self.classes, self.n_batches, self.seed, epoch)

    def rows(self, classes: list[int]) -> DataFrame:
        """The rows of some classes; nothing but their folders is read."""
        return self._chosen(classes).coalesce(self.tasks)

    def _chosen(self, classes: list[int]) -> DataFrame:
        def among(column: str, values) -> str:
            return f"{column} IN ({', '.join(map(str, sorted(values)))})"

        chosen = self.table.where(among(FOLDER, {c % FOLDERS for c in classes}))
        if self.classes > FOLDERS:
            chosen = chosen.where(among(CLASS, classes))
        return chosen.drop(FOLDER, CLASS)

    def run(self, batches: list[list[int]], key: str, shown: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The rows of several batches in one partition, in the order of ``batch``, their number in the list.

        ``shown`` makes other rows of them, under the same ``key``, in tasks of its own.
        """
        rows = self._chosen([c for classes in batches for c in classes])
        rows = shown(rows).repartition(1) if shown else rows.coalesce(1)
        pairs = ", ".join(f"{c}, {n}" for n, classes in enumerate(batches) for c in classes)
        batch = F.element_at(F.expr(f"map({pairs})"), class_of(key, self.classes, self.seed))
        return rows.withColumn(BATCH, batch).sortWithinPartitions(BATCH)


def class_of(key: str, classes: int, seed: int) -> Column:
    """The fine class of a row."""
    return F.pmod(keyed_hash(F.col(key), seed), F.lit(classes)).cast("int")


def lay_out(rows: DataFrame, key: str, n_rows: int, batch_size: int, seed: int, task_rows: int = TASK_ROWS) -> Batches:
    """Write ``rows`` once for batches of about ``batch_size`` of their ``n_rows`` rows."""
    n_batches = math.ceil(n_rows / batch_size)
    classes = n_batches * FINE
    # a large folder is written by several tasks
    files = max(1, math.ceil(n_rows / min(classes, FOLDERS) / task_rows))
    salt = F.pmod(F.xxhash64(key), F.lit(files))
    marked = rows.withColumn(CLASS, class_of(key, classes, seed)).withColumn(FOLDER, F.pmod(CLASS, F.lit(FOLDERS)))
    path = scratch_dir(rows.sparkSession, "minibatches")
    marked.repartition(FOLDER, salt).sortWithinPartitions(FOLDER, CLASS).write.option(
        "maxRecordsPerFile", task_rows).partitionBy(FOLDER).parquet(path)
    stored = rows.sparkSession.read.schema(marked.schema).parquet(path)
    tasks = max(1, math.ceil(batch_size / task_rows))
    return Batches(stored, classes, n_batches, seed, tasks, min(RUN, max(1, task_rows // batch_size)))
