"""Data-parallel training.

``sync``       one Spark job per step: tasks add up the gradient of their part
               of the minibatch, the sum is reduced over the cluster and the
               driver updates the parameters. The result does not depend on
               the partitioning (up to rounding). Minibatches are read from a
               table laid out for them (:mod:`layout`): a step costs what its
               batch costs. Batches so small that one task takes several are
               taken in runs: one job, whose task makes their steps in order.
``local_sgd``  one job per epoch: a fixed number of workers, to which rows belong
               by a hash of their key, run minibatch steps and the results are
               averaged, weighted by rows (Zinkevich et al., 2010). For batches
               too small to pay a job. The cluster does not change the result.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradmill.functions.hashing import keyed_hash
from gradmill.operators import model_store
from gradmill.operators.inspect import bucket_counts, counted_buckets, param_histogram
from gradmill.operators.metrics import MetricsLog
from gradmill.plans import layout
from gradmill.plans.kernels import CRITERIA
from gradmill.plans.models import SETTINGS, Model
from gradmill.plans.optim import Optimizer
from gradmill.plans.reduce import vector_sum
from gradmill.plans.score import check_labels, rows_of

Trigger = Callable[[int, int], bool]
#: The samples of an epoch out of what is stored, such as randomly cropped images.
View = Callable[[DataFrame, int], DataFrame]
#: Epochs between two writes of the log (also written at every checkpoint and at the end).
FLUSH_EPOCHS = 10


def max_epoch(n: int) -> Trigger:
    """True once ``n`` epochs are done."""
    return lambda epoch, step: epoch >= n


def every_epoch() -> Trigger:
    """True at the end of every epoch (the only time it is asked)."""
    return lambda epoch, step: True


def several_iteration(n: int) -> Trigger:
    """True at every ``n``-th step."""
    return lambda epoch, step: step > 0 and step % n == 0


@dataclass
class Log:
    """Where and when a run is recorded.

    ``parameters`` says at which steps the distribution of the parameters is recorded. In
    ``local_sgd`` the tasks ask it (so it has to be picklable) at their workers' own steps, and
    what is recorded at a step are the values of all workers that made it.
    """

    metrics: MetricsLog
    run_id: str
    parameters: Trigger = field(default_factory=lambda: several_iteration(50))
    low: float = -2.0
    high: float = 2.0
    pending: dict[str, list[tuple[str, int, float]]] = field(default_factory=dict)

    def add(self, phase: str, values: list[tuple[str, int, float]]) -> None:
        self.pending.setdefault(phase, []).extend(values)

    def flush(self) -> None:
        """Write what has gathered, one file per phase rather than one per epoch."""
        for phase in list(self.pending):
            self.metrics.append(self.run_id, phase, self.pending.pop(phase))


@dataclass
class Validation:
    """What is measured on held-out data, and when."""

    data: DataFrame
    methods: tuple[str, ...] = ("Top1Accuracy",)
    trigger: Trigger = field(default_factory=every_epoch)


class Checkpoint:
    """Parameters and optimizer state per epoch, never overwritten once they are complete.

    ``path/saved/epoch=…`` holds the data. When it is written, a row in
    ``path/complete/epoch=…`` says so. What a lost driver left without that row is
    ignored by :meth:`load` and replaced by the next :meth:`save`.
    """

    COMPLETE = "step bigint, epoch int"

    def __init__(self, path: str, trigger: Trigger | None = None):
        self.path = path.rstrip("/")
        self.trigger = trigger or every_epoch()

    def epochs(self, spark: SparkSession) -> list[int]:
        """The complete epochs."""
        try:
            marks = spark.read.schema(self.COMPLETE).parquet(f"{self.path}/complete")
            return sorted(r["epoch"] for r in marks.select("epoch").collect())
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":  # nothing saved yet
                return []
            raise

    def save(self, spark: SparkSession, model: Model, fit: Fit) -> None:
        if fit.epoch in self.epochs(spark):
            raise ValueError(f"epoch {fit.epoch} is already saved in {self.path}")
        packed = fit.optim.pack()
        state = [("_fit", "state", [len(packed)], packed.tolist()),
                 ("_fit", "progress", [1], [float(fit.step)])]
        table = model_store.to_table(spark, model, fit.vector).union(
            spark.createDataFrame(state, model_store.SCHEMA)
        )
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/saved/epoch={fit.epoch}")
        mark = spark.createDataFrame([(fit.step,)], "step bigint")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/complete/epoch={fit.epoch}")

    def load(self, spark: SparkSession, model: Model, fit: Fit) -> bool:
        """Continue ``fit`` from the newest complete epoch, if there is one."""
        saved = self.epochs(spark)
        if not saved:
            return False
        rows = spark.read.schema(model_store.SCHEMA).parquet(f"{self.path}/saved/epoch={saved[-1]}")
        own = {r["param"]: r["values"] for r in rows.where("layer = '_fit'").collect()}
        fit.vector = model_store.to_vector(model, rows.where("layer <> '_fit'"))
        fit.optim.unpack(np.array(own["state"]))
        fit.epoch, fit.step = saved[-1], int(own["progress"][0])
        return True


@dataclass
class Fit:
    """The state of a training run."""

    vector: np.ndarray
    optim: Optimizer
    epoch: int = 0
    step: int = 0
    skipped: int = 0
    losses: list[tuple[int, float]] = field(default_factory=list)
    scores: list[tuple[str, int, float]] = field(default_factory=list)


class GradientSum(NamedTuple):
    """Sums over the complete rows, and how many rows were passed over for a NULL."""

    rows: int
    loss: float
    gradient: np.ndarray
    skipped: int


def _pair(df: DataFrame, features: str, target: str, key: str | None, *more: str) -> DataFrame:
    """``(x, y, key, more…)``; labels travel as one-element arrays, so that both columns read alike."""
    named = F.col(key).cast("string") if key else F.lit(None).cast("string")
    x, y = F.col(features).alias("x"), _as_array(df, target).alias("y")
    return df.select(x, y, named.alias("key"), *more)


def _read_pair(batch, model: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """``(x, y, skipped)`` of the rows of a batch that are complete on both sides, checked."""
    labelled = model.criterion != "mse"
    keys = batch.column(2)
    x, good_x = rows_of(batch.column(0), model.inputs, keys)
    y, good_y = rows_of(batch.column(1), 1 if labelled else model.outputs, keys)
    good = good_x & good_y
    x, y = x[good[good_x]], y[good[good_y]]
    if labelled:
        y = y[:, 0]
        check_labels(y, model.outputs, keys.take(pa.array(np.flatnonzero(good))))
    return x, y, int(len(good) - good.sum())


def gradient_sum(
    df: DataFrame, model: Model, vector: np.ndarray, features: str, target: str, parts: int,
    key: str | None = None,
) -> GradientSum | None:
    """The sums of all rows of ``df``; None if there is no complete one.

    A complete row of a wrong length, or with a label out of range, is an error
    that names its ``key``.
    """
    shared = df.sparkSession.sparkContext.broadcast(vector)

    def work(batches):
        n, loss, total, skipped = 0, 0.0, np.zeros(model.size), 0
        for batch in batches:
            x, y, nulls = _read_pair(batch, model)
            skipped += nulls
            if len(x):
                part, gradient = model.loss_and_gradient(shared.value, x, y)
                n, loss, total = n + len(x), loss + part, total + gradient
        return (n, loss, np.append(total, skipped)) if n or skipped else None

    try:
        done = vector_sum(_pair(df, features, target, key), work, parts, model.size + 1)
    finally:
        shared.destroy()
    if done is None or not done[0]:
        return None
    return GradientSum(done[0], done[1], done[2][:-1], int(done[2][-1]))


def _steps_of_run(
    df: DataFrame, model: Model, fit: Fit, features: str, target: str, n_batches: int
) -> list[tuple[int, float]]:
    """The steps of several batches in order, in one task; updates ``fit`` and returns ``(rows, loss)`` of every batch.

    ``df`` is one partition in the order of its batches (:meth:`layout.Batches.run`). What
    returns is one vector with the state of the optimizer, and three numbers per batch.
    """
    start = df.sparkSession.sparkContext.broadcast((fit.vector, fit.optim))
    state = model.size + len(fit.optim.pack())

    def work(batches):
        vector, optim = start.value[0], copy.deepcopy(start.value[1])
        rows, losses, skipped = np.zeros((3, n_batches))
        at, gradient = None, 0.0

        def finish():
            nonlocal vector
            if at is not None and rows[at]:
                vector = optim.step(vector, gradient / rows[at])

        for batch in batches:
            if batch.column(3).null_count:
                raise ValueError("a view has to keep the keys of its rows")
            of = batch.column(3).to_numpy()
            for n in np.unique(of).tolist():
                within = np.flatnonzero(of == n)
                x, y, nulls = _read_pair(batch.slice(within[0], len(within)), model)
                if n != at:
                    finish()
                    at, gradient = n, 0.0
                skipped[at] += nulls
                if len(x):
                    loss, part = model.loss_and_gradient(vector, x, y)
                    rows[at], losses[at], gradient = rows[at] + len(x), losses[at] + loss, gradient + part
        finish()
        return int(rows.sum()), float(losses.sum()), np.concatenate([vector, optim.pack(), rows, losses, skipped])

    try:
        done = vector_sum(_pair(df, features, target, "_key", layout.BATCH), work, 1, state + 3 * n_batches)
    finally:
        start.destroy()
    if done is None:
        return []
    rows, losses, skipped = done[2][state:].reshape(3, n_batches)
    fit.vector = done[2][: model.size]
    fit.optim.unpack(done[2][model.size : state])
    fit.skipped += int(skipped[rows > 0].sum())
    return list(zip(rows.astype(int).tolist(), losses.tolist()))


def _as_array(df: DataFrame, col: str):
    is_array = df.schema[col].dataType.typeName() == "array"
    return F.col(col) if is_array else F.array(F.col(col).cast("double"))


def _local_pass(df: DataFrame, model: Model, fit: Fit, features, target, batch_size, workers, parts, log=None):
    """One epoch of steps per worker; returns rows, loss sum and the weighted states.

    ``df`` is sorted by ``_worker`` within its partitions and no worker is in two
    of them. Behind the states come the steps each worker has made. The histograms
    for the ``log`` are notes of the same pass, written by the tasks.
    """
    start = df.sparkSession.sparkContext.broadcast((fit.vector, fit.optim))
    size = model.size * (1 + fit.optim.slots) + 1
    wanted, edges = (log.parameters, (log.low, log.high)) if log else (None, None)
    epoch, before = fit.epoch, fit.step

    def work(batches):
        noted = []
        n, loss, total, steps = 0, 0.0, np.zeros(size), np.zeros(workers)
        worker, vector, optim, own = None, None, None, 0
        held_x, held_y = np.zeros((0, 0)), np.zeros(0)

        def take(x, y):
            nonlocal vector, n, loss, own
            part, gradient = model.loss_and_gradient(vector, x, y)
            vector = optim.step(vector, gradient / len(x))
            n, loss, own = n + len(x), loss + part, own + len(x)
            steps[worker] += 1
            made = before + int(steps[worker])
            if wanted and wanted(epoch, made):
                counts = [bucket_counts(v.ravel(), *edges) for v in model.split(vector).values()]
                noted.append((made, np.concatenate(counts)))

        def finish():
            nonlocal total
            if worker is not None:
                if len(held_x):
                    take(held_x, held_y)
                total = total + own * np.concatenate([vector, optim.pack()])

        for batch in batches:
            of = batch.column(3).to_numpy()
            for w in np.unique(of).tolist():
                at = np.flatnonzero(of == w)
                x, y, _ = _read_pair(batch.slice(at[0], len(at)), model)
                if w != worker:
                    finish()
                    worker, vector, optim, own = w, start.value[0], copy.deepcopy(start.value[1]), 0
                elif len(held_x):
                    x, y = np.concatenate([held_x, x]), np.concatenate([held_y, y])
                whole = len(x) // batch_size * batch_size
                for i in range(0, whole, batch_size):
                    take(x[i : i + batch_size], y[i : i + batch_size])
                held_x, held_y = x[whole:], y[whole:]
        finish()
        return (n, loss, np.concatenate([total, steps]), noted) if n else None

    def record(notes):
        histograms = counted_buckets(notes, list(model.shapes()), ["number"])
        log.metrics.append_histogram(log.run_id, F.col("number"), histograms)

    pair = _pair(df, features, target, "_key", "_worker")
    try:
        return vector_sum(pair, work, parts, size + workers, record if log else None)
    finally:
        start.destroy()


def _finite(loss: float, step: int) -> float:
    if not math.isfinite(loss):
        raise FloatingPointError(f"training loss became {loss} at step {step}")
    return loss


def fit(
    df: DataFrame,
    model: Model,
    optim: Optimizer | None = None,
    epochs: int | None = None,
    batch_size: int | None = None,
    mode: str | None = None,
    *,
    key: str = "id",
    features: str = "features",
    target: str = "label1",
    start: np.ndarray | DataFrame | None = None,
    stop: Trigger | None = None,
    validation: Validation | None = None,
    log: Log | None = None,
    checkpoint: Checkpoint | None = None,
    resume: bool = False,
    partitions: int | None = None,
    workers: int | None = None,
    seed: int = 0,
    view: View | None = None,
    task_rows: int = layout.TASK_ROWS,
) -> Fit:
    """Train ``model`` on ``(key, features, target)`` rows.

    Settings left out come from :data:`SETTINGS`; ``batch_size`` 0 means all rows
    per step. For minibatches in ``sync`` the samples are written once, laid out by
    classes, and a step reads its own in tasks of ``task_rows`` rows; of smaller batches a task
    takes as many, one after the other, as have ``task_rows`` rows. Else they are kept in
    memory and on disk where they are read; ``local_sgd`` first deals them to its
    ``workers``, which the job must name, a number of ``partitions`` spreads them by key.
    With a ``view`` it is the rows of ``df`` that are stored, and ``view(rows, epoch)``
    makes ``(key, features, target)`` of them anew in every pass, such as images cropped
    and mirrored at random; rows keep their keys. Rows with a NULL in features or target are passed over
    and counted in ``Fit.skipped``.
    """
    preset = SETTINGS.get(model.name)
    optim = copy.deepcopy(optim or preset.optim)
    batch_size = preset.batch_size if batch_size is None else batch_size
    mode = mode or (preset.mode if preset else "sync")
    if mode not in ("sync", "local_sgd"):
        raise ValueError(f"unknown mode {mode!r}")
    stop = stop or max_epoch(preset.epochs if epochs is None else epochs)
    spark = df.sparkSession
    vector = model.init(seed) if start is None else model_store.to_vector(model, start)
    run = Fit(vector, optim)
    optim.start(model.size)
    if resume and checkpoint:
        checkpoint.load(spark, model, run)
    if mode == "local_sgd" and not workers:
        raise ValueError("local_sgd needs the number of its workers")
    columns = [F.col(c) for c in dict.fromkeys((features, target))]
    samples = df.withColumn("_key", F.col(key)) if view else df.select(F.col(key).alias("_key"), *columns)

    def shown(rows: DataFrame, epoch: int) -> DataFrame:
        return view(rows, epoch).select(F.col(key).alias("_key"), *columns) if view else rows

    worker = F.pmod(keyed_hash(F.col("_key"), seed), F.lit(workers or 1)).cast("int")
    batches = None
    if mode == "sync" and batch_size:
        in_all = df.count()
        if in_all > batch_size:
            batches = layout.lay_out(samples, "_key", in_all, batch_size, seed, task_rows)
            samples = batches.table
    elif mode == "local_sgd":
        # a worker's rows lie in the partition of its number, or with fewer partitions of several workers
        samples = samples.repartitionById(partitions or workers, F.pmod(worker, F.lit(partitions or workers)))
    if batches is None:
        if mode == "sync" and partitions:
            samples = samples.repartition(partitions, "_key")
        samples = samples.persist(StorageLevel.MEMORY_AND_DISK)
    if validation:
        held_out = validation.data.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
        validation = replace(validation, data=held_out)
    measuring, waiting = ThreadPoolExecutor(1), []
    try:
        if batches:
            n_rows, parts = in_all, batches.tasks
        else:
            counted = samples.select(F.spark_partition_id().alias("part")).agg(
                F.count(F.lit(1)).alias("rows"), F.max("part").alias("last")
            ).first()
            n_rows, parts = counted["rows"], (counted["last"] or 0) + 1
        while n_rows and not stop(run.epoch, run.step):
            if mode == "sync":
                if batches and batches.in_task > 1:
                    own = (lambda rows, epoch=run.epoch: shown(rows, epoch)) if view else None
                    logged = _epoch_in_runs(spark, batches, own, model, run, features, target, log)
                else:
                    each = batches.of(run.epoch) if batches else [None]
                    steps = (shown(batches.rows(c) if batches else samples, run.epoch) for c in each)
                    logged = _sync_epoch(spark, steps, model, run, features, target, parts, log)
            else:
                logged = _local_epoch(shown(samples, run.epoch).withColumn("_worker", worker), model, run, features,
                                      target, batch_size or n_rows, workers, parts, seed, log)
            run.epoch += 1
            run.losses += logged
            if log:
                log.add("train", [("Loss", s, v) for s, v in logged])
            if validation and validation.trigger(run.epoch, run.step):
                # measured while the next epoch trains, on the parameters of this one
                done = measuring.submit(
                    validate, validation, model, run.vector, features, target
                )
                waiting.append((run.step, done))
            saving = checkpoint is not None and checkpoint.trigger(run.epoch, run.step)
            if saving or run.epoch % FLUSH_EPOCHS == 0:
                _gather(waiting, run, log)
            if saving:
                checkpoint.save(spark, model, run)
        _gather(waiting, run, log)
    finally:
        measuring.shutdown(cancel_futures=True)
        samples.unpersist()
        if validation:
            validation.data.unpersist()
        if log:
            log.flush()
    return run


def _gather(waiting: list[tuple[int, Future]], run: Fit, log: Log | None) -> None:
    """Wait for the validations under way, record them and write the log."""
    for step, done in waiting:
        scores = [(tag, step, value) for tag, value in done.result()]
        run.scores += scores
        if log:
            log.add("val", scores)
    waiting.clear()
    if log:
        log.flush()


def _sync_epoch(spark, steps, model, run, features, target, parts, log):
    logged = []
    for rows in steps:
        done = gradient_sum(rows, model, run.vector, features, target, parts, "_key")
        if done is None:
            continue
        run.skipped += done.skipped
        run.vector = run.optim.step(run.vector, done.gradient / done.rows)
        run.step += 1
        logged.append((run.step, _finite(done.loss / done.rows, run.step)))
        if log and log.parameters(run.epoch, run.step):
            _log_parameters(spark, model, run, log)
    return logged


def _epoch_in_runs(spark, batches, view, model, run, features, target, log):
    logged, todo = [], batches.of(run.epoch)
    while todo:
        size = min(len(todo), batches.in_task)
        if log:  # a step whose parameters are recorded ends its run; a batch without rows makes none
            size = next((n for n in range(1, size) if log.parameters(run.epoch, run.step + n)), size)
        taken, todo = todo[:size], todo[size:]
        before = run.step
        for rows, loss in _steps_of_run(batches.run(taken, "_key", view), model, run, features, target, size):
            if rows:
                run.step += 1
                logged.append((run.step, _finite(loss / rows, run.step)))
        if log and run.step > before and log.parameters(run.epoch, run.step):
            _log_parameters(spark, model, run, log)
    return logged


def _local_epoch(samples, model, run, features, target, batch_size, workers, parts, seed, log):
    order = keyed_hash(F.col("_key"), seed, run.epoch)
    shuffled = samples.sortWithinPartitions("_worker", order, "_key")
    done = _local_pass(shuffled, model, run, features, target, batch_size, workers, parts, log)
    if done is None:
        return []
    n, loss, state = done
    state, steps = state[:-workers] / n, state[-workers:]
    run.vector, before = state[: model.size], run.optim.t
    run.optim.unpack(state[model.size :])
    # workers step side by side: what counts is the longest of them
    made = int(steps.max())
    run.optim.t, run.step = before + made, run.step + made
    return [(run.step, _finite(loss / n, run.step))]


def _log_parameters(spark, model, run, log):
    table = model_store.to_table(spark, model, run.vector)
    log.metrics.append_histogram(log.run_id, run.step, param_histogram(table, log.low, log.high))


def validate(
    validation: Validation, model: Model, vector, features: str = "features",
    target: str = "label1",
) -> list[tuple[str, float]]:
    """The measures of ``validation.methods`` in one pass over its data; one row of sums per task moves."""
    df = validation.data
    shared = df.sparkSession.sparkContext.broadcast(vector)

    def work(batches):
        for batch in batches:
            x, y, _ = _read_pair(batch, model)
            if len(x):
                out = model.forward(shared.value, x)
                loss = float(CRITERIA[model.criterion](out, y)[0])
                hits = int((out.argmax(1) == y - 1).sum()) if y.ndim == 1 else 0
                yield pa.RecordBatch.from_pydict({"n": [len(x)], "loss": [loss], "hits": [hits]})

    measured = _pair(df, features, target, None).mapInArrow(work, "n bigint, loss double, hits bigint")
    try:
        n, loss, hits = measured.agg(F.sum("n"), F.sum("loss"), F.sum("hits")).first()
    finally:
        shared.destroy()
    if not n:
        return []
    measures = {"Top1Accuracy": hits / n, "Loss": loss / n}
    return [(m, float(measures[m])) for m in validation.methods]


def transfer(
    data: DataFrame, model: Model, pretrained: DataFrame, match_all: bool = False,
    fresh: np.ndarray | None = None, **options
) -> Fit:
    """Train all layers of ``model``, started from a parameter table by layer name.

    ``pretrained`` gives the layers it has; a renamed layer, such as a new head,
    starts at ``fresh``, or at random values.
    """
    spark = data.sparkSession
    if fresh is None:
        fresh = model.init(options.get("seed", 0))
    start = model_store.warm_start(model_store.to_table(spark, model, fresh), pretrained, match_all)
    return fit(data, model, start=start, **options)
