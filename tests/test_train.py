"""Training jobs: independence of the layout, modes, logs, checkpoints."""

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gradmill.catalog import queries as q
from gradmill.catalog.files import store
from gradmill.functions.hashing import keyed_hash
from gradmill.operators import evaluate, model_store, samples
from gradmill.operators.metrics import MetricsLog
from gradmill.plans import layout, models, score, train
from gradmill.plans.optim import SGD, Adam
from gradmill.plans.reduce import vector_sum
from gradmill.plans.score import rows_of
from gradmill.session import scratch_dir


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    df = q.z_samples(spark, sf_dir).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def local(data):
    rows = data.orderBy("id").collect()
    return (
        np.array([r["id"] for r in rows]), np.array([r["features"] for r in rows]),
        np.array([r["label1"] for r in rows]),
    )


@pytest.mark.parametrize("batch_size", [0, 200])
def test_sync_does_not_depend_on_partitions(data, batch_size):
    model = models.mlp(64, (6, 5), 10)
    runs = [
        train.fit(data, model, SGD(0.3), 2, batch_size, "sync", partitions=n).vector
        for n in (1, 3, 8)
    ]
    assert np.abs(runs[0] - runs[1]).max() < 1e-9
    assert np.abs(runs[0] - runs[2]).max() < 1e-9


def test_sync_full_batch_equals_plain_numpy(data, local):
    model = models.softmax(64, 10)
    _, x, y = local
    vector = np.zeros(model.size)
    for _ in range(3):
        vector = vector - 0.5 * model.loss_and_gradient(vector, x, y)[1] / len(x)
    fitted = train.fit(data, model, SGD(0.5), 3, 0, "sync", start=np.zeros(model.size))
    assert np.abs(fitted.vector - vector).max() < 1e-12
    assert fitted.losses[0][1] == pytest.approx(np.log(10))


def test_gradient_vanishes_where_the_ml_library_ends(data):
    """Multinomial logistic regression of pyspark.ml minimizes the same loss."""
    vectors = data.select(array_to_vector("features").alias("features"), (F.col("label1") - 1).alias("label"))
    ml = LogisticRegression(
        family="multinomial", maxIter=300, tol=1e-10, regParam=0.0, standardization=False
    ).fit(vectors)
    model = models.softmax(64, 10)
    solution = model.join({
        ("score", "weight"): ml.coefficientMatrix.toArray(),
        ("score", "bias"): ml.interceptVector.toArray(),
    })
    end = train.gradient_sum(data, model, solution, "features", "label1", 8)
    start = train.gradient_sum(data, model, np.zeros(model.size), "features", "label1", 8)
    assert end.loss / end.rows < np.log(10)
    assert np.abs(end.gradient).max() < 1e-2 * np.abs(start.gradient).max()


def test_local_sgd_with_one_worker_is_the_serial_loop(data, spark):
    model, optim = models.softmax(64, 10), Adam()
    optim.start(model.size)
    vector = model.init(0)
    for epoch in (0, 1):
        rows = data.orderBy(keyed_hash(F.col("id"), 0, epoch)).collect()
        x = np.array([r["features"] for r in rows])
        y = np.array([r["label1"] for r in rows])
        for at in range(0, len(x), 64):
            g = model.loss_and_gradient(vector, x[at : at + 64], y[at : at + 64])[1]
            vector = optim.step(vector, g / len(x[at : at + 64]))
    fitted = train.fit(data, model, Adam(), 2, 64, "local_sgd", workers=1)
    assert np.abs(fitted.vector - vector).max() < 1e-9
    assert fitted.optim.t == optim.t


def test_local_sgd_averages_by_rows(data):
    model = models.softmax(64, 10)
    a = train.fit(data, model, SGD(0.1), 1, 32, "local_sgd", workers=5)
    b = train.fit(data, model, SGD(0.1), 1, 32, "local_sgd", workers=5)
    assert np.abs(a.vector - b.vector).max() < 1e-12
    assert a.losses[0][1] < 2.6


@pytest.mark.parametrize("parts", [1, 2, 23])
def test_vector_sum(spark, parts):
    df = spark.range(0, 1000, 1, parts).select(F.array(F.col("id").cast("double")).alias("x"))
    size = 70_000  # more than one block

    def work(batches):
        n, total = 0, np.zeros(size)
        for batch in batches:
            values, _ = rows_of(batch.column(0), 1)
            n += len(values)
            total[0] += values.sum()
            total[-1] += len(values)
        return (n, float(n), total) if n else None

    n, loss, total = vector_sum(df, work, parts, size)
    assert (n, loss, len(total)) == (1000, 1000.0, size)
    assert (total[0], total[-1]) == (499500.0, 1000.0)


def test_vector_sum_of_nothing(spark):
    empty = spark.range(0).select(F.array(F.col("id").cast("double")))
    assert vector_sum(empty, lambda batches: None, 4, 1) is None


UNEVEN = [(1, [1.0, 2.0, 3.0], 1), (2, [4.0, 5.0, 6.0, 7.0, 8.0], 2)]
NULLS = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, None, 2), (3, [1.0, None, 3.0, 4.0], 2), (4, [1.0] * 4, None)]
ROWS = "id int, x array<double>, label1 int"


def test_uneven_rows_and_strange_labels_are_errors(spark):
    model = models.softmax(4, 3)
    weights = model.formula()
    uneven = spark.createDataFrame(UNEVEN, ROWS).coalesce(1)
    with pytest.raises(PythonException, match="key 1: 3 values where 4 are expected"):
        score.predict(uneven, model, weights, ["id"], "x").collect()
    with pytest.raises(PythonException, match="key '1': 3 values where 4"):
        train.gradient_sum(uneven, model, weights, "x", "label1", 1, "id")
    with pytest.raises(PythonException, match="[35] values where 4"):  # whichever worker comes first
        train.fit(uneven, model, SGD(0.1), 1, 0, "local_sgd", features="x", workers=8)
    with pytest.raises(PythonException, match="3 values where 4"):
        train.validate(train.Validation(uneven), model, weights, "x")
    for label in (0, 4):
        wrong = spark.createDataFrame([(7, [1.0] * 4, 1), (8, [1.0] * 4, label)], ROWS)
        with pytest.raises(PythonException, match=f"key '8': label {label} is not one of 1 to 3"):
            train.gradient_sum(wrong, model, weights, "x", "label1", 8, "id")
        with pytest.raises(PythonException, match="is not one of 1 to 3"):
            train.validate(train.Validation(wrong), model, weights, "x")


def test_null_rows_stay_null_and_are_counted(spark):
    model = models.softmax(4, 3)
    weights = model.formula()
    df = spark.createDataFrame(NULLS, ROWS).coalesce(1)
    scored = {r["id"]: r["scores"] for r in score.predict(df, model, weights, ["id"], "x").collect()}
    assert scored[2] is None and scored[3] is None and len(scored[1]) == len(scored[4]) == 3
    best = {r["id"]: r["best"] for r in score.predict_top_k(df, model, weights, ["id"], 2, "x").collect()}
    assert best[2] is None and len(best[1]) == 2
    done = train.gradient_sum(df, model, weights, "x", "label1", 1, "id")
    alone = train.gradient_sum(df.where("id = 1"), model, weights, "x", "label1", 1, "id")
    assert (done.rows, done.skipped, done.loss) == (1, 3, alone.loss)
    assert np.array_equal(done.gradient, alone.gradient)
    assert train.fit(df, model, SGD(0.1), 2, 0, "sync", features="x").skipped == 6
    assert train.validate(train.Validation(df, ("Loss",)), model, weights, "x") == [("Loss", pytest.approx(alone.loss))]
    nothing = df.where("x IS NULL")
    assert train.gradient_sum(nothing, model, weights, "x", "label1", 1) is None
    assert score.predict(nothing, model, weights, ["id"], "x").first()["scores"] is None


@pytest.mark.parametrize("partitions", [1, 3, 20])
def test_local_sgd_does_not_depend_on_the_cluster(data, partitions):
    model = q.LINEAR
    options = dict(epochs=2, batch_size=16, mode="local_sgd", workers=5)
    one = train.fit(data, model, SGD(0.1), partitions=5, **options)
    other = train.fit(data, model, SGD(0.1), partitions=partitions, **options)
    assert np.abs(one.vector - other.vector).max() < 1e-12
    assert one.step == other.step and one.optim.t == one.step


def test_loss_falls_for_every_model(data):
    for model in (q.LINEAR, q.MLP, q.LENET, q.RNN, q.LSTM, q.BIRNN):
        optim = Adam(0.02)
        fitted = train.fit(data, model, optim, 4, 64, "local_sgd", workers=2)
        assert fitted.losses[-1][1] < fitted.losses[0][1], model.name
    pairs = samples.self_target(data)
    fitted = train.fit(pairs, q.AUTOENCODER, Adam(0.02), 4, 64, "local_sgd", target="target", workers=8)
    assert fitted.losses[-1][1] < fitted.losses[0][1]
    same = train.fit(data, q.AUTOENCODER, Adam(0.02), 1, 64, "sync", target="features")
    assert np.isfinite(same.losses[-1][1])


def test_log_validation_and_parameter_trigger(data, spark):
    log = MetricsLog(spark, scratch_dir(spark, "log"))
    train.fit(
        data, q.LINEAR, SGD(0.2), 3, 250, "sync",
        log=train.Log(log, "run", train.several_iteration(2)),
        validation=train.Validation(data, ("Top1Accuracy", "Loss")),
    )
    loss = log.read_scalar("run", "train", "Loss").collect()
    assert [r["step"] for r in loss] == [1, 2, 3, 4, 5, 6]
    top1 = log.read_scalar("run", "val", "Top1Accuracy").collect()
    assert [r["step"] for r in top1] == [2, 4, 6]
    assert all(0 <= r["value"] <= 1 for r in top1)
    assert log.read_scalar("run", "val", "Loss").count() == 3
    histograms = log.read_histograms("run").groupBy("step").agg(F.sum("n").alias("n")).collect()
    assert {r["step"]: r["n"] for r in histograms} == {s: q.LINEAR.size for s in (2, 4, 6)}


def test_workers_record_their_own_parameters(data, spark):
    def histograms(partitions):
        log = MetricsLog(spark, scratch_dir(spark, "log"))
        record = train.Log(log, "run", train.several_iteration(2))
        fitted = train.fit(data, q.LINEAR, SGD(0.2), 2, 32, "local_sgd", workers=3, partitions=partitions, log=record)
        return fitted.step, {(r["step"], r["layer"], r["param"], r["bucket"], r["n"]) for r in log.read_histograms("run").collect()}

    steps, found = histograms(3)
    per_step = {}
    for step, *_, n in found:
        per_step[step] = per_step.get(step, 0) + n
    assert per_step and all(s % 2 == 0 and s <= steps for s in per_step)
    # all three workers make the early steps, and every value of theirs is in one bucket
    assert per_step[2] == 3 * q.LINEAR.size and set(per_step.values()) <= {k * q.LINEAR.size for k in (1, 2, 3)}
    assert histograms(1) == (steps, found)



def test_validation_equals_the_measures_of_the_scored_table(data):
    for model in (q.LINEAR, q.RNN):
        vector = model.formula()
        scored = score.predict(data, model, vector, ["label1"])
        want = {
            "Top1Accuracy": evaluate.top1_accuracy(scored).first()[0],
            "Loss": evaluate.mean_loss(scored, model.criterion).first()[0],
        }
        got = dict(train.validate(train.Validation(data, ("Top1Accuracy", "Loss")), model, vector))
        assert got == pytest.approx(want)
    assert train.validate(train.Validation(data.limit(0)), q.LINEAR, q.LINEAR.formula()) == []


def test_checkpoint_resume_equals_an_uninterrupted_run(data, spark):
    def run(path, epochs, resume=False):
        return train.fit(
            data, q.LINEAR, Adam(), epochs, 100, "sync",
            checkpoint=train.Checkpoint(path), resume=resume,
        )

    whole = run(scratch_dir(spark, "whole"), 4)
    path = scratch_dir(spark, "parts")
    run(path, 2)
    resumed = run(path, 4, resume=True)
    assert resumed.epoch == 4 and resumed.step == whole.step
    assert np.abs(resumed.vector - whole.vector).max() < 1e-12
    with pytest.raises(ValueError, match="already saved"):
        run(path, 2)  # complete epochs are never overwritten


def test_a_save_cut_short_is_replaced(data, spark):
    def run(path, epochs, resume=False):
        return train.fit(data, q.LINEAR, Adam(), epochs, 0, "sync", checkpoint=train.Checkpoint(path), resume=resume)

    path = scratch_dir(spark, "cut")
    run(path, 2)
    # a driver lost while it wrote the data of epoch 3, and one lost before the mark of epoch 4
    store(f"{path}/saved/epoch=3/_temporary/0/part-0.parquet", b"half")
    run(f"{path}-other", 4)
    store(f"{path}/saved/epoch=4/part-0.parquet", b"no table")
    store(f"{path}/complete/epoch=4/_temporary/0/part-0.parquet", b"")
    saved = train.Checkpoint(path)
    assert saved.epochs(spark) == [1, 2]
    resumed = run(path, 4, resume=True)
    assert saved.epochs(spark) == [1, 2, 3, 4] and resumed.epoch == 4
    assert np.abs(resumed.vector - run(scratch_dir(spark, "whole"), 4).vector).max() < 1e-12


def test_nothing_complete_starts_anew(data, spark):
    path = scratch_dir(spark, "none")
    assert train.Checkpoint(path).epochs(spark) == []
    store(f"{path}/complete/epoch=1/_temporary/0/part-0.parquet", b"")
    assert train.Checkpoint(path).epochs(spark) == []
    assert not train.Checkpoint(path).load(spark, q.LINEAR, None)


def test_classes_are_dealt_whole_and_anew():
    first, second = (layout.dealt(20, 5, 3, epoch) for epoch in (0, 1))
    for deal in (first, second):
        assert sorted(c for b in deal for c in b) == list(range(20)) and {len(b) for b in deal} == {4}
    assert first != second and first == layout.dealt(20, 5, 3, 0)


@pytest.mark.parametrize("folders", [4096, 3])
def test_a_batch_reads_its_own_folders(spark, data, monkeypatch, folders):
    monkeypatch.setattr(layout, "FOLDERS", folders)
    n = data.count()
    batches = layout.lay_out(data, "id", n, n // 6 + 1, 0)
    seen = []
    for classes in batches.of(2):
        rows = batches.rows(classes)
        assert rows.columns == data.columns and rows.rdd.getNumPartitions() == 1  # whatever the table's size
        wanted = {f"_folder={c % folders}" for c in classes}
        files = {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}
        assert {f.rsplit("/", 2)[1] for f in files} <= wanted
        seen += [r["id"] for r in rows.select("id").collect()]
    assert len(seen) == n and len(set(seen)) == n


def test_tasks_of_a_step_follow_the_batch(spark):
    rows = spark.range(4000).select("id", F.array(F.rand(1)).alias("features"), F.lit(1.0).alias("label1"))
    few, many = (layout.lay_out(rows, "id", 4000, size, 0, task_rows=100) for size in (100, 1000))
    assert few.rows(few.of(0)[0]).rdd.getNumPartitions() == 1
    assert few.n_batches == 40 and 1 < many.rows(many.of(0)[0]).rdd.getNumPartitions() <= 10


def jobs_of(spark, run):
    """What ``run`` returns, and the number of Spark jobs it took."""
    tag = f"counted-{scratch_dir(spark, 'jobs')}"
    spark.sparkContext.setJobGroup(tag, "counted")
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_batches_are_taken_in_runs(spark, data):
    """Steps of a run are those of one job each, and their jobs do not grow in number with the steps."""
    rows = data.withColumn("features", F.when(F.col("id") % 7 > 0, F.col("features")))
    for optim in (SGD(0.1, 1e-3), Adam()):
        options = dict(epochs=2, batch_size=20, mode="sync", start=q.LINEAR.formula())
        alone, many = jobs_of(spark, lambda: train.fit(rows, q.LINEAR, optim, task_rows=20, **options))
        run, few = jobs_of(spark, lambda: train.fit(rows, q.LINEAR, optim, **options))
        assert np.abs(run.vector - alone.vector).max() < 1e-9
        assert (run.step, run.skipped, run.optim.t) == (alone.step, alone.skipped, alone.optim.t) and run.skipped > 0
        assert [s for s, _ in run.losses] == [s for s, _ in alone.losses] == list(range(1, run.step + 1))
        assert np.allclose([v for _, v in run.losses], [v for _, v in alone.losses])
        assert many >= run.step and few < run.step / 2


def test_runs_with_views_and_recorded_parameters(data, spark):
    def fitted(task_rows):
        log = MetricsLog(spark, scratch_dir(spark, "log"))
        done = train.fit(
            data, q.LINEAR, SGD(0.1), 2, 40, "sync", start=q.LINEAR.formula(), task_rows=task_rows,
            view=lambda rows, epoch: rows.select("id", F.transform("features", lambda v: v * (epoch + 1.0)).alias("features"), "label1"),
            log=train.Log(log, "run", train.several_iteration(5)))
        found = log.read_histograms("run").collect()
        return done, sorted((r["step"], r["layer"], r["param"], r["bucket"], r["n"]) for r in found)

    (alone, noted), (run, noted_in_runs) = fitted(40), fitted(400)
    assert np.abs(run.vector - alone.vector).max() < 1e-9 and run.step == alone.step
    assert noted_in_runs == noted and {r[0] for r in noted} == set(range(5, run.step + 1, 5))
    with pytest.raises(PythonException, match="keep the keys"):
        train.fit(data, q.LINEAR, SGD(0.1), 1, 5, "sync", task_rows=10, view=lambda rows, epoch: rows.withColumn("id", F.col("id") + 1))


def test_view_is_taken_anew_in_every_epoch(data):
    """Features that a view scales by the epoch, against the same steps by hand."""
    def view(rows, epoch):
        return rows.withColumn("features", F.transform("features", lambda v: v * (epoch + 1.0)))

    rows = data.toPandas()
    x, y = np.array(rows.features.tolist()), rows.label1.to_numpy()
    vector = q.LINEAR.formula()
    for epoch in (0, 1):
        vector = vector - 0.1 * q.LINEAR.loss_and_gradient(vector, x * (epoch + 1.0), y)[1] / len(x)
    fitted = train.fit(data, q.LINEAR, SGD(0.1), 2, 0, "sync", start=q.LINEAR.formula(), view=view)
    assert np.abs(fitted.vector - vector).max() < 1e-9
    one = train.fit(data, q.LINEAR, SGD(0.1), 2, 64, "local_sgd", workers=1, view=view)
    assert one.step == 2 * -(-len(x) // 64)


def test_every_worker_has_a_partition(data):
    with pytest.raises(ValueError, match="number of its workers"):
        train.fit(data, q.LINEAR, mode="local_sgd")
    # a worker's rows lie in its own task: with a batch for all rows, as many steps as workers are averaged
    fitted = train.fit(data, q.LINEAR, SGD(0.1), 1, 0, "local_sgd", workers=6, start=q.LINEAR.formula())
    assert fitted.step == 1


def test_triggers():
    assert train.max_epoch(2)(2, 0) and not train.max_epoch(2)(1, 99)
    assert train.several_iteration(50)(0, 100) and not train.several_iteration(50)(0, 0)
    assert train.every_epoch()(1, 1)


def test_stop_trigger_and_unknown_mode(data):
    fitted = train.fit(data, q.LINEAR, SGD(0.1), batch_size=0, mode="sync",
                       stop=lambda epoch, step: step >= 3)
    assert fitted.step == 3
    with pytest.raises(ValueError, match="unknown mode"):
        train.fit(data, q.LINEAR, mode="async")


def test_diverging_loss_is_an_error(data):
    bad = np.full(q.LINEAR.size, np.nan)
    with pytest.raises(FloatingPointError):
        train.fit(data, q.LINEAR, SGD(0.1), 1, 0, "sync", start=bad)


def test_transfer_starts_from_the_pretrained_layer(data, spark):
    model = models.head(64, 10)
    given = model_store.to_table(spark, model, np.ones(model.size))
    fitted = train.transfer(data, model, given, epochs=0, workers=8)
    assert np.array_equal(fitted.vector, np.ones(model.size))
    renamed = given.withColumn("layer", F.lit("loss3"))
    fresh = train.transfer(data, model, renamed, epochs=0, workers=8)
    assert np.allclose(fresh.vector, model.init(0))
    with pytest.raises(ValueError, match="no pretrained"):
        train.transfer(data, model, renamed, match_all=True, workers=8)
