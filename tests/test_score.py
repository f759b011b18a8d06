"""Scoring, quantization, parameter tables and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradmill.catalog import queries as q
from gradmill.functions import pixels as px
from gradmill.operators import model_store, quant
from gradmill.plans import models, score
from gradmill.session import scratch_dir
from gradmill.streaming.scoring import TableSink, sample_stream, score_stream, score_stream_to_table


def test_predict_keeps_keys_and_reads_nested_arrays(spark):
    model = models.rnn(3, 2, 4, 5)
    x = np.random.default_rng(0).normal(size=(7, 3, 2))
    df = spark.createDataFrame(
        [(i, x[i].tolist()) for i in range(7)], "id int, features array<array<double>>"
    ).repartition(3)
    rows = score.predict(df, model, model.formula(), ["id"]).collect()
    want = model.forward(model.formula(), x)
    assert len(rows) == 7
    for r in rows:
        assert r["scores"] == pytest.approx(want[r["id"]].tolist())


def test_parameter_table_round_trip_and_checks(spark):
    model = models.lenet(8, (3, 2), (2, 3), 5, 4)
    table = model_store.to_table(spark, model, model.init(4))
    path = model_store.save(table, scratch_dir(spark, "store"), "trained_model")
    loaded = model_store.load(spark, path)
    assert np.array_equal(model_store.to_vector(model, loaded), model.init(4))
    with pytest.raises(ValueError, match="missing from the table"):
        model_store.to_vector(model, loaded.where("layer <> 'fc1'"))


def test_model_size_is_checked_before_it_is_fetched(spark, monkeypatch):
    model = models.softmax(4, 3)
    monkeypatch.setattr(model_store, "MAX_BYTES", 100)
    with pytest.raises(ValueError, match="over the bound"):
        model_store.to_vector(model, model_store.to_table(spark, model, model.init()))


def test_warm_start_needs_the_same_shape(spark):
    model = models.mlp(4, (3, 3), 2)
    target = model_store.to_table(spark, model, model.init(0))
    source = model_store.to_table(spark, model, model.init(9)).withColumn(
        "shape", F.when(F.col("layer") == "fc3", F.array(F.lit(9))).otherwise(F.col("shape"))
    )
    mixed = model.split(model_store.to_vector(model, model_store.warm_start(target, source)))
    old, new = model.split(model.init(0)), model.split(model.init(9))
    for key in mixed:
        assert np.array_equal(mixed[key], (old if key[0] == "fc3" else new)[key])
    with pytest.raises(ValueError, match="fc3"):
        model_store.warm_start(target, source, match_all=True)


def test_quantization_error_is_at_most_half_a_step(spark):
    model = models.lenet(8, (3, 2), (2, 3), 5, 4)
    vector = model.init(2)
    vector[: 9] = 0.0  # the first filter is all zeros
    table = model_store.to_table(spark, model, vector)
    small = quant.quantize(table)
    back = model.split(model_store.to_vector(model, quant.dequantize(small)))
    scales = {(r["layer"], r["param"]): r["scales"] for r in small.collect()}
    for key, value in model.split(vector).items():
        rows = value.reshape(len(scales[key]), -1)
        error = np.abs(back[key].reshape(rows.shape) - rows).max(1)
        assert (error <= np.array(scales[key]) / 2 + 1e-12).all()
    assert len(scales["conv1", "weight"]) == 2 and len(scales["fc1", "bias"]) == 1
    report = quant.size_report(table, small).first()
    assert report["float_bytes"] == 4 * model.size
    assert report["int8_bytes"] == model.size + 4 * sum(map(len, scales.values()))
    assert report["saved_bytes"] == report["float_bytes"] - report["int8_bytes"]


def test_stream_equals_batch_and_picks_up_only_new_files(spark, sf_dir):
    base = scratch_dir(spark, "arrivals")
    rows = q.raw_samples(spark, sf_dir).select("vec_id", "x")
    schema = "vec_id bigint, x array<float>"
    model = q.LINEAR

    def run():
        stream = sample_stream(spark, f"{base}/in", schema, files_per_batch=1)
        score_stream(
            stream, model, model.formula(), ["vec_id"], f"{base}/out", f"{base}/progress", "x"
        ).awaitTermination()

    rows.where("vec_id < 200").coalesce(2).write.parquet(f"{base}/in")
    run()
    rows.where("vec_id >= 200").coalesce(1).write.mode("append").parquet(f"{base}/in")
    run()
    run()  # nothing new
    streamed = spark.read.parquet(f"{base}/out").orderBy("vec_id").collect()
    batch = score.predict(rows, model, model.formula(), ["vec_id"], "x").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in streamed] == [r["vec_id"] for r in batch]
    assert np.allclose([r["scores"] for r in streamed], [r["scores"] for r in batch], atol=1e-12)


class DyingSink(TableSink):
    """Stores a batch and then fails, once, before the stream can note that it is done."""

    alive = True

    def put(self, batch, batch_id):
        super().put(batch, batch_id)
        if batch_id == 1 and self.alive:
            self.alive = False
            raise RuntimeError("the driver is lost")


def test_a_repeated_batch_changes_nothing_in_the_table(spark, sf_dir):
    base = scratch_dir(spark, "sink")
    rows = q.raw_samples(spark, sf_dir).select("vec_id", "x")
    rows.repartition(3).write.parquet(f"{base}/in")
    name, model = "repeated_batches", q.LINEAR
    sink = DyingSink(spark, name, f"{base}/table", "vec_id BIGINT, scores ARRAY<DOUBLE>", "vec_id", 4)

    def run():
        stream = sample_stream(spark, f"{base}/in", "vec_id bigint, x array<float>", files_per_batch=1)
        score_stream_to_table(stream, model, model.formula(), ["vec_id"], sink, f"{base}/progress", "x").awaitTermination()

    with pytest.raises(Exception, match="driver is lost"):
        run()
    assert sink.read(spark).select("batch_id").distinct().count() == 2
    run()
    batch = {r["vec_id"]: r["scores"] for r in score.predict(rows, model, model.formula(), ["vec_id"], "x").collect()}
    stored = sink.read(spark).collect()
    assert sorted(r["vec_id"] for r in stored) == sorted(batch)
    assert all(np.allclose(r["scores"], batch[r["vec_id"]], atol=1e-12) for r in stored)
    assert {r["batch_id"] for r in stored} == {0, 1, 2}
    spark.sql(f"DROP TABLE {name}")  # the entry; the files stay, and another session finds them
    again = TableSink(spark, name, f"{base}/table", "vec_id BIGINT, scores ARRAY<DOUBLE>", "vec_id", 4)
    assert again.read(spark).count() == len(stored)


def test_tables_with_the_same_buckets_join_without_a_shuffle(spark, sf_dir):
    df = q.predictions_in_tables(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert df.count() == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()


def test_write_predictions_never_overwrites(spark, sf_dir):
    path = scratch_dir(spark, "predictions")
    scored = q.linear_scores(spark, sf_dir)
    score.write_predictions(scored, path)
    assert spark.read.parquet(path).count() == scored.count()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        score.write_predictions(scored, path)


def test_images_of_wrong_length_are_errors(spark):
    df = spark.createDataFrame([(1, [1.0] * 11), (2, [1.0] * 13)], "id int, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="not 2 x 2 x 3"):
        px.transformed(df, px.from_array(F.col("v"), 2, 2, 3), ["id"]).collect()
