"""Expressions on arrays and pixels, sample tables and lookups."""

from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradmill.functions import arrays, names
from gradmill.functions import pixels as px
from gradmill.functions.hashing import batch_number, coin
from gradmill.operators import inspect, lookup, samples
from gradmill.plans import images
from gradmill.plans.score import predict_class


def one(spark, value, kind, *columns):
    df = spark.createDataFrame([(1, value)], f"id bigint, v {kind}")
    return df.select(*[c(F.col("v")) for c in columns]).first()


@pytest.mark.parametrize("scores,best", [
    ([0.1, 0.9, 0.9], 1), ([3.0], 0), ([-1.0, -2.0], 0), ([1.0, float("nan"), 2.0], 1), ([], None),
])
def test_argmax(spark, scores, best):
    row = one(spark, scores, "array<double>", arrays.argmax, predict_class)
    assert row[0] == best and row[1] == (None if best is None else best + 1)


def test_top_k_breaks_ties_by_class(spark):
    row = one(spark, [0.2, 0.5, 0.2, 0.5, 0.1, 0.0], "array<double>", lambda v: arrays.top_k(v, 5))
    assert [tuple(b) for b in row[0]] == [(1, 0.5), (3, 0.5), (0, 0.2), (2, 0.2), (4, 0.1)]
    assert len(one(spark, [1.0, 2.0], "array<double>", arrays.top_k)[0]) == 2


def test_log_softmax_is_stable(spark):
    row = one(spark, [1000.0, 1000.0], "array<double>", arrays.log_softmax)
    assert row[0] == pytest.approx([-np.log(2)] * 2)


def test_reshape2d(spark):
    row = one(spark, list(range(6)), "array<int>", lambda v: arrays.reshape2d(v, 2, 3))
    assert row[0] == [[0, 1, 2], [3, 4, 5]]


def views(df, pixels):
    """The transformed images in the order of their ids."""
    return [r["v2"] for r in px.transformed(df, pixels, ["id"], "v2").orderBy("id").collect()]


SIDES = st.tuples(st.integers(2, 5), st.integers(2, 6))


@settings(max_examples=6, deadline=None)
@given(SIDES, st.integers(0, 2**31))
def test_pixel_laws(spark, sides, seed):
    h, w = sides
    image = np.random.default_rng(seed).integers(0, 256, (h, w, 3))
    flat = image.ravel().tolist()
    key = F.lit(seed)
    chains = [
        [px.flip_horizontal()], [px.flip_horizontal(), px.flip_horizontal()], [px.to_chw()],
        [px.crop_center(h, w)], [px.crop_random(h, w, key, 1)], [px.resize_nearest(h, w)],
        [px.flip_random(key, 0.0)], [px.resize_nearest(2 * h, 2 * w)],
        [px.crop_center(h - 1, w - 1)],
    ]
    df = spark.createDataFrame([(1, flat)], "id bigint, v array<int>")
    row = [views(df, px.from_array(F.col("v"), h, w, 3).then(*c))[0] for c in chains]
    assert row[0] == image[:, ::-1].ravel().tolist()
    assert row[2] == image.transpose(2, 0, 1).ravel().tolist()
    for same in (1, 3, 4, 5, 6):
        assert row[same] == flat
    assert row[7] == image.repeat(2, 0).repeat(2, 1).ravel().tolist()
    assert row[8] == image[: h - 1, : w - 1].ravel().tolist()


def byte_table(spark, *pictures):
    rows = [(i, bytearray(p.tobytes()), *p.shape) for i, p in enumerate(pictures)]
    schema = "id int, data binary, height int, width int, nChannels int"
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_bilinear_keeps_size_and_constants_and_mixes_sizes(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 256, (3, 3, 3), np.uint8), np.full((5, 2, 3), 77, np.uint8)
    table = byte_table(spark, a, b)
    rgb, bgr = views(table, images.resized(3, bgr=False)), views(table, images.resized(3))
    assert rgb[0] == a.ravel().tolist()
    assert bgr[0] == a[..., ::-1].ravel().tolist()
    assert set(rgb[1]) == {77}


def test_scale_u8_reads_signed_bytes_as_unsigned(spark):
    df = spark.createDataFrame([(1, [-1, 0, 127, 255])], "id int, v array<int>")
    bytes_ = px.from_array(F.col("v"), 2, 2, 1)
    row = [views(df, bytes_.then(step))[0] for step in (px.scale_u8(), px.scale_pm1())]
    assert row[0] == pytest.approx([1.0, 0.0, 127 / 255, 1.0])
    assert row[1][1] == -1.0 and row[1][3] == 1.0


def test_null_images_stay_null(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, None), (3, [4.0, 5.0, 6.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>").coalesce(1)
    steps = [px.scale_u8(1.0), px.crop_random(1, 1, F.col("id"), 0), px.to_chw()]
    view = px.from_array(F.col("v"), 1, 1, 3).then(*steps)
    assert views(df, view) == [[1.0, 2.0, 3.0], None, [4.0, 5.0, 6.0]]
    assert views(df.where("v IS NULL"), view) == [None]


def test_image_samples_are_views_of_the_image(spark):
    image = np.random.default_rng(5).integers(0, 256, (6, 6, 3), np.uint8)
    table = byte_table(spark, *[image] * 40).withColumn("label", F.col("id") % 5)
    scaled = (image[..., ::-1] / 255).astype(np.float32)
    scaled = (scaled - np.array(px.CHANNEL_MEAN)) / np.array(px.CHANNEL_STD)

    def find(flat, corners):
        for top, left in corners:
            cut = scaled[top : top + 4, left : left + 4]
            for flip, view in enumerate((cut, cut[:, ::-1])):
                if np.allclose(view.transpose(2, 0, 1).ravel(), flat, atol=1e-6):
                    return top, left, flip
        raise AssertionError("not a view")

    corners = [(t, f) for t in range(3) for f in range(3)]
    train = images.image_samples(table, "id", 6, 4, "train").collect()
    assert {r["label1"] for r in train} == {1, 2, 3, 4, 5}
    assert len({find(r["features"], corners) for r in train}) > 9  # corners, mirrored and not
    val = images.image_samples(table, "id", 6, 4, "val").collect()
    assert {find(r["features"], [(1, 1)])[2] for r in val} == {0, 1}


def test_batches_and_coins_are_spread(spark):
    df = spark.range(4000).select(
        batch_number(F.col("id"), 8, 1, 0).alias("a"), batch_number(F.col("id"), 8, 1, 1).alias("b"),
        coin(F.col("id"), 0.5, 3).alias("c"), coin(F.col("id"), 0.0, 3).alias("never"),
        coin(F.col("id"), 1.0, 3).alias("always"),
    )
    sizes = [r["count"] for r in df.groupBy("a").count().collect()]
    assert len(sizes) == 8 and min(sizes) > 400
    row = df.agg(
        F.avg((F.col("a") == F.col("b")).cast("int")), F.avg(F.col("c").cast("int")),
        F.max(F.col("never").cast("int")), F.min(F.col("always").cast("int")),
    ).first()
    assert row[0] == pytest.approx(1 / 8, abs=0.03) and row[1] == pytest.approx(0.5, abs=0.03)
    assert (row[2], row[3]) == (0, 1)


def test_normalizer_is_global_and_population(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 3), (2, [3.0, 6.0], 0)], "id int, x array<float>, y int")
    stats = samples.fit_normalizer(df, "x")
    assert (stats.mean, stats.std) == (3.0, pytest.approx(np.std([1, 2, 3, 6])))
    rows = samples.labelled_samples(df, stats, "id", "x", "y").orderBy("id").collect()
    assert [r["label1"] for r in rows] == [4, 1]
    assert np.mean(np.square([r["features"] for r in rows])) == pytest.approx(1.0)


@pytest.mark.parametrize("ranges", [1, 7, None])
def test_with_position_numbers_in_key_order(spark, ranges):
    df = spark.range(500).select((F.col("id") * 7919 % 500 - 100).alias("k")).repartition(5)
    rows = samples.with_position(df, "k", ranges=ranges).collect()
    assert sorted((r["k"], r["pos"]) for r in rows) == [(i - 100, i) for i in range(500)]
    named = df.select(F.format_string("%05d", F.col("k") + 100).alias("k"))
    rows = samples.with_position(named, "k", ranges=ranges).collect()
    assert sorted((int(r["k"]), r["pos"]) for r in rows) == [(i, i) for i in range(500)]


def test_zip_needs_equal_sizes(spark):
    a, b = spark.range(10).toDF("a"), spark.range(11).toDF("b")
    with pytest.raises(ValueError, match="10 rows with 11"):
        samples.zip_by_position(a, b, "a", "b")
    empty = samples.zip_by_position(a.limit(0), b.limit(0), "a", "b")
    assert empty.count() == 0


def test_dimension_joined_by_broadcast_or_shuffle(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("class_id"))
    dim = spark.range(40).select(F.col("id").alias("class_id"), F.concat(F.lit("n"), "id").alias("name"))
    small = lookup.lookup(facts, dim, "class_id")
    large = lookup.lookup(facts, dim, "class_id", join="merge")
    assert sorted(small.select("id", "name").collect()) == sorted(large.select("id", "name").collect())
    assert small.count() == 3000 and small.where("name IS NULL").count() > 0
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()


def test_duplicate_names_collapse_to_the_last_class(spark):
    df = spark.createDataFrame([(1, [0.7, 0.1, 0.2])], "id int, scores array<double>")
    names = spark.createDataFrame([(0, "crane"), (1, "kite"), (2, "crane"), (3, "kite")], "class_id int, name string")
    got = {r["name"]: r["score"] for r in lookup.collapse_by_name(df, names, ["id"], 3).collect()}
    assert got == {"crane": 0.2, "kite": 0.1}


def test_minmax_and_histogram(spark):
    df = spark.createDataFrame([("a", [0.0, 5.0]), ("b", [10.0, -3.0, 2.5])], "k string, v array<double>")
    rows = inspect.minmax_scale(df, "v").orderBy("k").collect()
    assert rows[0]["scaled"] == pytest.approx([3 / 13, 8 / 13])
    bars = inspect.value_histogram(df, "v", 0.0, 10.0, 4, ["k"]).collect()
    assert {(r["k"], r["bucket"], r["n"]) for r in bars} == {
        ("a", 0, 1), ("a", 2, 1), ("b", 4, 1), ("b", -1, 1), ("b", 1, 1),
    }


def test_names():
    at = datetime(2024, 3, 5, 7, 8, 9)
    assert names.run_name_now("lr", at) == "lr-20240305-070809"
    assert names.model_file_name("quant_model", at) == "quant_model-2024-03-05-07-08-09"
