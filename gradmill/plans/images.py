"""From decoded images to classes, each as one lazy plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.functions import pixels as px
from gradmill.operators.lookup import with_class_name
from gradmill.plans.models import Model
from gradmill.plans.score import Params, predict_top_k, top_k_named


def resized(side: int, bgr: bool = True) -> px.Pixels:
    """The images of a source table at side x side, in R, G, B order."""
    fields = (F.col(name) for name in ("data", "height", "width", "nChannels"))
    return px.resized_bytes(*fields, side, side, bgr)


def train_steps(crop: int, key: Column, seed: int, epoch: int = 0) -> list[px.Step]:
    """Random crop, random mirror, channel normalization, C x H x W order."""
    return [
        px.scale_u8(), px.crop_random(crop, crop, key, seed, epoch),
        px.flip_random(key, 0.5, seed + 1, epoch), px.channel_normalize(), px.to_chw(),
    ]


def validation_steps(crop: int, key: Column, seed: int, epoch: int = 0) -> list[px.Step]:
    """The same with a central crop; the mirror stays random."""
    return [
        px.scale_u8(), px.crop_center(crop, crop),
        px.flip_random(key, 0.5, seed + 1, epoch), px.channel_normalize(), px.to_chw(),
    ]


def image_samples(
    images: DataFrame, key: str, side: int, crop: int, split: str, seed: int = 0, epoch: int = 0,
    label: str = "label",
) -> DataFrame:
    """``(key, features, label1)`` of a labelled image table, for ``train`` or ``val``."""
    steps = train_steps if split == "train" else validation_steps
    view = resized(side).then(*steps(crop, F.col(key), seed, epoch))
    done = px.transformed(images, view, [key, label])
    return done.select(key, "features", (F.col(label) + 1).cast("int").alias("label1"))


def classify_images(
    images: DataFrame, model: Model, params: Params, names: DataFrame, side: int,
    keep: list[str], bgr: bool = True, name: str = "name",
) -> DataFrame:
    """``(keep…, class_id, name)``: resize, score, best class (1-based), class name.

    Resizing and scoring happen in the same pass over the image bytes.
    """
    best = predict_top_k(images, model, params, keep, 1, resized(side, bgr))
    classes = best.select(*keep, (F.col("best")[0]["class_id"] + 1).alias("class_id"))
    return with_class_name(classes, names, name=name)


def classify_named(
    images: DataFrame, model: Model, params: Params, names: DataFrame, side: int,
    keep: list[str], k: int = 5, bgr: bool = True,
) -> DataFrame:
    """The ``k`` best class names of every image, inputs scaled to [-1, 1]."""
    inputs = resized(side, bgr).then(px.scale_pm1())
    return top_k_named(predict_top_k(images, model, params, keep, k, inputs), names, keep)
