"""Image folders, named images and image sequence files."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradmill.operators.lookup import lookup, numbered_values

#: Paths of named images that a scan is filtered by at most.
LISTED = 10_000
# The columns of Spark's image source
IMAGE = T.StructField("image", T.StructType([
    T.StructField("origin", T.StringType()), T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()), T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()), T.StructField("data", T.BinaryType()),
]))
IMAGE_FIELDS = ("height", "width", "nChannels", "data")


def _flat(image: DataFrame, keep: list[str]) -> DataFrame:
    return image.select(
        F.col("image.origin").alias("path"), *keep, *[F.col(f"image.{f}") for f in IMAGE_FIELDS]
    )


def _by_folder(spark: SparkSession, root: str) -> DataFrame | None:
    """Scan of ``root/split=…/label=…`` with both as partition columns; None for another layout."""
    plain = spark.read.format("image").option("dropInvalid", True)
    # named here, so that labels like 01 stay strings
    columns = T.StructType([IMAGE, T.StructField("split", T.StringType()), T.StructField("label", T.StringType())])
    try:
        return plain.option("basePath", root).schema(columns).load(f"{root}/split=*/label=*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def image_folder(
    spark: SparkSession, root: str, split: str | None = None, has_label: bool = True,
    classes: DataFrame | None = None,
) -> DataFrame:
    """Decoded images ``(path, [label_name, label], height, width, nChannels, data)``.

    ``root/split/label/file`` as well as ``root/split=…/label=…/file`` are
    understood; in the second, split and label are partition columns of the scan, so a
    filter on ``label_name`` opens the files of its folders only. Class ids number the
    sorted class names from 0, unless ``classes`` ``(label_name, label)`` gives them. Files
    that do not decode are left out. The bytes are as Spark decodes them: B, G, R.
    """
    folder = root.rstrip("/")
    scan = _by_folder(spark, folder) if has_label else None
    if scan is not None:
        if split is not None:
            scan = scan.where(F.col("split") == split)
        named = scan.select("image", F.col("label").alias("label_name"))
    if split is not None:
        folder = f"{folder}/{{{split},split={split}}}"
    if scan is None:
        scan = (
            spark.read.format("image").option("dropInvalid", True)
            .option("recursiveFileLookup", True).load(folder)
        )
        if not has_label:
            return _flat(scan, [])
        parent = F.element_at(F.split("image.origin", "/"), -2)
        named = scan.select("image", F.regexp_replace(parent, "^label=", "").alias("label_name"))
    images = _flat(named, ["label_name"])
    if classes is None:
        # the paths alone give the class names: no file is opened for them
        paths = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
            .select(F.element_at(F.split("path", "/"), -2).alias("dir"))
            .select(F.regexp_replace("dir", "^label=", "").alias("label_name"))
        )
        classes = numbered_values(paths, "label_name", "label")
    return lookup(images, classes, "label_name")


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def named_images(
    spark: SparkSession, names: Mapping[str, str] | DataFrame, root: str | None = None
) -> DataFrame:
    """``(name, path, height, width, nChannels, data)`` for a list of named files.

    The list is ``{name: path}``, or for any number of files a table ``(name,
    path)`` of files below the folder ``root``. Paths are matched against the listing
    of the folder, which opens no file. Up to ``LISTED`` of the files found are handed to
    the scan as a filter on their paths, so that Spark opens no other; a longer list
    is joined to a scan of the folder.
    """
    if isinstance(names, DataFrame):
        wanted, place, options = names.select("name", "path"), root, {"recursiveFileLookup": True}
    else:
        wanted, place, options = spark.createDataFrame(list(names.items()), "name string, path string"), list(names.values()), {}
    listing = spark.read.format("binaryFile").options(**options).load(place)
    # the same file by the name users write and by the one Spark filters by
    listed = listing.select(F.col("_metadata.file_path").alias("file"), _plain(F.col("path")).alias("key"))
    found = listed.join(wanted.select("name", _plain(F.col("path")).alias("key")), "key").select("name", "file")
    few = found.select("file").distinct().limit(LISTED + 1).collect()
    scan = spark.read.format("image").option("dropInvalid", True).options(**options).load(place)
    if len(few) <= LISTED:
        scan = scan.where(F.col("_metadata.file_path").isin([r["file"] for r in few]))
    images = _flat(scan.select("image", F.col("_metadata.file_path").alias("file")), ["file"])
    return images.join(found, "file").drop("file")


def image_sequence(spark: SparkSession, path: str, shape: tuple[int, int, int]) -> DataFrame:
    """``(label_name, height, width, nChannels, data)`` from a (text, bytes) sequence file.

    The key is the class, the value the row-major unsigned bytes of one image.
    No DataFrame reader knows this format, so records pass through Python one by one.
    """
    pairs = spark.sparkContext.sequenceFile(path).map(lambda kv: (kv[0], bytes(kv[1])))
    table = spark.createDataFrame(pairs, "label_name string, data binary")
    h, w, c = (F.lit(n) for n in shape)
    return table.select(
        "label_name", h.alias("height"), w.alias("width"), c.alias("nChannels"), "data"
    )


def image_data(
    spark: SparkSession, folder: str, file_type: str = "image", split: str = "train",
    shape: tuple[int, int, int] | None = None,
) -> DataFrame:
    """The ``split`` part of a data folder, as image files or as a sequence file."""
    if file_type == "image":
        return image_folder(spark, folder, split)
    if file_type == "seq":
        if shape is None:
            raise ValueError("a sequence file needs the image shape")
        return image_sequence(spark, f"{folder.rstrip('/')}/{split}", shape)
    raise ValueError(f"unknown file type {file_type!r}")


def byte_pixels(data: Column, bgr: bool = True) -> Column:
    """Three-channel binary images as ``array<smallint>`` of bytes in R, G, B order."""

    @F.arrow_udf(T.ArrayType(T.ShortType()))
    def unpack(data: pa.Array) -> pa.Array:
        lengths = [len(buf) for buf in data.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        flat = np.frombuffer(b"".join(data.to_pylist()), np.uint8).astype(np.int16)
        if bgr:
            flat = flat.reshape(-1, 3)[:, ::-1].ravel()
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return unpack(data)
