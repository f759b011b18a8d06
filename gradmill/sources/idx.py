"""IDX image and label files: few large ones by ranges, a folder of many as Spark lists it.

``read_idx`` is a data source whose split is a range of fixed-width records, so a
large file is read by many tasks. ``read_idx_folder`` takes any number of files
from any store that Spark reads. In both the record number is the key that pairs
images with labels.
"""

from __future__ import annotations

import gzip
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gradmill.operators.samples import running_total

#: Magic numbers of unsigned-byte IDX files, by number of dimensions.
MAGIC = {1: 2049, 3: 2051}
BATCH_BYTES = 8 << 20
SPLIT_BYTES = 64 << 20


@dataclass
class RecordRange(InputPartition):
    images: str
    labels: str
    start: int
    stop: int
    first_id: int


def _open(path: str):
    filesystem, inner = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=filesystem.open_input_stream(inner, compression=None))
    return filesystem.open_input_file(inner)


def _header(stream) -> tuple[int, ...]:
    magic = struct.unpack(">i", stream.read(4))[0]
    n_dims = magic & 0xFF
    if MAGIC.get(n_dims) != magic:
        raise ValueError(f"not an unsigned-byte IDX image or label file: magic {magic}")
    return struct.unpack(f">{n_dims}i", stream.read(4 * n_dims))


def _measured(spark: SparkSession, pairs: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
    """``(count, height, width)`` of every pair of files; tasks open them, not the driver."""

    def run(batches):
        for batch in batches:
            found = []
            for images, labels in zip(*(batch.column(c).to_pylist() for c in ("images", "labels"))):
                with _open(images) as f:
                    count, height, width = _header(f)
                with _open(labels) as f:
                    n_labels = _header(f)[0]
                if n_labels != count:
                    raise ValueError(f"{count} images but {n_labels} labels in {images}")
                found.append((count, height, width))
            columns = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("n"), *(pa.array(c, pa.int32()) for c in columns)],
                names=["n", "count", "height", "width"],
            )

    rows = [(n, *pair) for n, pair in enumerate(pairs)]
    table = spark.createDataFrame(rows, "n int, images string, labels string")
    parts = min(len(rows), spark.sparkContext.defaultParallelism)
    heads = table.repartition(parts).mapInArrow(run, "n int, count int, height int, width int")
    return [tuple(r)[1:] for r in sorted(heads.collect())]


class IdxReader(DataSourceReader):
    def __init__(self, options):
        pairs = zip(options["images"].split(","), options["labels"].split(","), strict=True)
        self.splits = int(options.get("splits", "0"))
        self.height, self.width = int(options["height"]), int(options["width"])
        self.files, first_id = [], 0
        for (images, labels), count in zip(pairs, map(int, options["counts"].split(",")), strict=True):
            self.files.append((images, labels, count, first_id))
            first_id += count

    def partitions(self):
        ranges = []
        for images, labels, count, first_id in self.files:
            gzipped = images.endswith(".gz") or labels.endswith(".gz")
            wanted = self.splits or count * self.height * self.width // SPLIT_BYTES
            n = 1 if gzipped else max(1, wanted)
            edges = [count * i // n for i in range(n + 1)]
            ranges += [
                RecordRange(images, labels, a, b, first_id)
                for a, b in zip(edges, edges[1:]) if b > a
            ]
        return ranges or [RecordRange(*self.files[0][:2], 0, 0, 0)]

    def read(self, part):
        size = self.height * self.width
        step = max(1, BATCH_BYTES // (4 * size))
        with _open(part.images) as images, _open(part.labels) as labels:
            images.seek(16 + part.start * size)
            labels.seek(8 + part.start)
            for at in range(part.start, part.stop, step):
                n = min(step, part.stop - at)
                pixels = np.frombuffer(images.read(n * size), np.uint8).astype(np.float32)
                label = np.frombuffer(labels.read(n), np.uint8).astype(np.int32)
                ids = np.arange(at, at + n, dtype=np.int64) + part.first_id
                offsets = np.arange(n + 1, dtype=np.int32) * size
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(pixels)),
                        pa.array(label),
                    ],
                    names=["id", "pixels", "label"],
                )


class IdxSource(DataSource):
    @classmethod
    def name(cls):
        return "idx"

    def schema(self):
        return "id bigint, pixels array<float>, label int"

    def reader(self, schema):
        return IdxReader(self.options)


def read_idx(
    spark: SparkSession, images: str | list[str], labels: str | list[str], splits: int = 0
) -> DataFrame:
    """``(id, pixels, label)`` of image files and their label files, plain or gzipped.

    The id is the record number, counted on over a list of files. Both files of
    a pair are read at the same record range, so pairing them needs no join.
    ``splits`` per file; 0 aims at 64 MB of pixels per task.
    """
    images, labels = ([p] if isinstance(p, str) else list(p) for p in (images, labels))
    measured = _measured(spark, list(zip(images, labels, strict=True)))
    if len({(height, width) for _, height, width in measured}) > 1:
        raise ValueError("the image files have different image sizes")
    spark.dataSource.register(IdxSource)
    reader = spark.read.format("idx").option("images", ",".join(images)).option("labels", ",".join(labels))
    reader = reader.option("counts", ",".join(str(count) for count, *_ in measured))
    _, height, width = measured[0]
    return reader.option("height", height).option("width", width).option("splits", splits).load()


# --- folders --------------------------------------------------------------------

#: How the files of a pair are named, after a stem that they share.
NAMES = {"images": "images-idx3-ubyte", "labels": "labels-idx1-ubyte"}


def _scan(spark: SparkSession, folder: str, kind: str, packed: bool) -> DataFrame:
    """``(stem, length, content)`` of the files of a kind; what is not asked for is not read."""
    suffix = NAMES[kind] + (".gz" if packed else "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    scan = files.option("pathGlobFilter", f"*{suffix}").load(folder)
    return scan.select(F.expr(f"left(path, length(path) - {len(suffix)})").alias("stem"), "length", "content")


def _unpacked(content: Column) -> Column:
    @F.arrow_udf(T.BinaryType())
    def unpack(content: pa.Array) -> pa.Array:
        return pa.array([gzip.decompress(x) for x in content.to_pylist()], pa.binary())

    return unpack(content)


def _contents(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    plain = _scan(spark, folder, kind, False).select("stem", "content")
    return plain.unionByName(_scan(spark, folder, kind, True).select("stem", _unpacked(F.col("content")).alias("content")))


def _int(content: Column, at: int) -> Column:
    """The big-endian number in four bytes from ``at``."""
    return F.conv(F.hex(F.substring(content, at + 1, 4)), 16, 10).cast("int")


def _checked(spark: SparkSession, folder: str) -> None:
    """An error that names a stem, if one has not one image file and one label file."""
    listed = None
    for kind in NAMES:
        for packed in (False, True):
            part = _scan(spark, folder, kind, packed).select("stem", F.lit(kind).alias("kind"))
            listed = part if listed is None else listed.unionByName(part)
    counts = listed.groupBy("stem").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in NAMES))
    wrong = counts.where("images <> 1 OR labels <> 1").first()
    if wrong:
        raise ValueError(f"{wrong.images} image files and {wrong.labels} label files begin with {wrong.stem}")


def _first_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(stem, n, first_id)``: the records of every label file and of those before it, by name."""
    plain = _scan(spark, folder, "labels", False).select("stem", (F.col("length") - 8).alias("n"))
    packed = _scan(spark, folder, "labels", True).select("stem", _unpacked(F.col("content")).alias("content"))
    packed = packed.select("stem", (F.length("content") - 8).cast("long").alias("n"))
    return running_total(plain.unionByName(packed), "stem", "n", "first_id")


def read_idx_folder(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, pixels, label)`` of all pairs ``…images-idx3-ubyte`` and ``…labels-idx1-ubyte`` below a folder.

    Files may be gzipped; the two of a pair have the same path up to these names. The id is the
    record number, counted on over the pairs in order of their paths. Spark lists the files and
    reads their bytes, and nothing about single files comes to the driver. Label files
    are broadcast if all their records number less than the session's broadcast
    threshold in bytes, else joined by path. A file is one row until it is cut into records, and a
    task holds several copies of it: meant for files of up to some 50 MB; use ``read_idx`` for larger ones. A folder without such files has
    no rows; a missing or second partner, unequal counts, other magic numbers and files cut short are errors.
    """
    _checked(spark, folder)
    firsts = _first_records(spark, folder)
    labels = _contents(spark, folder, "labels").withColumnRenamed("content", "labels").join(firsts, "stem")
    total = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if total < int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("bB")):
        labels = F.broadcast(labels)
    content, of_labels = F.col("content"), F.col("labels")
    count, size = _int(content, 4), _int(content, 8) * _int(content, 12)
    wrong = F.when((_int(content, 0) != MAGIC[3]) | (_int(of_labels, 0) != MAGIC[1]), F.concat(
        F.lit("not an unsigned-byte IDX image or label file: "), "stem"))
    wrong = wrong.when((count != _int(of_labels, 4)) | (count != F.col("n")), F.concat(
        count.cast("string"), F.lit(" images but "), F.col("n").cast("string"), F.lit(" labels in "), "stem"))
    wrong = wrong.when(F.length(content) != 16 + count.cast("long") * size, F.concat(
        F.lit("cut short or too long: "), "stem"))
    places = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("array<int>")).when(
        count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    pairs = _contents(spark, folder, "images").join(labels, "stem")
    records = pairs.select("content", "labels", "first_id", size.alias("size"), F.explode(places).alias("place"))
    at = F.col("place")

    def run(batches):
        for b in batches:
            ids, images, labels = b.columns
            values = images.to_pylist()
            offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
            pixels = np.frombuffer(b"".join(values), np.uint8).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(pixels))
            yield pa.RecordBatch.from_arrays([ids, lists, labels], ["id", "pixels", "label"])

    one = records.select(
        (F.col("first_id") + at).alias("id"),
        F.substring(content, at * F.col("size") + 17, F.col("size")).alias("image"),
        F.conv(F.hex(F.substring(of_labels, at + 9, F.lit(1))), 16, 10).cast("int").alias("label"),
    )
    # not a function in a projection: below it the whole file would go along with every record
    return one.mapInArrow(run, "id long, pixels array<float>, label int")
