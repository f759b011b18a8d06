"""Sample tables written by Spark in the file formats the sources read."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame

from gradmill.sources.idx import MAGIC


def store(path: str, content: bytes) -> None:
    """Write one file, creating its folder; runs on executors."""
    plain = path.replace("file://", "", 1) if path.startswith("file:") else path
    filesystem, inner = fs.FileSystem.from_uri(plain if "://" in plain else f"file://{plain}")
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(inner) as f:
        f.write(content)


def png(pixels: np.ndarray) -> bytes:
    """An H x W x 3 unsigned-byte image as PNG."""
    height, width, _ = pixels.shape
    lines = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))

    def chunk(kind: bytes, body: bytes) -> bytes:
        checksum = struct.pack(">I", zlib.crc32(kind + body))
        return struct.pack(">I", len(body)) + kind + body + checksum

    head = struct.pack(">2I5B", width, height, 8, 2, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head)
        + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    )


def write_png_folder(
    df: DataFrame, folder: str, key: str, label: str, pixels: str, side: int, split: str
) -> None:
    """``folder/split=…/label=…/key.png`` for every row of ``(key, label, pixels)``."""

    def write(rows):
        for name, kind, values in rows:
            image = np.array(values).reshape(side, side, 3)
            store(f"{folder}/split={split}/label={kind}/{name}.png", png(image))

    df.select(key, label, pixels).foreachPartition(write)


def idx_pair(images: np.ndarray, labels: np.ndarray) -> tuple[bytes, bytes]:
    """The image file and the label file of ``(n, h, w)`` and ``(n,)`` unsigned bytes."""
    head = struct.pack(">4i", MAGIC[3], *images.shape)
    label_head = struct.pack(">2i", MAGIC[1], len(labels))
    return (
        head + images.astype(np.uint8).tobytes(),
        label_head + labels.astype(np.uint8).tobytes(),
    )


def write_idx_shards(
    df: DataFrame, folder: str, key: str, label: str, pixels: str, side: int,
    shard_rows: int = 100,
) -> None:
    """One IDX pair per range of ``key``; the files in order hold the rows in key order."""
    shards = max(1, df.count() // shard_rows)
    ordered = df.select(key, label, pixels).repartitionByRange(shards, key)

    def write(rows):
        rows = list(rows)  # one shard
        if rows:
            stack = np.array([r[2] for r in rows]).reshape(-1, side, side)
            images, labels = idx_pair(stack, np.array([r[1] for r in rows]))
            first = f"{rows[0][0]:020d}"
            store(f"{folder}/{first}-images-idx3-ubyte", images)
            store(f"{folder}/{first}-labels-idx1-ubyte", labels)

    ordered.sortWithinPartitions(key).foreachPartition(write)


def write_sequence(df: DataFrame, path: str, label: str, pixels: str) -> None:
    """A (text, bytes) sequence file of class name and unsigned-byte pixels."""
    pairs = df.select(label, pixels).rdd.map(lambda r: (str(r[0]), bytearray(r[1])))
    pairs.saveAsSequenceFile(path)
