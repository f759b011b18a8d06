"""Image transforms on flat row-major H x W x C images.

An image has some hundred thousand values: too many for expressions that are
interpreted element by element, and costly to move between the JVM and Python.
So a chain of transforms is one numpy pass over the Arrow batches of its
column, from the image bytes to the finished input. Random choices come in as
columns, from the keyed hash of the row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from gradmill.functions.hashing import coin, keyed_hash

#: Channel means and deviations (R, G, B) of the image classifiers.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


@dataclass(frozen=True)
class Step:
    """``change(stack, *choices)`` on images stacked as (n, height, width, channels)."""

    change: Callable[..., np.ndarray]
    choices: tuple[Column, ...] = ()


def scale_u8(normalize: float = 255.0) -> Step:
    """Unsigned-byte values divided by ``normalize``."""
    return Step(lambda s: ((s.astype(np.int32) & 255) / normalize).astype(np.float32))


def scale_pm1() -> Step:
    """Byte values mapped to [-1, 1]: ``x / 127.5 - 1``."""
    return Step(lambda s: (s / 127.5 - 1.0).astype(np.float32))


def channel_normalize(mean=CHANNEL_MEAN, std=CHANNEL_STD) -> Step:
    """``(x - mean[c]) / std[c]``."""
    return Step(
        lambda s: ((s.astype(np.float64) - np.array(mean)) / np.array(std)).astype(np.float32)
    )


def resize_nearest(out_h: int, out_w: int) -> Step:
    """Nearest-neighbour resize."""

    def change(stack: np.ndarray) -> np.ndarray:
        rows = np.arange(out_h) * stack.shape[1] // out_h
        cols = np.arange(out_w) * stack.shape[2] // out_w
        return stack[:, rows][:, :, cols]

    return Step(change)


def crop_center(out_h: int, out_w: int) -> Step:
    """The central window; an odd margin leaves the extra pixel below and right."""

    def change(stack: np.ndarray) -> np.ndarray:
        top, left = (stack.shape[1] - out_h) // 2, (stack.shape[2] - out_w) // 2
        return stack[:, top : top + out_h, left : left + out_w]

    return Step(change)


def crop_random(out_h: int, out_w: int, key: Column, seed: int, epoch: int = 0) -> Step:
    """A window whose corner is drawn from the keyed hash of the row."""

    def change(stack: np.ndarray, draw: np.ndarray) -> np.ndarray:
        n, height, width, channels = stack.shape
        n_top, n_left = height - out_h + 1, width - out_w + 1
        out = np.empty((n, out_h, out_w, channels), stack.dtype)
        for image, target, d in zip(stack, out, draw.tolist()):
            top, left = d // n_left % n_top, d % n_left
            target[:] = image[top : top + out_h, left : left + out_w]
        return out

    return Step(change, (keyed_hash(key, seed, epoch),))


def flip_horizontal() -> Step:
    """Mirror every row."""
    return Step(lambda s: s[:, :, ::-1])


def flip_random(key: Column, p: float = 0.5, seed: int = 0, epoch: int = 0) -> Step:
    """Mirror a share ``p`` of the images, chosen by the keyed coin."""

    def change(stack: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return np.where(heads.astype(bool)[:, None, None, None], stack[:, :, ::-1], stack)

    return Step(change, (coin(key, p, seed, epoch),))


def to_chw() -> Step:
    """H x W x C order to C x H x W order."""
    return Step(lambda s: s.transpose(0, 3, 1, 2))


@dataclass(frozen=True)
class Pixels:
    """Images as columns, how to read them as a stack, and what is done to it."""

    columns: tuple[Column, ...]
    read: Callable[..., np.ndarray]
    steps: tuple[Step, ...] = ()

    def then(self, *steps: Step) -> Pixels:
        """The same images with further transforms, applied left to right."""
        return replace(self, steps=self.steps + steps)

    def inputs(self) -> list[Column]:
        """All columns the transforms need."""
        return [*self.columns, *(c for step in self.steps for c in step.choices)]

    def stack(self, arrays: list[pa.Array]) -> np.ndarray:
        """The transformed stack of one Arrow batch, whose images are not null."""
        at = len(self.columns)
        out = self.read(*arrays[:at])
        for step in self.steps:
            drawn = arrays[at : at + len(step.choices)]
            out = step.change(out, *[d.to_numpy(zero_copy_only=False) for d in drawn])
            at += len(drawn)
        return out

    def reader(self) -> Callable[[list[pa.Array]], np.ndarray]:
        """:meth:`stack` without the columns, which stay on the driver."""
        steps = tuple(Step(s.change, (None,) * len(s.choices)) for s in self.steps)
        return replace(self, columns=(None,) * len(self.columns), steps=steps).stack


#: Images a task transforms at once: a result may be many times larger than its input.
IMAGES = 64


def sliced(batches, rows: int = IMAGES):
    """Arrow batches cut to at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _lists(stack: np.ndarray, present: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(present * int(np.prod(stack.shape[1:])))])
    return pa.ListArray.from_arrays(
        pa.array(ends.astype(np.int32)), pa.array(stack.astype(np.float32).ravel()),
        mask=None if present.all() else pa.array(~present),
    )


def transformed(df: DataFrame, pixels: Pixels, keep: list[str], into: str = "features") -> DataFrame:
    """``keep`` plus the transformed images as flat ``array<float>``; null images stay null."""
    stack, n_keep = pixels.reader(), len(keep)
    named = [c.alias(f"_x{i}") for i, c in enumerate(pixels.inputs())]
    fields = [f for f in df.select(*keep).schema]
    schema = T.StructType([*fields, T.StructField(into, T.ArrayType(T.FloatType()))])

    def run(batches):
        for batch in sliced(batches):
            arrays = batch.columns[n_keep:]
            valid = arrays[0].is_valid()
            present = valid.to_numpy(zero_copy_only=False)
            done = stack([a.filter(valid) for a in arrays]) if present.any() else np.zeros((0, 0))
            columns = [*batch.columns[:n_keep], _lists(done, present)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*keep, *named).mapInArrow(run, schema)


def from_array(pixels: Column, height: int, width: int, channels: int) -> Pixels:
    """Images of one size held in an array column."""

    def read(column: pa.Array) -> np.ndarray:
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        if (lengths != height * width * channels).any():
            raise ValueError(f"images of {sorted(set(lengths.tolist()))} values, not {height} x {width} x {channels}")
        values = column.flatten().to_numpy(zero_copy_only=False)
        return values.reshape(-1, height, width, channels)

    return Pixels((pixels,), read)


def _taps(n_in: int, n_out: int):
    centre = np.clip((np.arange(n_out) + 0.5) * n_in / n_out - 0.5, 0, n_in - 1)
    low = np.floor(centre).astype(int)
    return low, np.minimum(low + 1, n_in - 1), centre - low


def _bilinear(image: np.ndarray, out_h: int, out_w: int) -> np.ndarray:
    y0, y1, fy = _taps(image.shape[0], out_h)
    x0, x1, fx = _taps(image.shape[1], out_w)
    rows = image[y0] * (1 - fy)[:, None, None] + image[y1] * fy[:, None, None]
    mixed = rows[:, x0] * (1 - fx)[None, :, None] + rows[:, x1] * fx[None, :, None]
    return np.floor(mixed + 0.5).astype(np.int16)


def resized_bytes(
    data: Column, height: Column, width: Column, channels: Column, out_h: int, out_w: int,
    bgr: bool = True,
) -> Pixels:
    """Unsigned-byte images of any sizes in a binary column, bilinearly resized.

    Half-pixel centres, edges clamped, result rounded half up to bytes; ``bgr``
    reverses the channels.
    """

    def read(data: pa.Array, h: pa.Array, w: pa.Array, c: pa.Array) -> np.ndarray:
        out = []
        for buf, ih, iw, ic in zip(data, h.to_pylist(), w.to_pylist(), c.to_pylist()):
            image = np.frombuffer(buf.as_buffer(), np.uint8).reshape(ih, iw, ic)
            small = _bilinear(image.astype(np.float64), out_h, out_w)
            out.append(small[..., ::-1] if bgr else small)
        return np.stack(out)

    return Pixels((data, height, width, channels), read)
