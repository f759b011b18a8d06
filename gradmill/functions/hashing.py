"""A keyed hash that gives every engine the same batch number or coin."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One past the largest value :func:`keyed_hash` returns.
HASH_RANGE = 1 << 32


def keyed_hash(key: Column, seed: int, epoch: int = 0) -> Column:
    """First 32 bits of ``md5("key:seed:epoch")`` as a bigint.

    Unlike ``rand()`` it depends on the row alone, so results do not move with
    the partitioning or with a retried task.
    """
    text = F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(str(epoch)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def batch_number(key: Column, n_batches: int, seed: int, epoch: int) -> Column:
    """The minibatch a row belongs to in an epoch."""
    return F.pmod(keyed_hash(key, seed, epoch), F.lit(n_batches)).cast("int")


def coin(key: Column, p: float, seed: int, epoch: int = 0) -> Column:
    """True for a share ``p`` of the keys."""
    return keyed_hash(key, seed, epoch) < F.lit(int(p * HASH_RANGE))
