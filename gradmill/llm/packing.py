"""Packing of tokenized documents into sequences of a fixed capacity.

A document is its token ids and an end id. Documents longer than the capacity
are cut into pieces that are all full, but for the first one, which may be
shorter. All pieces go into as few sequences as the method finds:

* **What matters is a histogram.** Lengths are whole numbers up to the capacity,
  so an instance of any number of pieces is one count per length. The plan is
  made on these counts, and exactly: every step moves many equal pieces at once.
* **Dominance reduction** (Martello and Toth, 1990). A set that holds length j is
  fixed for good if some optimal packing has it: j alone if nothing fits beside
  it; j with its exact complement; j with the longest that fits, if no two
  others fit beside j, or no two that together are longer than that one.
* **Best fit, longest first,** packs what the reduction leaves.

A plan is a list of patterns (lengths in one sequence, number of sequences).
Pieces are numbered within their length: each task counts its own, a running
sum over tasks of the counts per length makes the numbers global. Piece number
r of a length takes the r-th slot of that length; the table of slots has a size
bounded by the capacity and goes to all tasks. No piece is moved by content,
and a length that a third of all pieces have is spread like any other.

NULL and empty texts are the end id alone; every input row is a document of its
own, repeated or not; NULL ids are carried along.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradmill.llm.tables import kept

CAPACITY = 1024
END_ID = 2


# --- tokens ---------------------------------------------------------------------


class Encoder:
    """Token ids as the library ``tokenizers`` gives them, without added special tokens.

    Texts of plain Latin characters take a faster library over the same
    vocabulary and merge order, where both are known to agree; all others, long
    blanks, and texts that spell a special token go to ``tokenizers`` itself.
    """

    _PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ɏ]*")
    _BLANKS = re.compile(r"\s{512}")

    def __init__(self, vocabulary: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(vocabulary)
        content = json.loads(vocabulary)
        self.special = [t["content"] for t in content["added_tokens"]]
        back = {c: b for b, c in _byte_characters().items()}
        ranks = {bytes(back[c] for c in t): i for t, i in content["model"]["vocab"].items()
                 if t not in self.special}
        self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if (self._PLAIN.fullmatch(text) and not self._BLANKS.search(text)
                and not any(s in text for s in self.special)):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def _byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write visible Latin-1 bytes as themselves, the others from U+0100 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: str, pattern: str) -> Encoder:
    """One per Python worker and vocabulary."""
    key = zlib.crc32(vocabulary.encode())
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary, pattern)
    return _encoders[key]


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document."""
    first = (length - 1) % capacity + 1
    starts = [0, *range(first, length, capacity)]
    return [(s, first if s == 0 else capacity) for s in starts]


def pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, task, place[, ids])``.

    ``place`` numbers the pieces of one length within their task, from 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
              *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "task", "place"))]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        encoder, task, seen = _encoder(shared.value, pattern), TaskContext.get().partitionId(), Counter()
        for b in batches:
            doc, rows, tokens = [], [], []
            for d, text in enumerate(b.column(1).to_pylist()):
                ids = np.array([*encoder.ids(text or ""), end_id], "<u4")
                for n, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start:start + length]
                    doc.append(d)
                    rows.append((n, start, length, zlib.crc32(part.tobytes()), task, seen[length]))
                    seen[length] += 1
                    if keep_ids:
                        tokens.append(part.astype(np.int32))
            columns = np.array(rows, np.int64).reshape(len(rows), 6).T
            arrays = [b.column(0).take(pa.array(doc, pa.int64())), pa.array(columns[0].astype(np.int32)),
                      *map(pa.array, columns[1:])]
            if keep_ids:
                arrays.append(pa.array(tokens, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


# --- the plan -------------------------------------------------------------------


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list, dict[int, int]]:
    """``(patterns, rest)``: sets that some optimal packing has, and what is left."""
    left = {w: n for w, n in counts.items() if n}
    fixed, again = [], True
    while again:
        again = False
        for j in sorted(left, reverse=True):
            while left.get(j) and (found := _dominating(j, left, capacity)):
                need = Counter(found)
                times = min(left[w] // n for w, n in need.items())
                fixed.append((found, times))
                again = True
                for w, n in need.items():
                    left[w] -= n * times
                    if not left[w]:
                        del left[w]
    return fixed, left


def _dominating(j: int, left: dict[int, int], capacity: int) -> tuple[int, ...] | None:
    """The set around one ``j`` that dominates all others, if there is a plain proof."""
    room = capacity - j
    fits = sorted(w for w in left if w <= room and (w != j or left[j] > 1))
    if not fits:
        return (j,)
    k = fits[-1]
    if k == room:
        return (j, k)
    # the three smallest companions, with repetition as far as there are pieces
    small = [w for w in fits[:3] for _ in range(min(3, left[w] - (w == j)))][:3]
    if len(small) < 2 or small[0] + small[1] > room:
        return (j, k)
    if len(small) < 3 or sum(small) > room:
        pairs = (w + max((v for v in fits if v <= room - w and (v != w or left[w] - (w == j) > 1)), default=-w)
                 for w in fits)
        if max(pairs) <= k:
            return (j, k)
    return None


def best_fit(counts: dict[int, int], capacity: int) -> list:
    """Best fit, longest first, of equal pieces in bulk: ``[(lengths, number of sequences)]``."""
    open_: dict[int, list] = {}  # room left: [(lengths, number)]
    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            room = min((r for r in open_ if r >= w), default=capacity)
            content, times = open_[room].pop() if room in open_ else ((), n)
            if room in open_ and not open_[room]:
                del open_[room]
            each = min(room // w, n)  # the fullest sequence stays the best one until w no longer fits
            here = min(times, n // each)
            if content and here < times:
                open_.setdefault(room, []).append((content, times - here))
            open_.setdefault(room - each * w, []).append((content + (w,) * each, here))
            n -= each * here
    return [x for group in open_.values() for x in group]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list:
    """Patterns that hold every piece exactly once."""
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def slots(patterns: list) -> np.ndarray:
    """Rows ``(length, first piece number, first sequence, offset)``, sorted."""
    rows, used, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for w in lengths:
            rows.append((w, used[w], sequence, offset))
            used[w] += times
            offset += w
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(len(rows), 4)


# --- the job --------------------------------------------------------------------


def pack(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY,
         end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])``: one row per piece.

    ``vocabulary``: the content of a byte-level tokenizer file; ``pattern``: its
    pre-tokenizing expression.
    """
    cut = kept(pieces(docs, vocabulary, pattern, capacity, end_id, keep_ids), "pieces")
    per_task = kept(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = cut.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # as many rows as there are tasks and lengths: they grow with the data, so they are not broadcast
    numbered = cut.join(bases.hint("merge"), ["task", "length"]).withColumn("number", F.col("base") + F.col("place"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    out = [cut.schema[c] for c in names]
    out += [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]

    def place(batches):
        rows = table.value
        shift = np.int64(1) << 50
        keys = rows[:, 0] * shift + rows[:, 1]
        for b in batches:
            length, number = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.searchsorted(keys, length * shift + number, "right") - 1
            found = rows[at]
            arrays = [b.column(c) for c in names]
            arrays += [pa.array(found[:, 2] + number - found[:, 1]), pa.array(found[:, 3])]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in out])

    return numbered.select(*names, "number").mapInArrow(place, T.StructType(out))
