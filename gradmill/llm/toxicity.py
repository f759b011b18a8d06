"""Toxicity scores by a factorization machine over hashed terms.

A document is the set of its terms: lower-cased words, and word beginnings of
four and five letters, which inflected forms share. Every term is hashed to one of
``2**BITS`` slots that hold a weight and a short vector, so the model has a
fixed size. The score is the logistic of

    bias + sum of weights + sum over term pairs of <vector, vector>

where the pair sum is computed in linear time (Rendle, 2010). The pair part
learns what no single term tells, such as an insult next to a group's name.

Learning happens on the driver, on a bounded sample: at most ``SAMPLE``
labelled documents, the ones with the smallest keyed hash. Scoring is one pass
over the table without a shuffle; only the model is broadcast.

Results for the odd cases: NULL and empty texts have no terms and score as the bias
alone; whole texts are read however long; every row gets its own score, also if it repeats
an id or a text, and equal texts score alike. An empty table gives an empty result, and
without labels of both sorts every score is the smoothed share of label 1.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradmill.llm.tables import kept

BITS = 18
#: The most labelled documents that learning looks at.
SAMPLE = 16384
FACTORS = 4
EPOCHS = 8
BATCH = 128
#: Steps made at least, however few the rows.
LEAST_STEPS = 250
#: A document with this score or more counts as toxic.
THRESHOLD = 0.3
#: Slots seen in fewer sampled documents keep weight 0.
LEAST_DOCS = 8

_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> np.ndarray:
    """The sorted distinct slots of a whole text; none for NULL or no words."""
    words = set(_WORD.findall(text.lower())) if text else ()
    words = {*words, *(w[:n] + "*" for n in (4, 5) for w in words if len(w) > n)}
    mask = (1 << BITS) - 1
    slots = {zlib.crc32(w.encode("utf-8", "surrogatepass")) & mask for w in words}
    return np.fromiter(sorted(slots), np.int32, len(slots))


@dataclass
class Model:
    """``bias``, one ``weight`` and one row of ``vectors`` per slot."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margins(self, slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """For documents whose slots lie one after another from ``starts`` on."""
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        out = self.bias + np.bincount(doc, self.weights[slots], len(starts) - 1)
        for v in self.vectors.T:
            x = v[slots].astype(np.float64)
            out += 0.5 * np.bincount(doc, x, len(starts) - 1) ** 2
            out -= 0.5 * np.bincount(doc, x * x, len(starts) - 1)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        slots = [terms(t) for t in texts]
        starts = np.cumsum([0, *map(len, slots)])
        flat = np.concatenate(slots) if slots else np.zeros(0, np.int32)
        return _logistic(self.margins(flat, starts))


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_model(slots: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Learn from documents given as their sorted distinct slots."""
    flat = np.concatenate(slots) if len(slots) else np.zeros(0, np.int32)
    docs = np.bincount(flat, minlength=1 << BITS)
    used = np.flatnonzero(docs >= LEAST_DOCS)
    kept_ones = [s[docs[s] >= LEAST_DOCS] for s in slots]
    starts = np.cumsum([0, *map(len, kept_ones)])
    places = np.searchsorted(used, np.concatenate(kept_ones)) if len(slots) else flat
    return learn(places.astype(np.int32), starts, used, labels, seed)


def learn(places: np.ndarray, starts: np.ndarray, used: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Logistic loss, AdaGrad over small batches, in a fixed order of ``seed``.

    ``places`` are positions in ``used``, the slots that count, of one document after
    another, which begin at ``starts``. With no rows or one class only, the model is its
    bias: the smoothed share of label 1.
    """
    size, n = 1 << BITS, len(labels)
    rate = (labels.sum() + 0.01) / (n + 1.0)
    model = Model(float(np.log(rate / (1 - rate))), np.zeros(size, np.float32),
                  np.zeros((size, FACTORS), np.float32))
    if n == 0 or labels.min() == labels.max():
        return model
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(len(used)), rng.normal(0, 0.01, (FACTORS, len(used))), model.bias
    gw, gv, gb = np.full(len(used), 1e-2), np.ones(v.shape), 1.0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // -(-n // BATCH)))):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            part = order[at:at + BATCH]
            flat = np.concatenate([places[starts[i]:starts[i + 1]] for i in part])
            doc = np.repeat(np.arange(len(part)), starts[part + 1] - starts[part])
            x = v[:, flat]
            sums = np.stack([np.bincount(doc, f, len(part)) for f in x])
            margin = b + np.bincount(doc, w[flat], len(part)) + 0.5 * (sums**2).sum(0)
            margin -= 0.5 * np.bincount(doc, (x * x).sum(0), len(part))
            slope = (_logistic(margin) - labels[part]) / len(part)
            each = slope[doc]
            d = np.bincount(flat, each, len(used)) + 1e-3 * w
            gw += d * d
            w -= 0.3 * d / np.sqrt(gw)
            for f in range(FACTORS):
                d = np.bincount(flat, each * (sums[f, doc] - x[f]), len(used)) + 1e-4 * v[f]
                gv[f] += d * d
                v[f] -= 0.3 * d / np.sqrt(gv[f])
            gb += slope.sum() ** 2
            b -= 0.05 * slope.sum() / np.sqrt(gb)
    model.bias = float(b)
    model.weights[used] = w
    model.vectors[used] = v.T
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; never for a NULL id."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn ``labels.toxic`` from ``docs.text``, without the held-out documents.

    Labels that are NULL or whose document is missing are passed over; of
    several labels of one document the largest counts. The sample is written; at most
    ``sample`` rows of it come to the driver, as the slots that enough of them have.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = kept(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most `sample` narrow rows
        .select(F.xxhash64("doc_id", "text").alias("h"), "toxic", "text")
        .mapInArrow(_slot_batches, "h long, toxic int, slots binary")
        .orderBy("h", "slots").limit(sample), "toxicity-sample")
    counts = rows.select("slots").mapInArrow(_slot_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    used = np.sort(counts.where(F.col("n") >= LEAST_DOCS).select("slot").toArrow().column(0).to_numpy())  # 2**BITS at most
    shared = docs.sparkSession.sparkContext.broadcast(used)

    def places(batches):
        for b in batches:
            found = []
            for s in b.column(2):
                s = np.frombuffer(s.as_buffer(), np.int32)
                at = np.searchsorted(shared.value, s)
                at[at == len(shared.value)] = 0
                found.append(at[shared.value[at] == s].astype(np.int32).tobytes() if len(shared.value) else b"")
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.binary())], ["toxic", "places"])

    sent = rows.orderBy("h", "slots").mapInArrow(places, "toxic int, places binary").toArrow()
    labels_of = (sent.column(0).to_numpy() > 0).astype(np.float64)
    starts = np.append(0, np.cumsum(pc.binary_length(sent.column(1)).to_numpy() // 4)).astype(np.int64)
    flat = np.empty(starts[-1], np.int32)
    for n, s in enumerate(sent.column(1)):
        flat[starts[n]:starts[n + 1]] = np.frombuffer(s.as_buffer(), np.int32)
    del sent
    return learn(flat, starts, used, labels_of)


def _slot_counts(batches):
    for b in batches:
        n = np.bincount(np.concatenate([np.frombuffer(s.as_buffer(), np.int32) for s in b.column(0)] or [np.zeros(0, np.int32)]))
        slot = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(n[slot])], ["slot", "n"])


def _slot_batches(batches):
    for b in batches:
        slots = [terms(t).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("h"), b.column("toxic").cast(pa.int32()), pa.array(slots, pa.binary())],
            ["h", "toxic", "slots"],
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)``, one row per input row; NULL and empty texts score as no terms."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            values = shared.value.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", kind), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            values = shared.value.scores(b.column(at).to_pylist())
            yield b.filter(pa.array(values < threshold))

    return docs.mapInArrow(run, docs.schema)
