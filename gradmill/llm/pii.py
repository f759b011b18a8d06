"""Personal data by patterns and a skip-chain conditional random field.

**Base spans** come from fixed patterns with checks (see ``base_spans``), each
kind by itself, leftmost and non-overlapping.

**The field** labels tokens that hold a digit or ``@`` (all others are no
personal data by definition of the label set) with a kind or none. Its
potentials: a token's form and neighbours; the labels of tokens side by side (the chain);
and the labels of distant tokens that repeat or resemble each other (the skips):
same letters and digits, same last seven digits, same mailbox name. Each
occurrence is linked to the one before, and, when spans are looked for, one that is not
in a base span also to the last one before that is, else to the first one after: any
number of repeats are one link away from it, with a few links per token.
Tokens of base spans are observed. Loopy message passing, until the messages of a
document settle, carries their labels along chain and skips through all of it, so that
``+1 (972) 555-5545`` makes a later ``972-5555545`` a phone number too. Tokens
whose marginal reaches ``SURE`` give additional spans.

**Learning** maximizes the pseudo-likelihood, on the driver, on a bounded
sample: the tokens of at most ``SAMPLE_DOCS`` documents with the smallest keyed
hash, at most ``SAMPLE_TOKENS`` of them, labelled by the base spans. Half of
them are seen without their form, so that the links get a weight of their own.

Finding is one pass without a shuffle. NULL texts count as empty; offsets are
code points, ends are exclusive. Whole texts are searched; a token's form looks at its
first 200 characters and 24 beside it, base spans have no such limit. Every row is
searched by itself, also with a NULL id or one that repeats with the same or another
text. Spans that start at the same place are in the order of the kinds. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Order of the kinds wherever spans start at the same place.
KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0 is none
SAMPLE_DOCS = 4096
SAMPLE_TOKENS = 20_000
SLOTS = 1 << 14
FEATURES = 11
#: Rounds after which messages that do not settle are left; others do, mostly in some dozens.
STEPS = 1000
SETTLED = 1e-7
SURE = 0.9
_OBSERVED = 30.0

# --- base spans -----------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match never begins inside a run of digits: the part before would have matched as well.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def _emails(text: str):
    """Around every ``@``: the run before it, not reaching into the last match, and a domain."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if domain:
            yield start, domain.end()
            done = at = domain.end()


def _byte_part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def _luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)``, sorted; matches that fail their check are dropped."""
    found = [(s, 0, e) for s, e in _emails(text)]
    if not _DIGITS.search(text):
        return found
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
              if all(map(_byte_part, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGITS.findall(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- tokens and their graph -----------------------------------------------------

_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
_LEAD = re.compile(r"[^0-9A-Za-z+(]*")
_LETTERS = re.compile(r"[^\W\d_]+")
_PLAIN_OUT = re.compile(r"[\W_]+")


@dataclass
class Graph:
    """Tokens of one or more documents: features, observed labels, links ``(i, j, kind)``."""

    spans: list[tuple[int, int]] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    links: list[tuple[int, int, int]] = field(default_factory=list)


def _slot(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % (SLOTS - 1) + 1


def _neighbour(text: str, at: int, step: int) -> str:
    """The word before or after a place, 24 characters of it at most."""
    near = text[max(0, at - 24):at].split() if step < 0 else text[at:at + 24].split()
    return near[step if step < 0 else 0].lower() if near else ""


def _features(text: str, start: int, end: int) -> list[int]:
    token = text[start:min(end, start + 200)]
    digits = sum(c.isdigit() for c in token)
    form = re.sub(r"[0-9]+", lambda m: f"9{min(len(m[0]), 20)}", _LETTERS.sub("a", token))[:60]
    number = "".join(_DIGITS.findall(token))
    check = _luhn(number) if 12 <= len(number) <= 19 else ""
    marks = "".join(sorted({c for c in token if not c.isalnum()}))
    return [_slot(x) for x in (
        "bias", "f" + form, "F" + re.sub(r"9\d*", "9", form), f"d{min(digits, 24)}", "m" + marks,
        f"l{min(end - start, 40)}", "s" + token[:2], "@" + str("@" in token),
        "p" + _neighbour(text, start, -1), "n" + _neighbour(text, end, 1), f"u{check}",
    )]


def _keys(token: str) -> list[str]:
    """What makes two tokens the same or similar."""
    plain = _PLAIN_OUT.sub("", token).lower()
    digits = "".join(_DIGITS.findall(token))
    keys = ["=" + plain] if len(plain) >= 4 else []
    if len(digits) >= 7:
        keys.append("#" + digits[-7:])
    if len(name := token.lstrip("<([\"'").partition("@")[0].lower()) >= 4 and not name.isdigit():
        keys.append("@" + name)
    return keys


def add_document(graph: Graph, text: str, base: list[tuple[int, int, int]], anchored: bool = False) -> None:
    """Append the tokens of one document, with links among themselves; if ``anchored``, to observed ones as well."""
    if not base and "@" not in text and not _DIGITS.search(text):
        return
    first, last, at, reach = len(graph.spans), {}, 0, []
    anchor, waiting = {}, {}
    end_before = -1
    for m in _TOKEN.finditer(text):
        start, end, i = m.start(), m.end(), len(graph.spans)
        while at < len(base) and base[at][0] < end:
            reach.append(base[at])
            at += 1
        reach = [s for s in reach if s[2] > start]
        graph.spans.append((start, end))
        graph.features.append(_features(text, start, end))
        graph.labels.append(min(reach)[1] + 1 if reach else 0)
        linked = set()
        if i > first and text[end_before:start].isspace():
            graph.links.append((i - 1, i, 0))
            linked.add(i - 1)
        for key in _keys(m[0]):
            j = last.get(key)
            if j is not None and j not in linked:
                graph.links.append((j, i, 1))
                linked.add(j)
            last[key] = i
            if not anchored:
                continue
            if graph.labels[i]:
                anchor[key] = i
                for j in waiting.pop(key, ()):
                    if j not in linked:
                        graph.links.append((j, i, 1))
                        linked.add(j)
            elif key not in anchor:
                waiting.setdefault(key, []).append(i)
            elif anchor[key] not in linked:
                graph.links.append((anchor[key], i, 1))
                linked.add(anchor[key])
        end_before = end


# --- the field ------------------------------------------------------------------


@dataclass
class Model:
    """``unary``: slots x labels; ``chain``, ``skip``: label before x label after."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, graph: Graph, steps: int = STEPS, observed: bool = True, bounds=(0,)) -> np.ndarray:
        """Tokens x labels, by damped sum-product messages; exact on trees after enough steps.

        ``bounds``: where documents begin; each stops by itself, whatever others are in the graph.
        """
        n = len(graph.spans)
        own = self.unary[np.array(graph.features, np.int64).reshape(n, FEATURES)].sum(1)
        labels = np.array(graph.labels, np.int64)
        if observed:
            seen = np.flatnonzero(labels)
            own[seen, labels[seen]] += _OBSERVED
        links = np.array(graph.links, np.int64).reshape(-1, 3)
        a, b = links[:, 0], links[:, 1]
        table = np.stack([self.chain, self.skip])[links[:, 2]]
        right, left = np.zeros((len(links), LABELS)), np.zeros((len(links), LABELS))
        doc = np.searchsorted(bounds, a, "right")
        on = np.arange(len(links))
        for _ in range(steps):
            if not len(on):
                break
            x, y, to_x, to_y = a[on], b[on], left[on], right[on]
            belief = own.copy()
            np.add.at(belief, y, to_y)
            np.add.at(belief, x, to_x)
            to_right = _log_sum((belief[x] - to_x)[:, :, None] + table[on], 1)
            to_left = _log_sum((belief[y] - to_y)[:, None, :] + table[on], 2)
            right[on] = 0.5 * (to_y + to_right - to_right.max(1, keepdims=True))
            left[on] = 0.5 * (to_x + to_left - to_left.max(1, keepdims=True))
            moved = np.maximum(abs(right[on] - to_y), abs(left[on] - to_x)).max(1) > SETTLED
            unsettled = np.zeros(len(bounds) + 1, bool)
            unsettled[doc[on[moved]]] = True
            on = on[unsettled[doc[on]]]
        np.add.at(own, b, right)
        np.add.at(own, a, left)
        own = np.exp(own - own.max(1, keepdims=True))
        return own / own.sum(1, keepdims=True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def fit_model(features: np.ndarray, labels: np.ndarray, near: np.ndarray, steps: int = 80) -> Model:
    """From tokens with the labels of their neighbours.

    ``near``: counts of the labels before and after in the chain and at the other
    ends of skips, tokens x 3 x labels.
    """
    n = len(labels)
    unary, chain, skip = np.zeros((SLOTS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    if n == 0:
        unary[_slot("bias"), 0] = _OBSERVED
        return Model(unary, chain, skip)
    features = features.copy()
    features[::2, 1:] = 0  # slot 0 is no feature; half of the tokens hide their form
    truth = np.eye(LABELS)[labels]
    flat = features.ravel()
    past = [np.full(p.shape, 1e-4) for p in (unary, chain, skip)]
    for _ in range(steps):
        score = unary[features].sum(1) + near[:, 0] @ chain + near[:, 1] @ chain.T + near[:, 2] @ skip
        score = np.exp(score - score.max(1, keepdims=True))
        off = (score / score.sum(1, keepdims=True) - truth) / n
        each = np.repeat(off, FEATURES, 0)
        du = np.stack([np.bincount(flat, c, SLOTS) for c in each.T], 1) + 1e-6 * unary
        du[0] = 0
        dc = near[:, 0].T @ off + (near[:, 1].T @ off).T + 1e-5 * chain
        ds = near[:, 2].T @ off
        ds = ds + ds.T + 1e-5 * skip
        for p, d, g in zip((unary, chain, skip), (du, dc, ds), past):
            g += d * d
            p -= 0.5 * d / np.sqrt(g)
    return Model(unary, chain, skip)


def _training_rows(graph: Graph):
    """``(features, label, near)`` of every token of a graph."""
    near = np.zeros((len(graph.spans), 3, LABELS), np.int32)
    for i, j, kind in graph.links:
        near[j, 2 * kind, graph.labels[i]] += 1
        near[i, 1 + kind, graph.labels[j]] += 1
    return zip(graph.features, graph.labels, near.reshape(len(near), 3 * LABELS))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Model:
    """Learn from the base spans of a bounded sample of ``docs``; rows with a NULL id are passed over."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def run(batches):
        for b in batches:
            rows = []
            for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                graph = Graph()
                add_document(graph, text or "", base_spans(text or ""))
                for n, (f, label, near) in enumerate(_training_rows(graph)):
                    rows.append((zlib.crc32(f"{h}:{n}".encode()), label, [*f, *near.tolist()]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["h", "label", "x"])

    rows = (
        docs.join(F.broadcast(chosen), "doc_id")  # at most `sample_docs` ids
        .select(F.xxhash64("doc_id", "text").alias("h"), "text")
        .mapInArrow(run, "h long, label int, x array<int>").orderBy("h", "label", "x").limit(sample_tokens).collect()
    )
    x = np.array([r["x"] for r in rows], np.int64).reshape(len(rows), FEATURES + 3 * LABELS)
    labels = np.array([r["label"] for r in rows], np.int64)
    return fit_model(x[:, :FEATURES], labels, x[:, FEATURES:].reshape(-1, 3, LABELS).astype(float))


# --- finding --------------------------------------------------------------------


def spans_of(texts: list[str | None], model: Model) -> list[list[tuple[int, int, int, bool]]]:
    """``(start, kind number, end, base)`` for every text, sorted."""
    graph, bounds, bases = Graph(), [0], []
    for text in texts:
        bases.append(base_spans(text) if text else [])
        add_document(graph, text or "", bases[-1], anchored=True)
        bounds.append(len(graph.spans))
    chained = {j for _, j, kind in graph.links if kind == 0}
    sure = model.marginals(graph, bounds=bounds) if graph.spans else np.zeros((0, LABELS))
    out = []
    for d, text in enumerate(texts):
        found, open_ = [(s, k, e, True) for s, k, e in bases[d]], None
        for i in range(bounds[d], bounds[d + 1]):
            label = int(sure[i].argmax())
            if graph.labels[i] or not label or sure[i, label] < SURE:
                open_ = None
                continue
            start, end = graph.spans[i]
            token = text[start:end]
            cut = start + _LEAD.match(token).end()
            end -= len(token) - len(token.rstrip(" .,;:!?\"'<>[]{}"))
            if cut >= end:
                open_ = None
                continue
            if open_ is not None and found[open_][1] == label - 1 and i in chained and label >= 3:
                found[open_] = (found[open_][0], label - 1, end, False)
            else:
                open_ = len(found)
                found.append((cut, label - 1, end, False))
        out.append(sorted(found))
    return out


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, spans)``: one row per document, spans sorted by start and kind.

    A span is ``(start, kind, end, base)``; ``base`` tells patterns from the field.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches):
        for b in batches:
            spans = [[dict(start=s, kind=KINDS[k], end=e, base=base) for s, k, e, base in found]
                     for found in spans_of(b.column(1).to_pylist(), shared.value)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    kind = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()),
        T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("spans", kind)])
    return docs.select("doc_id", "text").mapInArrow(run, out)
