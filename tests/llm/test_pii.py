import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from gradmill.llm import pii, queries


def plain_base(text):
    """The contract's patterns, as they are written."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        double = [x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))]
        if 12 <= len(d) <= 19 and sum(double) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.mark.parametrize("text", [
    "", "a@b.c", "a@b", "@b.c", "a@b.c@d.e.f", "x.y+z%1@a-b.c..d", "é@é.com a@é.b", "a@b.c-", "..@..", "a@@b.c",
    "1.2.3.4.5.6.7.8", "001.002.003.0255", "256.1.1.1 1.1.1.256", "1.1.1", "0000000001.2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "5500005555555559x4111111111111111",
    "+1 (972) 555-5545", "+1+1 972 555 5545 x", "+12", "+1 ((((", "+1-234.567(890)12 345 678", "٣.٣.٣.٣ +١",
])
def test_base_spans(text):
    assert pii.base_spans(text) == plain_base(text)


def test_base_spans_of_random_text():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices("0123459@.ab-+ ()%_é", weights=[4] * 7 + [2] * 12, k=rng.randrange(60)))
        assert pii.base_spans(text) == plain_base(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "x" * 300_000 + "1",
                 "1 " * 150_000, "+1" + "(" * 300_000, "a.b@" * 70_000):
        graph = pii.Graph()
        pii.add_document(graph, text, pii.base_spans(text))


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(1)
    graph = pii.Graph([(0, 1)] * 5, rng.integers(1, pii.SLOTS, (5, pii.FEATURES)).tolist(), [0, 2, 0, 0, 0],
                      [(0, 1, 0), (1, 2, 0), (0, 3, 1), (2, 4, 1)])
    skip = rng.normal(size=(pii.LABELS,) * 2)
    model = pii.Model(rng.normal(size=(pii.SLOTS, pii.LABELS)), rng.normal(size=(pii.LABELS,) * 2), skip + skip.T)
    own = model.unary[np.array(graph.features)].sum(1)
    own[1, 2] += pii._OBSERVED
    want = np.zeros((5, pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=5):
        e = sum(own[i, y[i]] for i in range(5))
        e += sum((model.chain, model.skip)[k][y[i], y[j]] for i, j, k in graph.links)
        for i in range(5):
            want[i, y[i]] += np.exp(e - _top(own))
    want /= want.sum(1, keepdims=True)
    assert np.allclose(model.marginals(graph, steps=60), want, atol=1e-6)


def _top(own):
    return own.max(1).sum()


def test_labels_spread_over_skips():
    graph = pii.Graph()
    text = "call +1 (972) 555-5545 or later 972-5555545 and 4711"
    pii.add_document(graph, text, pii.base_spans(text))
    words = [text[s:e] for s, e in graph.spans]
    assert words == ["+1", "(972)", "555-5545", "972-5555545", "4711"] and graph.labels == [4, 4, 4, 0, 0]
    assert (2, 3, 1) in graph.links
    model = pii.Model(np.zeros((pii.SLOTS, 5)), np.eye(5), 4 * np.eye(5))
    assert model.marginals(graph)[3].argmax() == 4 and model.marginals(graph)[4].max() < 0.5
    found = pii.spans_of([text], model)[0]
    assert [f for f in found if not f[3]] == [(text.index("972-5"), 3, text.index(" and"), False)]


@pytest.mark.parametrize("place", [0, 25, 50])
def test_fifty_repeats_are_all_found(place):
    model = pii.Model(np.zeros((pii.SLOTS, 5)), np.eye(5), 4 * np.eye(5))
    parts = [f"then word{'s' * (k % 3)} 972-5555545 end" for k in range(50)]
    parts.insert(place, "call +1 (972) 555-5545 now")
    text = " ".join(parts)
    want = [m.start() for m in re.finditer("972-5555545", text)]
    found = [s for s, k, _, base in pii.spans_of([text], model)[0] if k == 3 and not base]
    assert found == want
    # each document by itself: the same in a batch with others
    batch = pii.spans_of(["none here", text, "x 4711 y 4711", text], model)
    assert batch[1] == batch[3] == pii.spans_of([text], model)[0]


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1_pii(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        listed = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[1] == k for b in base) for k in range(4)]
        assert set(listed) <= set(filter(None, r.spans.split(",")))


def test_edge_cases(spark):
    schema = "doc_id long, text string, spans string, base int"
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "a@b.c", "x", 1), (3, "a@b.c", "x", 1), (3, "a@b.c", "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    got = pii.find(docs, pii.fit(docs)).collect()
    assert sorted((str(r.doc_id), len(r.spans)) for r in got) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 1)]
    assert pii.find(docs.limit(0), pii.fit(docs.limit(0))).count() == 0
