"""Vector search, URL filter, token counts, toxicity."""

import collections
import math
import random
import zlib
from urllib.parse import urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradmill.llm import queries, token_counts, toxicity, url_filter, vector_search


# --- vector search --------------------------------------------------------------


def slow_top(rows, is_query, k):
    good = [(i, [int(np.floor(np.float64(v) * 1024)) for v in x]) for i, x in rows
            if i is not None and x is not None and all(v is not None and np.isfinite(v) for v in x)]
    asking = {}
    for q, x in sorted((q, x) for q, x in good if is_query(q)):
        asking.setdefault(q, x)
    out = set()
    for q, x in asking.items():
        s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(y) == len(x))
        out |= {(q, n + 1, i, -v) for n, (v, i) in enumerate(s[:k])}
    return out


def top(spark, rows, k=10, **kw):
    v = spark.createDataFrame([(i, x, 5, "a") for i, x in rows], "vec_id long, embedding array<double>, x int, ids string")
    got = vector_search.top_k(vector_search.usable(v), F.col("vec_id") % 10 == 0, k, **kw).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


@pytest.mark.parametrize("block,query_block", [(4096, 1024), (37, 5)])
def test_top_k(spark, block, query_block):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.05 * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(2000 + i, [0.0] * 8) for i in range(30)]
    assert top(spark, rows, block=block, query_block=query_block) == slow_top(rows, lambda q: q % 10 == 0, 10)


@pytest.mark.parametrize("block", [4096, 8])
def test_repeated_vectors(spark, block):
    same = [0.5, -0.25]
    rows = [(10, same)] * 13 + [(i, same) for i in range(11, 20)] + [(20, same)] * 2 + [(3, [0.1, 0.1])] * 30 + [(30, [1.0, 0.0]), (30, [0.0, 1.0])]
    rows += [(41, [2.0, 2.0])] * 25
    want = slow_top(rows, lambda q: q % 10 == 0, 10)
    assert {r[1] for r in want if r[0] == 10} == set(range(1, 11))
    assert top(spark, rows, block=block) == want


def test_vector_edge_cases(spark):
    rows = [(10, [1.0, 2.0]), (20, [1.0, 2.0]), (3, [float("nan"), 1.0]), (4, None), (None, [1.0, 1.0]), (5, [None, 1.0]),
            (6, [float("inf"), 0.0]), (7, [1.0]), (30, [1.0]), (8, [1e12, -1e3]), (9, [-0.0001, 0.5]), (40, []), (41, [])]
    assert top(spark, rows) == slow_top(rows, lambda q: q % 10 == 0, 10)
    assert top(spark, []) == set()


def test_trees_prune_and_stay_exact():
    rng = np.random.default_rng(5)
    centres = 50_000 * rng.normal(size=(40, 4))
    points = np.floor(np.repeat(centres, 200, 0) + 10 * rng.normal(size=(8000, 4)))
    q = np.floor(centres[:20] + rng.normal(size=(20, 4)))
    row, found, score = vector_search.search(q, np.arange(-20, 0), points, np.arange(8000), 10)
    exact = q @ points.T
    for n in range(20):
        order = np.lexsort((np.arange(8000), -exact[n]))[:10]
        assert found[row == n].tolist() == order.tolist() and score[row == n].tolist() == exact[n][order].tolist()


# --- URL filter -----------------------------------------------------------------


def slow_rule(host, path):
    best = None
    for name, start, what in url_filter.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            if best is None or len(name + start) > len(best[0]):
                best = (name + start, what)
    return best or (None, None)


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:n], rest[n:]
    n = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path[:n]


URLS = [
    None, "", "no scheme", "http://", "https://Example.NET/en/1?x#y", "http://a.example.net/de/", "ftp://x.net", "x://net/",
    "http://net?q=/en/", "http://www.example.com/de/z", "http://example.org/fr/ü", "http://org#/fr/", "http://É.org/fr/",
    "http://badnet/", "http://a://b/c", "http://exampleXnet/en/", "http://a.org/fr", "http://h\0x.com/\0",
]


def test_urls(spark, sf_dir):
    given = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    rows = [(i, u, "h", "s") for i, u in enumerate(URLS + given)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, score string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(got) == len(rows)
    for i, u, *_ in rows:
        host, path = slow_parts(u)
        rule, what = slow_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == what if what else got[i].verdict in ("allow", "block")
    assert {g.verdict for g in got.values() if g.rule is None} == {"allow", "block"}
    assert urlsplit(given[0]).path == got[len(URLS)].path


def test_url_scores_separate_the_sorts(spark):
    good = [f"http://a{i}.org/fr/garden/{i * 7}" for i in range(200)]
    bad = [f"http://b{i}.net/casino-{i * 7}" for i in range(200)]
    new = ["http://c.com/fr/garden/55", "http://d.com/casino-991"]
    pages = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(pages.repartition(3)).collect()}
    assert (got[400].verdict, got[401].verdict) == ("allow", "block")
    assert all(got[i].score > got[401].score for i in range(200))
    again = {r.page_id: r for r in url_filter.judge(pages.repartition(1)).collect()}
    assert all(abs(got[i].score - again[i].score) < 1e-12 and got[i].verdict == again[i].verdict for i in got)


def slow_url_scores(urls):
    """Scores and verdicts by a plain Markov model with dictionaries."""
    parts = [slow_parts(u) for u in urls]
    texts = [(h + p).encode().replace(b"\0", b"\2") for h, p in parts]
    rules = [slow_rule(*x)[1] for x in parts]
    held = [zlib.crc32(h.encode()) % url_filter.HELD_OUT == 0 for h, _ in parts]
    counts = {"allow": collections.Counter(), "block": collections.Counter()}
    for t, what, out in zip(texts, rules, held):
        raw = b"\0" * 5 + t + b"\1"
        for i in range(5, len(raw) if what and not out else 0):
            for order in range(6):
                counts[what][order, raw[i - order:i], raw[i]] += 1
                counts[what][order, raw[i - order:i]] += 1

    def chance(seen, raw, i):
        p = 1 / 256
        for order in range(6):
            n = seen[order, raw[i - order:i]]
            p = (seen[order, raw[i - order:i], raw[i]] + (math.sqrt(n) + 1) * p) / (n + math.sqrt(n) + 1)
        return p

    scores = []
    for t in texts:
        raw = b"\0" * 5 + t + b"\1"
        ratio = sum(math.log(chance(counts["allow"], raw, i) / chance(counts["block"], raw, i)) for i in range(5, len(raw)))
        scores.append(ratio / (len(t) + 1) if t else 0.0)
    judged = [(s, w) for s, w, out in zip(scores, rules, held) if w and out]
    n = {w: sum(x == w for _, x in judged) for w in ("allow", "block")}
    edges = [-8 + k / 256 for k in range(4097)]
    cost = [sum((w == "allow") / n[w] if s < e else (w == "block") / n[w] for s, w in judged) for e in edges]
    best = [e for e, c in zip(edges, cost) if c <= min(cost) + 1e-9]
    limit = (best[0] + best[-1]) / 2
    return scores, [w or ("allow" if s >= limit else "block") for s, w in zip(scores, rules)]


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_url_scores_by_brute_force(spark, sf_dir, parts, monkeypatch):
    given = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    mixed = [f"http://{'abcde'[i % 5]}{i % 13}.{'org/fr' if i % 3 else 'net'}/{'garden' if i % 3 else 'casino'}-{i * 7}" for i in range(300)]
    urls = URLS + given + mixed + mixed[:40] + ["http://long.com/" + "xy" * 30_000]
    scores, verdicts = slow_url_scores(urls)
    monkeypatch.setattr(url_filter, "BLOCK_BYTES", 3000)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(parts)
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(got) == len(urls)
    assert max(abs(got[i].score - s) for i, s in enumerate(scores)) < 1e-9
    assert [got[i].verdict for i in range(len(urls))] == verdicts


def test_urls_without_both_sorts(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (None, "http://b.net/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages).collect()}
    assert got == {1: "allow", None: "block"}
    assert url_filter.judge(pages.limit(0)).count() == 0


# --- token counts ---------------------------------------------------------------


def slow_pieces(word, starts, parts):
    n, at, pool = 0, 0, starts
    while at < len(word):
        size = max((k for k in range(1, len(word) - at + 1) if word[at:at + k] in pool), default=0)
        if not size:
            return 0
        n, at, pool = n + 1, at + size, parts
    return n


def test_automaton_against_longest_match():
    rng = random.Random(6)
    for _ in range(300):
        letters = rng.choice(["ab", "abc", "aé🙂"])
        some = {"".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(12)}
        starts, parts = set(rng.sample(sorted(some), len(some) // 2)), set(rng.sample(sorted(some), len(some) // 2))
        automaton = token_counts.Automaton(starts, parts)
        for _ in range(40):
            word = "".join(rng.choices(letters, k=rng.randint(1, 14)))
            assert automaton.pieces(word) == slow_pieces(word, starts, parts), (word, starts, parts)


def cut(word, vocabulary):
    """Greedy cut of a word with its mark, by the vocabulary as it is; 0 if there is none."""
    n, at, word = 0, 0, "▁" + word
    while at < len(word):
        size = max((k for k in range(1, len(word) - at + 1) if word[at:at + k] in vocabulary), default=0)
        if not size:
            return 0
        n, at = n + 1, at + size
    return n


def test_words_that_begin_with_the_bare_mark(spark, sf_dir):
    vocabulary = queries.word_vocabulary()
    automaton = token_counts.Automaton(*token_counts.word_pieces(vocabulary))
    words = "2024 4111-1111-1111-1111 7 garden x1 ça ßt ñandú Ωμέγα αβγ 中文维基百科 كتاب 🙂🙂 ç Übung".split()
    words += sorted({w for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() for w in (r.text or "").split()})
    known = set(vocabulary)
    for w in words:
        assert automaton.pieces(w) == cut(w, known), w
    assert automaton.pieces("2024") == 5 and automaton.pieces("") == 0


def test_bare_mark_against_longest_match():
    rng = random.Random(16)
    for _ in range(300):
        some = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(12)}
        starts, parts = set(rng.sample(sorted(some), 4)), set(rng.sample(sorted(some), 7))
        automaton = token_counts.Automaton([*starts, ""], parts)
        vocabulary = {"▁" + p for p in starts} | {"▁"} | parts
        for _ in range(40):
            word = "".join(rng.choices("abc", k=rng.randint(1, 14)))
            assert automaton.pieces(word) == cut(word, vocabulary), (word, starts, parts)


def test_token_counts(spark):
    starts, parts = ["a", "ab", "x" * 50], ["b", "ab", "bb", "é"]
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "ab abbab é q", 1), (3, "a" + "b" * 100_001, 1), (None, " a\u00a0b\t\n", 1)],
        "doc_id long, text string, n_words int")
    got = sorted((str(r.doc_id), r.n_words, r.n_tokens, r.n_unknown)
                 for r in token_counts.count(docs, token_counts.Automaton(starts, parts)).collect())
    assert got == sorted([("1", 0, 0, 0), ("2", 0, 0, 0), ("3", 4, 6, 2), ("3", 1, 50_001, 0), ("None", 2, 2, 1)])
    assert token_counts.count(docs.limit(0), token_counts.Automaton([], [])).count() == 0


# --- toxicity -------------------------------------------------------------------


def test_held_out_accuracy(spark):
    from gradmill.llm import queries

    sf_dir = "/root/testdata/sf0.1"
    got = queries.op9_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    test = got[got.held_out]
    hit, said = test.toxic == 1, test.predicted == 1
    assert (hit & said).sum() / hit.sum() > 0.4 and (~hit & said).sum() / (~hit).sum() < 0.01


def test_pairs_are_learned():
    """Label 1 only where both terms stand together, which no sum of weights tells."""
    rng = random.Random(8)
    texts, labels = [], []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        fill = " ".join(rng.choices(["uno", "due", "tre", "quattro", "sei"], k=6))
        texts.append(" ".join(filter(None, [fill, "zig" * a, "zag" * b])))
        labels.append(float(a == b))
    model = toxicity.fit_model([toxicity.terms(t) for t in texts], np.array(labels))
    right = (model.scores(texts) >= 0.5) == (np.array(labels) > 0)
    assert right.mean() > 0.95


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (None, "fine words", 1), (3, "bad", 1), (3, "bad", 1), (4, "x " * 300_000, 1)],
        "doc_id long, text string, score int")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (99, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        model = toxicity.fit(docs, labels)
        assert toxicity.score(docs, model).count() == 6
        kept = toxicity.accepted(docs, model)
        assert kept.columns == docs.columns and kept.count() <= 6
        assert toxicity.score(docs.limit(0), model).count() == 0


def test_pair_sum_is_that_of_all_pairs():
    rng = np.random.default_rng(4)
    size = 1 << toxicity.BITS
    model = toxicity.Model(-0.3, rng.normal(size=size).astype(np.float32), rng.normal(size=(size, toxicity.FACTORS)).astype(np.float32))
    texts = ["you awful foreigners", "", None, "one", "the same the same word", " ".join(f"word{chr(97 + i)}" for i in range(20))]
    for text, score in zip(texts, model.scores(texts)):
        slots = toxicity.terms(text).tolist()
        margin = model.bias + sum(float(model.weights[s]) for s in slots)
        for n, a in enumerate(slots):
            for b in slots[n + 1:]:
                margin += sum(float(x) * float(y) for x, y in zip(model.vectors[a], model.vectors[b]))
        assert abs(score - 1 / (1 + np.exp(-np.clip(margin, -40, 40)))) < 1e-6
