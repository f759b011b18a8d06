import random
import re
from collections import Counter

import numpy as np
import pytest

from gradmill.llm import collocations

SCHEMA = "text string, lang string, words int, n string, h int, doc_id long"


def table(spark, rows):
    return spark.createDataFrame([(t, g, 1, "x", 2, 3) for t, g in rows], SCHEMA)


def pieces(rows):
    for t, g in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        for p in re.split(r"[.,;:!?\x0a-\x0d]", low):
            yield "und" if g is None else g, re.findall(r"[^\x20\x09]+", p)


def slow(rows, least, longest=5, top=2000):
    f, n = Counter(), Counter()
    for g, w in pieces(rows):
        n[g] += len(w)
        for k in range(1, longest + 1):
            for i in range(len(w) - k + 1):
                f[g, tuple(w[i:i + k])] += 1
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = {}
    for (g, p), a in cand.items():
        if any(h == g and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               for (h, q), b in cand.items()):
            continue
        score, k = min((1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(g, []).append((-score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
    return sorted((g, r + 1, p.decode(), -a, left, right, n[g], -s)
                  for g, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def got(spark, rows, least, parts=1, **kw):
    return sorted(tuple(r) for r in collocations.mine(table(spark, rows).repartition(parts), least, **kw).collect())


def corpus(seed, docs=200):
    rng = random.Random(seed)
    words = ["a", "b", "B", "çé", "É", "\x01", "a\x02", "the", "of", "zz", "本", "-"]
    gaps = [" ", "  ", "\t", ", ", ".", "\n", " \x0b"]
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(words) + rng.choices(gaps, [20, 2, 2, 2, 1, 1, 1])[0] for _ in range(rng.randrange(40)))
        if rng.random() < 0.3:
            text += " in the middle of nowhere special "
        rows.append((text, rng.choice(["en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("least,parts", [(3, 1), (20, 7)])
def test_against_brute_force(spark, least, parts):
    rows = corpus(least)
    assert got(spark, rows, least, parts) == slow(rows, least)


def test_ranges_that_cut_through_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_ROWS", 40)  # a range per 40 suffixes: most phrases reach over several
    monkeypatch.setattr(collocations, "PART", 2000)
    rows = corpus(5)
    assert got(spark, rows, 10, 3) == slow(rows, 10)


def test_suffixes_are_cut_before_rare_threes(spark, monkeypatch):
    """Frequent pairs in no frequent phrase of three words: a row per pair and task, not one per word of the texts."""
    rng, written = random.Random(3), {}

    def kept(df, purpose):
        written[purpose] = real(df, purpose)
        return written[purpose]

    real = collocations.kept
    monkeypatch.setattr(collocations, "kept", kept)
    names = [f"w{n}" for n in range(20)]
    rows = [(" ".join(rng.choices(names, k=200)) + " . in fact of the matter", "en") for _ in range(200)]
    assert got(spark, rows, 60, 2) == slow(rows, 60)
    # two tasks; besides the pairs of random words the suffixes of the one phrase
    assert written["phrase-suffixes"].count() <= 2 * (20 * 20 + 4)
    assert written["phrase-suffixes"].agg({"n": "sum"}).first()[0] > 30_000


def test_one_hot_phrase(spark):
    rows = [("hot words come again and again. " * 50, "en")] * 40 + corpus(2, 50)
    assert got(spark, rows, 30) == slow(rows, 30)


def test_the_report_ends_at_the_top(spark):
    rows = corpus(7)
    assert got(spark, rows, 5, top=3) == slow(rows, 5, top=3)


def test_odd_rows(spark):
    rows = [(None, "en"), ("", "en"), ("...", None), ("one", "en"), ("x y", None), ("x y", "und"), ("X\tY", "und"), ("x,y", "und"),
            ("x   y", "und"), ("x y " * 30_000, "long")]
    assert got(spark, rows, 3) == slow(rows, 3)
    assert got(spark, [], 3) == []
    assert got(spark, [("a b", "en"), ("b c", "en")], 2) == []


def test_words_of_a_sliced_batch(spark):
    import pyarrow as pa
    texts = pa.array(["skip me", "Ab cd.ef", "", "gh", None, ", x\ty"]).slice(1)
    w = collocations.Words(texts, pa.array(["q", "en", "fr", None, "en", "fr"]).slice(1))
    assert [w.names[int(c)].as_py() for c in w.code] == ["ab", "cd", "ef", "gh", "x", "y"]
    assert w.goes_on.tolist() == [False, True, False, False, False, True]
    assert [w.langs[int(c)].as_py() for c in w.lang] == ["en", "en", "en", "und", "fr", "fr"]


def test_partitions_below_the_threshold_are_left(monkeypatch):
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 4, (3000, 4))
    rows[rng.random(3000) < 0.2, 3] = -1
    weight = rng.integers(1, 4, 3000)
    for least in (1, 50, 400):
        want = Counter()
        for r, n in zip(rows.tolist(), weight.tolist()):
            for d in range(1, 5):
                if r[d - 1] >= 0:
                    want[tuple(r[:d])] += n
        found = {tuple(rows[i, :d].tolist()): n for i, d, n in collocations.frequent_prefixes(rows, weight, least)}
        assert found == {k: n for k, n in want.items() if n >= least}


def test_products_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 10**15), ("en", "b", 10**15)], "lang string, word string, n long")
    phrases = spark.createDataFrame([("en", ["a"], 10**15), ("en", ["b"], 10**15), ("en", ["a", "b"], 10**14 + 7)], "lang string, words array<string>, n long")
    (r,) = collocations.scored(words, phrases).collect()
    assert r.score == 1000 * (10**14 + 7) * 2 * 10**15 // 10**30


def test_shorter_phrases_only(spark):
    rows = corpus(9)
    assert got(spark, rows, 5, longest=2) == slow(rows, 5, longest=2)
    assert got(spark, rows, 5, longest=3) == slow(rows, 5, longest=3)


def test_a_task_writes_a_suffix_once(monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace
    every = SimpleNamespace(value=np.full(4, 2**64 - 1, np.uint64))  # bitmaps that hold all words and pairs
    texts = ["one two three four", "two three. one two"] * 30
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en", "fr"] * 30)], ["text", "lang"])
    monkeypatch.setattr(collocations, "PART", 40)  # many parts
    want = Counter()
    for g, w in pieces(zip(texts, ["en", "fr"] * 30)):
        want.update((g, tuple(w[i:i + 5])) for i in range(len(w) - 1))
    for held, once in ((1 << 19, True), (3, False)):
        monkeypatch.setattr(collocations, "HELD_ROWS", held)
        rows = [(r["lang"], tuple(r["words"]), r["n"]) for b in collocations._suffixes(every, every, 5)([batch, batch]) for r in b.to_pylist()]
        found = Counter()
        for g, w, n in rows:
            found[g, w] += n
        assert found == {k: 2 * n for k, n in want.items()} and (len(rows) == len(want)) == once


def test_pairs_that_do_not_go_on_are_one_row_for_all_tasks(spark, monkeypatch):
    rng, written = random.Random(4), {}

    def kept(df, purpose):
        written[purpose] = real(df, purpose)
        return written[purpose]

    real = collocations.kept
    monkeypatch.setattr(collocations, "kept", kept)
    names = [f"w{n}" for n in range(20)]
    rows = [(" ".join(rng.choices(names, k=200)) + " . in fact of the matter", g) for _ in range(200) for g in ("en", "fr")]
    assert got(spark, rows, 60, 8) == slow(rows, 60)
    sizes = [len(r["words"]) for r in written["phrase-suffixes"].collect()]
    assert sizes.count(2) <= 2 * (20 * 20 + 4)  # once per language, in eight tasks
    assert len(sizes) - sizes.count(2) <= 8 * 2 * 4


@pytest.mark.parametrize("least,parts", [(3, 1), (20, 7)])
def test_pairs_are_counted_by_their_words_if_two_words_share_a_hash(spark, monkeypatch, least, parts):
    import pyarrow as pa
    real, real_kept, written = collocations._counted_words, collocations.kept, {}

    def counted(batches):
        for b in real(batches):
            yield b
            yield pa.RecordBatch.from_arrays([pa.array(["none"] * b.num_rows), *b.columns[1:]], b.schema.names)

    def kept(df, purpose):
        written[purpose] = real_kept(df, purpose)
        return written[purpose]

    monkeypatch.setattr(collocations, "_counted_words", counted)
    monkeypatch.setattr(collocations, "kept", kept)
    rows = corpus(least)
    assert got(spark, rows, least, parts) == slow(rows, least)
    assert "phrase-long-suffixes" not in written


def test_pairs_are_summed_within_a_task(monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace
    every = SimpleNamespace(value=np.full(4, 2**64 - 1, np.uint64))
    texts = ["one two three one two", "two three. one two"] * 30
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en", "fr"] * 30)], ["text", "lang"])
    monkeypatch.setattr(collocations, "PART", 40)  # many parts
    want = Counter()
    for g, w in pieces(zip(texts, ["en", "fr"] * 30)):
        want.update((g, *w[i:i + 2]) for i in range(len(w) - 1))
    for held, once in ((1 << 20, True), (2, False)):
        monkeypatch.setattr(collocations, "HELD_HASHES", held)
        rows = [tuple(r.values()) for b in collocations._counted_pairs(every)([batch, batch]) for r in b.to_pylist()]
        found = Counter()
        for first, second, n in rows:
            found[first, second] += n
        assert sorted(found.values()) == sorted(2 * n for n in want.values()) and (len(rows) == len(want)) == once


def test_tasks_read_several_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = lambda n: collocations._in_larger_tasks(spark.range(1000, numPartitions=n)).rdd.getNumPartitions()
    assert parts(3) == min(3, cores) and parts(4 * cores) == cores
    assert parts(8 * cores) == parts(7 * cores) == 2 * cores
    assert collocations._in_larger_tasks(spark.range(1000, numPartitions=9 * cores)).count() == 1000
