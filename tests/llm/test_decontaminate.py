import random
import re

from gradmill.llm import decontaminate

DOCS = "doc_id long, text string, row int, bits string, w int, item_id long"
ITEMS = "item_id long, text string, doc_id long, hash int"


def words(text):
    out = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", out)


def slow(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for d, text in docs:
        w, hit, met = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    met |= found
        ids = sorted(str(m) for m in met if m is not None)
        out.append((str(d), len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def fast(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "b", 2, 3) for r in docs], DOCS)
    i = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)
    got = decontaminate.verdicts(d, i).collect()
    kept = decontaminate.decontaminated(d, i)
    assert kept.columns == d.columns
    bad = sorted(str(r.doc_id) for r in got if r.contaminated)
    assert sorted([str(r.doc_id) for r in kept.collect()] + bad) == sorted(str(r[0]) for r in docs)
    return sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in got)


def test_random_texts_with_shared_spans(spark):
    rng = random.Random(5)
    some = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(some, k=rng.choice([1, 2, 5, 8, 9, 12, 13, 14, 30, 60])))) for i in range(40)]
    items += [(100, items[3][1]), (3, items[3][1]), (101, "same " * 20), (102, "Same, same"), (7, "other words")]
    docs = []
    for d in range(120):
        w = rng.choices(some[:30], k=rng.randrange(0, 80))
        for _ in range(rng.randrange(3)):
            item = words(rng.choice(items)[1])
            a = rng.randrange(len(item))
            at = rng.randrange(len(w) + 1)
            w[at:at] = item[a:a + rng.choice([5, 12, 13, 14, 25])]
        docs.append((d, " ".join(x.upper() if rng.random() < 0.2 else x for x in w)))
    docs += [(500, "same " * 400), (501, "x same same y")]
    assert fast(spark, docs, items) == slow(docs, items)


def test_every_span_of_thirteen_is_found(spark):
    """Whatever the offsets, the kept run is the same in both texts."""
    base = [f"t{i * i % 101}x{i}" for i in range(40)]
    items = [(1, " ".join(base))]
    docs = [(k, " ".join(["pre"] * k + base[k:k + 13] + ["post"] * 3)) for k in range(28)]
    docs += [(100 + k, " ".join(["pre"] * k + base[k:k + 12] + ["post"] * 3)) for k in range(28)]
    got = fast(spark, docs, items)
    assert got == slow(docs, items)
    assert sum(r[2] == 13 for r in got) == 28 and sum(r[2] == 0 for r in got) == 28


def test_edge_cases(spark):
    long = " ".join(f"v{i}" for i in range(30))
    items = [(None, long), (2, None), (3, ""), (4, " ., "), (5, "É x"), (6, "é x")]
    docs = [(None, long), (1, None), (2, ""), (3, long), (3, long), (3, "clean"), (4, "É-X"), (5, "é x y " + "z " * 80)]
    assert fast(spark, docs, items) == slow(docs, items)
    assert fast(spark, docs, []) == slow(docs, [])
    assert fast(spark, [], items) == []


def test_very_long_document(spark):
    base = [f"u{i}" for i in range(20)]
    text = " ".join(f"n{i}" for i in range(150_000)) + " " + " ".join(base) + " tail"
    got = fast(spark, [(1, text)], [(9, " ".join(base))])
    assert got == [("1", 150_021, 20, ["9"], False)]
