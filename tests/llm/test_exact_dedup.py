import hashlib
import random
import re

import pytest

from gradmill.llm import exact_dedup

SCHEMA = "doc_id long, text string, size int, prefix string, number long, row string, text_sha256 string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "p", 2, "r", "s") for i, t in rows], SCHEMA)


def plain(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append(i)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda x: (x is None, x or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, digest) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def got(spark, rows, **kw):
    return sorted((tuple(r) for r in exact_dedup.exact_duplicates(table(spark, rows), digests=True, **kw).collect()), key=str)


@pytest.mark.parametrize("head", [1, 64])
def test_against_brute_force(spark, head):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = [rng.choice(["a", "bb", "é", "本"]) for _ in range(rng.randrange(4))]
        rows.append((i, rng.choice([" ", "\n", " \t\r", "\x0b"]).join(words)))
    assert got(spark, rows, head=head) == expected(rows)


def test_odd_rows(spark):
    long = "word " * 40_000
    rows = [(5, None), (3, ""), (8, " "), (9, "\n\n"), (7, "x"), (7, "x"), (7, "x"), (None, "x"), (None, "y"), (None, "y"),
            (1, long + "a"), (2, long + "b"), (4, long.replace(" ", "\n\t") + "a"), (11, " "), (12, " "), (13, "ab"), (14, "ba")]
    assert got(spark, rows) == expected(rows)
    assert got(spark, []) == []


def test_same_length_and_prefix_but_not_equal(spark):
    rows = [(i, "p" * 100 + str(i % 7)) for i in range(70)]
    assert got(spark, rows) == expected(rows)


def test_rows_that_stay_are_as_they_were(spark):
    rows = [(2, "a  b"), (1, "a\nb"), (3, "c\t\td"), (4, None), (4, None)]
    out = exact_dedup.without_copies(table(spark, rows))
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted((r.doc_id, r.text, r.row) for r in out.collect()) == [(1, "a\nb", "r"), (3, "c\t\td", "r"), (4, None, "r")]


def test_only_shared_shapes_are_left_open(spark):
    docs = table(spark, [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cccc"), (5, "d e"), (6, "d  e")])
    assert exact_dedup.open_shapes(docs).count() == 2
    hashed = {r.doc_id for r in exact_dedup.exact_duplicates(docs).collect() if r.text_sha256}
    assert hashed == {1, 3, 5, 6}


def test_built_in_functions_only(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
