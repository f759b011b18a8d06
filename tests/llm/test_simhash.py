import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gradmill.llm import simhash


def slow_fingerprint(text, n=3):
    words, cur = [], ""
    for ch in (text or "") + " ":
        if ch in " \t\n\v\f\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
    if not words:
        return 0
    m = max(1, len(words) - n + 1)
    hashes = [xxhash.xxh64(" ".join(words[i:i + n]).encode(), 42).intdigest() for i in range(m)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """``{row number: smallest doc_id}`` of rows ``(doc_id, fingerprint)``."""
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                at[find(i)] = find(j)
    out = {}
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out[i] = min(ids, default=None)
    return out


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "One", "one TWO", "a b c", "A b  c\vd \x1c e É é   x y", "x " * 50,
])
def test_fingerprint(text):
    got = simhash.fingerprint(None if text is None else text.encode())
    assert got & (1 << 64) - 1 == slow_fingerprint(text)


def test_fingerprint_of_long_text():
    text = " ".join(f"w{i * i % 977}" for i in range(70_000))
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == slow_fingerprint(text)


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = [(i, slow_fingerprint(t)) for i, t in texts.items()]
    want = {rows[k][0]: c for k, c in slow_components(rows).items()}
    got = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex(F.col("fp")).alias("h"), "component_id")
    got = {r.doc_id: (r.h, r.component_id) for r in got.collect()}
    assert got == {i: (f"{f:016x}", want[i]) for i, f in rows}


@pytest.mark.parametrize("bucket", [4, 300])
def test_components_of_dense_fingerprints(spark, bucket):
    """Clusters so dense that every round deals them anew, and slices remain."""
    rng, rows = np.random.default_rng(3), []
    for centre in [0, 0x0123456789ABCDEF, 0xFFFF000000000000, 0xFFFF0000000000FF]:
        for _ in range(60):
            fp = centre
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                fp ^= 1 << int(b)
            rows.append((len(rows) * 7 % 1001, fp))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in rows]
    got = simhash.components(spark.createDataFrame(signed, "doc_id long, fp long"), bucket=bucket)
    got = {r.fp & (1 << 64) - 1: r.component_id for r in got.collect()}
    want = slow_components(rows)
    assert got == {rows[k][1]: c for k, c in want.items()}


def test_chain_is_one_component(spark):
    """Fingerprints that are linked in a long row only."""
    fps = [0]
    for k in range(60):
        fps.append(fps[-1] ^ 1 << k)
    rows = [(100 - i, f) for i, f in enumerate(fps)]
    got = simhash.components(spark.createDataFrame(rows, "doc_id long, fp long"))
    assert {r.component_id for r in got.collect()} == {40}


def test_edge_cases(spark):
    rows = [(None, None), (3, ""), (2, " "), (7, "a b c d"), (7, "a b c d"), (5, "A b c d"), (None, "zz top")]
    docs = spark.createDataFrame([(i, t, i, 1) for i, t in rows], "doc_id long, text string, fp long, unit int")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted([("None", "2"), ("3", "2"), ("2", "2"), ("7", "5"), ("7", "5"), ("5", "5"), ("None", "None")])
    one = simhash.representatives(docs)
    assert one.columns == docs.columns
    assert sorted(str(r.doc_id) for r in one.collect()) == ["2", "5", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.representatives(docs.limit(0)).count() == 0
