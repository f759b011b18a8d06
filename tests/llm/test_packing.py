import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gradmill.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
with open(PATH, encoding="utf-8") as f:
    VOCABULARY = f.read()
SCHEMA = "doc_id long, text string, length int, task string, number long"


def packed(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    return packing.pack(docs, VOCABULARY, public_tokenizers.PATTERN, **kw).collect()


def check(rows, out, capacity=1024):
    """Round trip: all ids of all documents, in full pieces, in gapless sequences."""
    slow = Tokenizer.from_file(PATH)
    want = Counter()
    for d, t in rows:
        ids = np.array([*slow.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % capacity + 1
        at = 0
        for n, size in enumerate([first] + [capacity] * ((len(ids) - first) // capacity)):
            want[(d, n, at, size, zlib.crc32(ids[at:at + size].tobytes()))] += 1
            at += size
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("text", [
    "", " ", "plain text", "x" * 3000, " " * 3000, "\n\n  \n", "a<|endoftext|>b", "É é ß ñ", "日本語 text", "a b c",
    "it's we'll I'M", "1234567 12,5", "\x00\x01", "𝒳 emoji 🙂", "tab\tand\r\nline", "¼ ½ ª º", "don’t", "­soft",
    "\x1c\x1d\x85 odd blanks", "ſ ɏ Ā", "  two  spaces  ",
])
def test_ids_are_those_of_tokenizers(text):
    encoder = packing.Encoder(VOCABULARY, public_tokenizers.PATTERN)
    assert encoder.ids(text) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_ids_of_random_latin_text():
    encoder, slow = packing.Encoder(VOCABULARY, public_tokenizers.PATTERN), Tokenizer.from_file(PATH)
    rng = random.Random(1)
    letters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x250)] if c != 0xAD]
    for _ in range(300):
        text = "".join(rng.choices(letters, k=200))
        assert encoder.ids(text) == slow.encode(text, add_special_tokens=False).ids


def test_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = packed(spark, rows)
    used = check(rows, out)
    assert used <= sum(r.length for r in out) / 1024 * 1.03 + 1


def test_edge_cases(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, None), (3, "long " * 5000), (3, "long " * 5000), (4, "w " * 1023)]
    check(rows, packed(spark, rows))
    assert packed(spark, []) == []
    out = packed(spark, [(1, "a b c")], keep_ids=True)
    assert zlib.crc32(np.array(out[0].ids, "<u4").tobytes()) == out[0].ids_crc32 and out[0].ids[-1] == 2


def test_equal_lengths_everywhere(spark):
    rows = [(i, "one two three") for i in range(2000)]
    out = packed(spark, rows)
    each = 1024 // out[0].length
    assert check(rows, out) == -(-2000 // each)


def fewest(items, capacity):
    """The fewest sequences, by trying all."""
    best = len(items)

    def go(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(items):
            best = len(room)
            return
        for k in range(len(room)):
            if items[i] <= room[k] and room[k] not in room[:k]:
                room[k] -= items[i]
                go(i + 1, room)
                room[k] += items[i]
        go(i + 1, room + [capacity - items[i]])

    items.sort(reverse=True)
    go(0, [])
    return best


def test_reduction_keeps_the_optimum():
    rng = random.Random(2)
    for _ in range(300):
        capacity = rng.choice([10, 17, 30])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        fixed, left = packing.reduce_by_dominance(Counter(items), capacity)
        used = Counter(w for lengths, times in fixed for w in lengths * times)
        assert used + Counter(left) == Counter(items)
        assert all(sum(lengths) <= capacity for lengths, _ in fixed)
        rest = [w for w, n in left.items() for _ in range(n)]
        assert sum(t for _, t in fixed) + fewest(rest, capacity) == fewest(items, capacity)


def plain_best_fit(items, capacity):
    room = []
    for w in sorted(items, reverse=True):
        fits = [r for r in room if r >= w]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - w)
        else:
            room.append(capacity - w)
    return len(room)


def test_bulk_best_fit_is_best_fit():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([20, 64, 100])
        items = rng.choices(range(1, capacity + 1), k=rng.randint(0, 60))
        items += rng.choices(items or [3], k=rng.randint(0, 40))
        got = packing.best_fit(Counter(items), capacity)
        assert Counter(w for lengths, times in got for w in lengths * times) == Counter(items)
        assert sum(t for _, t in got) == plain_best_fit(items, capacity)


def test_plan_of_billions():
    counts = {w: 10**9 + w * 997 for w in range(1, 1025)}
    got = packing.plan(counts)
    assert len(got) < 5000
    total = Counter()
    for lengths, times in got:
        for w in lengths:
            total[w] += times
    assert total == counts
    assert sum(t for _, t in got) * 1024 < sum(w * n for w, n in counts.items()) * 1.0001
