import random

import numpy as np
import pyarrow as pa
import pytest

from gradmill.llm import passages


def codes(words):
    return passages.word_codes(" ".join(words).encode())


@pytest.mark.parametrize("letters,least", [(1000, 5), (3, 4), (1, 6), (8, 1)])
def test_every_stretch_is_in_one_window(letters, least):
    rng = np.random.default_rng(letters)
    h = rng.integers(0, letters, 60).astype(np.uint64)
    seen = {}
    for l, c, r in passages.compact_windows(h, least).tolist():
        for i in range(l, c + 1):
            for j in range(max(c, i + least - 1), r + 1):
                assert (i, j) not in seen
                seen[i, j] = c
    for i in range(60):
        for j in range(i + least - 1, 60):
            assert seen[i, j] == i + int(h[i:j + 1].argmin())


def test_run_hashes():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, 200).astype(np.uint32)
    for n in (1, 2, 5, 12, 46, 50):
        got = passages.run_hashes(x, n)
        want = [tuple(x[i:i + n]) for i in range(201 - n)]
        assert len(set(zip(got.tolist(), want))) == len(set(want)) == len(set(got.tolist()))
    assert len(passages.run_hashes(x[:4], 5)) == 0


def test_long_repetitive_text_takes_linear_time():
    for words in (["w"] * 100_000, ["a", "b"] * 50_000, [f"w{i % 300}" for i in range(100_000)]):
        x = codes(words)
        k, value, l, c, r = passages.text_windows(x)
        functions = passages.met_functions(len(x) - 4, k, l, c, r)
        assert (functions == passages.FUNCTIONS).all()
        passages.near_keys(x, k, value, l, c, r)


@pytest.mark.parametrize("size", [51, 52, 70, 130])
def test_exact_keys_meet_in_every_shared_passage(size):
    rng = random.Random(size)
    for _ in range(150):
        some = [f"w{i}" for i in range(rng.choice([4, 300]))]
        p = rng.choices(some, k=size)
        keys = []
        for _ in range(2):
            x = codes(rng.choices(some, k=rng.randrange(80)) + p + rng.choices(some, k=rng.randrange(80)))
            k, value, l, c, r = passages.text_windows(x)
            keys.append((x, k, value, l, c, r))
        both, found = np.intersect1d(keys[0][2], keys[1][2]), []
        for x, *w in keys:
            k, value, l, c, r = (column[np.isin(w[1], both)] for column in w)
            functions = passages.met_functions(len(x) - 4, k, l, c, r)
            one = k == 0
            found.append(set(passages.exact_keys(x, functions, l[one], c[one], r[one])[0].tolist()))
        assert found[0] & found[1]


def slow_jaccard(a, b):
    a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(a & b) / len(a | b)


def test_similar_stretches():
    p = [f"p{i}" for i in range(90)]
    edited = p[:40] + ["other"] + p[41:]
    left, right = [f"l{i}" for i in range(30)], [f"r{i}" for i in range(30)]
    a, b = codes(left + p + right), codes(right[::-1] + edited + left[::-1])
    assert slow_jaccard(p, edited) >= 0.8
    assert passages.similar_stretches(a, b, [(35, 35), (36, 36), (100, 100)]) == [(30, 120, 30, 120)]
    h = np.random.default_rng(0).permutation(500).astype(np.uint64)
    assert sorted(map(tuple, passages.compact_windows(h, 9))) == sorted(map(tuple, passages.compact_windows(h, 9, True)))
    assert passages.similar_stretches(a, codes(left[::-1] + p[:45] + right[::-1]), [(35, 35)]) == []
    far = [w if i % 12 else f"x{i}" for i, w in enumerate(p)]
    assert slow_jaccard(p, far) < 0.8 and passages.similar_stretches(codes(p), codes(far), [(3, 3)]) == []


def spread(rng, n):
    return [f"s{rng.randrange(10**9)}" for _ in range(n)]


def covers(found, *want):
    return all(any(all(abs(x - y) <= 6 for x, y in zip(f, w)) for f in found) for w in want)


@pytest.mark.parametrize("swapped", [False, True])
def test_several_passages_of_one_pair_of_documents(swapped):
    """Two passages side by side in one document, 30 words apart or swapped in the other."""
    rng = random.Random(3)
    p, q, between = spread(rng, 100), spread(rng, 100), spread(rng, 30)
    p2, q2 = p[:50] + ["x"] + p[51:], q[:50] + ["y"] + q[51:]
    first, second = (q2, p2) if swapped else (p2, q2)
    a, b = codes(p + q), codes(first + between + second)
    at_p, at_q = (130, 0) if swapped else (0, 130)
    points = [(20, at_p + 20), (70, at_p + 70), (120, at_q + 20), (170, at_q + 70)]
    for x, y, pairs in ((a, b, points), (b, a, [(j, i) for i, j in points])):
        found = passages.similar_stretches(x, y, pairs)
        want = [(0, 100, at_p, at_p + 100), (100, 200, at_q, at_q + 100)]
        assert covers(found, *(want if x is a else [w[2:] + w[:2] for w in want])), found


def test_insertions_and_deletions_against_brute_force():
    """One side may hold all the difference, also in another order."""
    rng = random.Random(5)
    judged = 0
    for n in range(400):
        p = spread(rng, rng.randrange(60, 160))
        at, k = rng.randrange(12, len(p) - 12), rng.randrange(1, 12)
        q = p[:at] + (spread(rng, k) if n % 2 else []) + p[at + (0 if n % 2 else k):]
        if n % 4 < 2:  # halves the other way round
            q = q[len(q) // 2:] + q[:len(q) // 2]
        if len(q) < 50 or slow_jaccard(p, q) < 0.8:
            continue
        judged += 1
        a, b = (codes(spread(rng, 20) + w + spread(rng, 20)) for w in (p, q))
        for x, y, z in ((a, b, p), (b, a, q)):
            point = next((i, j) for i in range(20, len(x)) for j in np.flatnonzero(passages.run_hashes(y, 5) == passages.run_hashes(x, 5)[i]))
            found = passages.similar_stretches(x, y, [point])
            # unmatched ends, the added words and some beside them at most, are cut off
            assert any(f[1] - f[0] >= len(z) - k - 12 for f in found), (n, at, k, len(p), found)
    assert judged > 200


def text(rng, n):
    return [f"t{rng.randrange(10**9)}" for _ in range(n)]


def repeated(spark, docs):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, begin int, doc string")
    rows = passages.repeated(df.repartition(4)).collect()
    assert all(r.other_id != r.doc_id or [i for i, _ in docs].count(r.doc_id) > 1 for r in rows)
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, set()).update(range(r.begin, r.end))
    return out


def test_planted_passages(spark):
    rng = random.Random(7)
    shared = [text(rng, 51 + 9 * k) for k in range(8)]
    near = [text(rng, 120) for _ in range(4)]
    short = [text(rng, 40) for _ in range(3)]
    docs, want, loose = [], {}, {}
    for i in range(160):
        w = text(rng, rng.randrange(10, 300))
        if i < 80:
            p = shared[i % 8]
            at = rng.randrange(len(w) + 1)
            w[at:at] = p
            want[i] = set(range(at, at + len(p)))
        elif i < 96:
            p = list(near[i % 4])
            p[rng.randrange(20, 100)] = f"edit{i}"
            at = rng.randrange(len(w) + 1)
            w[at:at] = p
            loose[i] = set(range(at + 15, at + 105))
        elif i < 120:
            w += short[i % 3]
        docs.append((i, " ".join(w)))
    got = repeated(spark, docs)
    for i, span in want.items():
        assert span <= got[i] and len(got[i]) <= len(span) + 12, i
    for i, span in loose.items():
        assert len(span & got.get(i, set())) >= 0.5 * len(span), i
    assert set(got) <= set(want) | set(loose)


def test_short_near_passages_are_all_found(spark):
    """Passages of 50 words with one edit (Jaccard 0.8), the hardest: all that brute force finds."""
    rng = random.Random(11)
    docs, spans = [], []
    for n in range(300):
        p = text(rng, 50)
        q = list(p)
        q[rng.randrange(5, 45)] = f"edit{n}"
        for i, w in ((2 * n, p), (2 * n + 1, q)):
            before = text(rng, rng.randrange(5, 60))
            spans.append((i, len(before)))
            docs.append((i, " ".join(before + w + text(rng, rng.randrange(5, 60)))))
        assert slow_jaccard(p, q) >= 0.8
    got = repeated(spark, docs)
    missed = [i for i, at in spans if len(set(range(at, at + 50)) & got.get(i, set())) < 45]
    assert not missed, len(missed)


def test_copies_and_edge_cases(spark):
    rng = random.Random(9)
    long = " ".join(text(rng, 70))
    docs = [(5, long), (3, long.upper().replace(" ", "  ")), (9, long), (1, None), (2, ""), (4, "a b c"), (6, "a b c"),
            (None, long), (7, "w " * 500), (8, "w " * 400)]
    got = repeated(spark, docs)
    assert got[5] == got[3] == got[9] == set(range(70))
    assert set(got) == {3, 5, 9, 7, 8} and len(got[8]) == 400
    assert repeated(spark, []) == {}
    assert repeated(spark, [(1, long)]) == {}


def test_registered_table(spark, sf_dir):
    """Every exact stretch of 51 words that two different documents share is covered."""
    docs = {r.doc_id: passages.word_codes((r.text or "").encode())
            for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    owners = {}
    for i, x in docs.items():
        for at, h in enumerate(passages.run_hashes(x, 51).tolist()):
            owners.setdefault(h, []).append((i, at))
    got = {}
    for r in passages.repeated(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect():
        got.setdefault(r.doc_id, set()).update(range(r.begin, r.end))
    for places in owners.values():
        if len({i for i, _ in places}) > 1:
            for i, at in places:
                assert len(set(range(at, at + 51)) & got[i]) >= 50, (i, at)


def test_classes_of_texts_have_64_bits(spark):
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(1000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    found = passages._windows(docs).select("doc", "text").toPandas()
    assert found.text.nunique() == 1000
    halves = (found.text.to_numpy() >> 32 & 0xFFFFFFFF) ^ (found.text.to_numpy() & 0xFFFFFFFF)
    assert len(set(halves.tolist())) > 990  # neither half follows from the other


def test_pairs_are_found_beside_third_documents(spark):
    rng, docs, pairs = random.Random(20), [], []
    for n in range(20):
        a = [f"p{n}x{i}" for i in range(60)]
        b = a[:30] + ["other"] + a[31:]
        pairs.append((1000 + 2 * n, 1001 + 2 * n))
        docs += [(i, " ".join(text(rng, 40) + x + text(rng, 40))) for i, x in zip(pairs[-1], (a, b))]
        # smaller documents with phrases of the passage, too short to repeat
        for at in range(0, 37, 6):
            docs.append((10 * n + at // 6, " ".join(text(rng, 60) + a[at:at + 24] + text(rng, 60))))
    rows = passages.repeated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    others = {}
    for r in rows:
        others.setdefault(r.doc_id, set()).add(r.other_id)
        assert r.end - r.begin >= 50
    assert others == {x: {y} for pair in pairs for x, y in (pair, pair[::-1])}


def test_split_keys_see_the_same_tokens_alike():
    rng = random.Random(3)
    middle = text(rng, 80)
    x, y = (codes(text(rng, n) + middle + text(rng, 50)) for n in (0, 70))
    a, b = passages.split_keys(x, np.arange(34, 44)), passages.split_keys(y, np.arange(104, 114))
    assert (a == b).all() and len(np.unique(a)) > len(passages.SPLITS)
    assert passages.split_keys(x, np.zeros(0, np.int64)).shape == (0, len(passages.SPLITS))
    assert passages.split_keys(x, np.array([0, len(x) - 5])).shape == (2, len(passages.SPLITS))


def test_pairs_are_found_beside_many_third_documents(spark):
    """Smaller documents hold 40 words of each passage, from every place: no split of a group parts them from the pair."""
    rng, docs, pairs = random.Random(21), [], []
    for n in range(20):
        a = [f"p{n}x{i}" for i in range(60)]
        b = a[:30] + ["other"] + a[31:]
        pairs.append((10000 + 2 * n, 10001 + 2 * n))
        docs += [(i, " ".join(text(rng, 40) + x + text(rng, 40))) for i, x in zip(pairs[-1], (a, b))]
        for at in range(21):
            docs.append((100 * n + at, " ".join(text(rng, 60) + a[at:at + 40] + text(rng, 60))))
    rows = passages.repeated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    others = {}
    for r in rows:
        others.setdefault(r.doc_id, set()).add(r.other_id)
    assert others == {x: {y} for pair in pairs for x, y in (pair, pair[::-1])}


def test_surroundings_let_all_similar_stretches_pass():
    rng, judged = random.Random(4), 0
    for n in range(600):
        words = 2 if n % 3 == 0 else 10**6
        p = [f"w{rng.randrange(words)}" for _ in range(rng.randrange(50, 90))]
        k, at = rng.randrange(1, 6), rng.randrange(12, len(p) - 12)
        q = p[:at] + [f"w{rng.randrange(words)}" for _ in range(k)] + p[at + rng.choice([0, k]):]
        if len(q) < 50 or slow_jaccard(p, q) < 0.8:
            continue
        seen, tokens = [], [passages.run_hashes(codes(w), 5) for w in (p, q)]
        i, j = rng.choice([(i, j) for i, x in enumerate(tokens[0]) for j in np.flatnonzero(tokens[1] == x)])
        for w, before, at in ((p, rng.randrange(200), i), (q, rng.randrange(200), j)):
            x = codes(text(rng, before) + w + text(rng, 150))
            seen.append((*passages.surroundings(passages.run_hashes(x, 5), before + at, 0, len(x)), min(before + at, passages.SIDE)))
        (a, need_a, slack_a, i), (b, need_b, slack_b, j) = seen
        judged += 1
        assert 9 * (len(np.intersect1d(a, b)) + min(slack_a, slack_b)) >= 4 * (need_a + need_b)
        if len(np.unique(tokens[0])) == len(tokens[0]) and k < 4:  # a few words: similar in order, not by repeats only
            assert passages.may_be_similar(a.view(np.uint16), b.view(np.uint16), i, j)
    assert judged > 200


def test_windows_of_many_texts_at_once():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, kinds, n).astype(np.uint32) for kinds in (2, 60, 1 << 30) for n in (0, 3, 49, 50, 51, 400)]
    begins, found = passages.windows_of_texts(texts)
    assert len(begins) == len(texts) + 1 and begins[-1] == found.shape[1]
    for n, x in enumerate(texts):
        tokens = passages.run_hashes(x, 5)
        one = found[:, begins[n]:begins[n + 1]]
        assert one.tolist() == passages.text_windows(x).tolist()
        for k in range(passages.FUNCTIONS):
            own = passages._mixed(tokens + np.uint64(int(passages._GOLD) * (2 * k + 1) % (1 << 64)))
            seen = {(begin, c) for kk, v, l, c, r in one.T.tolist() if kk == k and v == int(own[c].view(np.int64))
                    for begin in range(max(l, c - 45), min(c, r - 45) + 1)}
            assert seen == {(b, b + int(own[b:b + 46].argmin())) for b in range(len(tokens) - 45)}


def test_the_most_that_stretches_may_share():
    rng = np.random.default_rng(6)
    for n, kinds in ((46, 10_000), (47, 50), (120, 10_000), (200, 90)):
        _, tokens = np.unique(rng.integers(0, kinds, n), return_inverse=True)
        matched = rng.random(n) < 0.85
        weight = np.where(matched, 1, np.where(np.bincount(tokens)[tokens] == 1, -8, 0))
        total = np.append(0, np.cumsum(weight))
        want = [max(total[e + 1] - total[s] for s in range(at + 1) for e in range(max(at, s + 45), n)) for at in range(n)]
        assert passages._most(matched, tokens, n).tolist() == want


def test_points_that_share_too_little_cost_no_verification(monkeypatch):
    rng = np.random.default_rng(8)
    a = rng.integers(0, 1 << 30, 400).astype(np.uint32)
    b = a.copy()
    b[::22] += 1  # 17 of 22 tokens are equal everywhere: enough for four to one on either side, not for 0.8
    points = [(n, n) for n in range(1, 390) if 1 <= n % 22 <= 17]
    monkeypatch.setattr(passages, "_Shifts", None)
    assert passages.similar_stretches(a, b, points) == []


def test_which_pairs_may_be_similar():
    rng, pairs = np.random.default_rng(9), []
    for n in range(300):
        x = rng.integers(0, 300 if n % 2 else 1 << 16, rng.integers(46, 186)).astype(np.uint16)
        y = np.where(rng.random(len(x)) < rng.choice([0.05, 0.2, 0.3]), rng.integers(0, 1 << 16, len(x)), x).astype(np.uint16)
        at = int(rng.integers(max(0, len(x) - 93), min(93, len(x))))
        pairs.append((x, y, at, at))
    want = [all(passages._around(np.where(np.isin(p, q), 1, -4), at) is not None for p, q, at in ((x, y, i), (y, x, j)))
            for x, y, i, j in pairs]
    a, b, i, j = zip(*pairs)
    sizes = np.array([len(x) for x in a])
    got = passages.which_may_be_similar(np.concatenate(a), sizes, np.array(i), np.concatenate(b), sizes, np.array(j))
    assert got.tolist() == want and 30 < sum(want) < 270
    assert [passages.may_be_similar(*p) for p in pairs[:20]] == want[:20]


def test_shuffle_files_go_when_a_table_is_written(spark, monkeypatch):
    seen, real = [], passages.kept
    monkeypatch.setattr(passages, "kept", lambda df, purpose: seen.append(spark.conf.get(passages._CLEANUP, None)) or real(df, purpose))
    before = spark.conf.get(passages._CLEANUP, None)
    words = " ".join(f"w{n}" for n in range(60))
    rows = passages.repeated(spark.createDataFrame([(1, words + " a"), (2, "b " + words)], "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2] and seen and set(seen) == {"true"}
    assert spark.conf.get(passages._CLEANUP, None) == before


def test_members_are_compared_as_their_stretches_are():
    """By what similar stretches need together, not by either side alone: 17 of 22 equal tokens are not enough."""
    rng, pairs = np.random.default_rng(11), []
    for n in range(200):
        x = rng.integers(0, 300 if n % 2 else 1 << 16, 2 * passages.SIDE + 1).astype(np.uint16)
        y = np.where(rng.random(len(x)) < rng.choice([0.02, 0.08, 0.2, 0.3]), rng.integers(0, 1 << 16, len(x)), x).astype(np.uint16)
        pairs.append((x, y))
    x = np.arange(2 * passages.SIDE + 1).astype(np.uint16)
    pairs.append((x, np.where(x % 22 < 17, x, x + 1000).astype(np.uint16)))
    want = []
    for x, y in pairs:
        _, both = np.unique(np.concatenate([x, y]), return_inverse=True)
        a, b = both[:len(x)], both[len(x):]
        most = [passages._most(np.isin(p, q), p, len(both))[passages.SIDE] for p, q in ((a, b), (b, a))]
        want.append(sum(most) >= 0 and 9 * len(np.intersect1d(a, b)) >= 4 * 2 * passages.LEAST
                    and passages.may_be_similar(x, y, passages.SIDE, passages.SIDE))
    held = pa.array([x.view(np.int16) for pair in pairs for x in pair], pa.list_(pa.int16()))
    n = len(held)
    members = passages._Members(held, np.full(n, passages.SIDE), np.full(n, passages.LEAST), np.zeros(n, int))
    assert members.alike(np.arange(0, n, 2), np.arange(1, n, 2)).tolist() == want
    assert 20 < sum(want) < 180 and not want[-1] and passages.may_be_similar(*pairs[-1], passages.SIDE, passages.SIDE)


def test_open_members_that_are_alike_cost_a_candidate_each(spark, monkeypatch):
    """Near copies whose hub only shares a phrase with them: not every one is verified with every other."""
    rng, counts, real = random.Random(23), {}, passages.kept

    def counted(df, purpose):
        out = real(df, purpose)
        counts[purpose] = out.count()
        return out

    p = [f"p{i}" for i in range(90)]
    docs = [(1, " ".join(text(rng, 30) + p[25:65] + text(rng, 30)))]
    for n in range(14):  # all differ from each other, in one word near an end
        at = 3 + n if n % 2 else 86 - n
        docs.append((10 + n, " ".join(text(rng, 30) + p[:at] + [f"other{n}"] + p[at + 1:] + text(rng, 30))))
    docs.append((40, " ".join(text(rng, 30) + p[25:65] + text(rng, 30))))  # and one more that is like none
    monkeypatch.setattr(passages, "kept", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    # no passage of 50 equal words is to cover them before
    monkeypatch.setattr(passages, "exact_keys", lambda codes, *_: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    rows = passages.repeated(frame).collect()
    monkeypatch.setattr(passages, "BLOCK", 4)
    assert sorted(map(tuple, passages.repeated(frame).collect())) == sorted(map(tuple, rows))
    assert {r.doc_id for r in rows} == set(range(10, 24))
    assert counts["first-candidates"] + counts["open-candidates"] <= 3 * 14


def test_codes_of_many_texts_at_once():
    texts = [None, "", " ", "a", "A  b\t\nC\x0b\x0cd\r ", " x", "y ", "no", "blanks", "\x1c\x85 \xa0É É", "z" * 63 + " " + "z" * 64 + " " + "Z" * 65 + " " + "z" * 300, "q"]
    for some in (pa.array(texts), pa.array(texts).slice(3, 6), pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        codes, ends = passages.codes_of_texts(some)
        want = [passages.word_codes(x and x.encode()) for x in some.to_pylist()]
        assert [x.tolist() for x in np.split(codes, ends[:-1])][:len(want)] == [x.tolist() for x in want]


def test_first_and_last_texts_of_values():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, 300, 4000):
        value, text = rng.integers(0, max(n // 3, 1), n), rng.integers(0, 3, n)
        want = sorted({(x, f(text[value == x])) for x in value.tolist() for f in (min, max)})
        assert list(zip(*(x.tolist() for x in passages._first_and_last(value, text)))) == want


def test_surroundings_of_many_windows_at_once():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, kinds, n).astype(np.uint32) for kinds, n in ((2, 300), (1, 90), (60, 500), (1 << 30, 400), (1 << 30, 20))]
    ends = np.cumsum([len(x) for x in texts])
    rows = [(n, *w) for n, x in enumerate(texts) for w in passages.text_windows(x)[2:].T.tolist()]
    own, l, c, r = np.array(rows).T
    begin = (ends - [len(x) for x in texts])[own]
    held, sizes, need, slack = passages.surroundings_of_many(
        passages.run_hashes(np.concatenate(texts), 5), ends, c + begin, l + begin, r + 5 + begin)
    for (n, l, c, r), *got in zip(rows, np.split(held, np.cumsum(sizes)[:-1]), need.tolist(), slack.tolist()):
        want = passages.surroundings(passages.run_hashes(texts[n], 5), c, l, r + 5)
        assert [got[0].tolist(), *got[1:]] == [want[0].tolist(), *want[1:]]


def test_pairs_are_verified_together_as_one_by_one():
    rng, rows = random.Random(13), []
    for n in range(60):
        p = spread(rng, rng.randrange(40, 130))
        q = p[:30] + spread(rng, n % 5) + p[30 + n % 3:]
        rows.append((codes(spread(rng, 9) + p), codes(q + spread(rng, n % 7)), [(9 + k, k) for k in range(0, 30, 3)]))
    found = [passages.similar_stretches(*row) for row in rows]
    assert list(passages.similar_stretches_of(*map(list, zip(*rows)))) == found and 20 < sum(map(bool, found)) < 60


def test_the_longest_rising_part_is_that_of_all_places():
    rng = np.random.default_rng(7)
    for n in range(300):
        q = np.arange(40) * 3
        at = rng.integers(0, 40, n % 30)
        q[at] = rng.integers(0, 120, len(at))
        assert passages._rising(q).tolist() == passages._longest(q.tolist()).tolist()


def test_only_minima_of_windows_are_kept_of_a_text(spark):
    """Windows are found again where they are needed: a column less for each of their three places and their function."""
    words = " ".join(text(random.Random(3), 200))
    found = passages._windows(spark.createDataFrame([(1, words), (2, None), (3, "w " * 400)], "doc_id long, text string"))
    assert found.columns == ["doc", "text", "n_words", "value"]
    rows = {r.doc: r.value for r in found.collect()}
    k, value, *_ = passages.text_windows(passages.word_codes(words.encode()))
    assert sorted(set(value.tolist())) == sorted(rows[1]) and rows[2] == [] and len(rows[3]) == passages.FUNCTIONS


def test_a_row_per_range_of_minima_is_shuffled(spark):
    """And no text is the only one of a value that two batches have."""
    found = spark.createDataFrame([(n, [7, -(1 << 62) + n // 2, n]) for n in range(40)] + [(50, [100, 100])], "text long, value array<long>")
    got = sorted(r.value for r in passages._shared(found.repartition(5)).collect())
    assert got == sorted([-(1 << 62) + n for n in range(20)] + [7])


def test_minima_leave_the_disk_when_all_that_meet_are_written(spark, monkeypatch):
    kept, real = {}, passages.kept
    monkeypatch.setattr(passages, "kept", lambda df, purpose: kept.setdefault(purpose, real(df, purpose)))
    words = " ".join(f"w{n}" for n in range(60))
    frame = spark.createDataFrame([(1, words + " a"), (2, "b " + words), (3, words + " a")], "doc_id long, text string")
    rows = passages.repeated(frame)
    left = spark.read.schema(kept["compact-windows"].schema).parquet(kept["compact-windows"].inputFiles()[0].rsplit("/", 1)[0])
    assert left.count() == 0 and {(r.doc_id, r.begin, r.end, r.other_id) for r in rows.collect()} == {(1, 0, 61, 3), (2, 1, 61, 1), (3, 0, 61, 1)}
