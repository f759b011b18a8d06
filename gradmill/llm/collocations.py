"""Frequent phrases and their collocation scores, by multikey quicksort of suffix pointers.

A suffix starts at every word of a piece and is followed for at most ``LONGEST`` words. Four
passes over the texts, each a tokenizer in numpy over an Arrow batch:

1. words are counted; the frequent ones go into a bitmap of fixed size;
2. pairs of frequent words are counted by the hashes of both words; the frequent ones go into a bitmap;
3. threes of words whose pairs are frequent are counted by a hash (an upper bound of each one's
   count, which drops no frequent three); the frequent ones go into a bitmap;
4. suffixes of a frequent three, cut before the first three words that are not frequent, are
   written with the number of times a task holds them (up to ``HELD_ROWS`` different ones at a time), so
   a hot phrase is a row per task. They are one row per word of the texts at most. Suffixes that
   would be cut after their frequent pair are one row for all tasks: the count of the pair less the suffixes
   that go on. (Should two words have one hash, which is looked up, the tasks write them as well.)

The suffixes are routed by their leading words over the whole corpus: a range
partitioning on the words splits wherever rows are many, so that a hot leading word is
split by the words after it. In each range a three-way radix quicksort looks at one
word at a time: the weight of an equal partition is the count of the phrase that
leads there, and a partition below the threshold is left at once. Only phrases that
lead the first or last suffix of a range may go on in the neighbouring one; their
counts are given out whatever they are, and a sum over all ranges settles them.

A bitmap that fills up (tens of millions of frequent pairs or threes) prunes less and changes no
result. Everything after that is joins and aggregates over the frequent phrases.

Results for the odd cases: a NULL text is empty and has no words, a NULL language is ``und``,
rows count one by one also if they repeat, and whole texts are read however long (a
batch is cut after ``PART`` characters, never inside a text). Scores are exact decimals.
An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradmill.llm import bitmap
from gradmill.llm.tables import kept

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
#: Characters of text that are looked at together.
PART = 1 << 23
#: Distinct suffixes that a task holds before it writes them.
HELD_ROWS = 1 << 19
#: Distinct hashes that it holds.
HELD_HASHES = 1 << 20
#: Splits of the table that one task of the last two passes reads, so that what they have in common is a row once.
SPLITS = 4
#: Suffixes that a range holds about.
RANGE_ROWS = 500_000

# fixed values: what ends a piece, and what separates words in it
BREAKS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(GAPS)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- words of a batch -----------------------------------------------------------


class Words:
    """The words of some texts in order: ``code`` into ``names``, language number, and whether a piece goes on."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2] if len(texts) else None
        text = _LOWER[np.frombuffer(data, np.uint8)[at[0]:at[-1]]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        kind = _KIND[text]
        inside = kind == 0
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(text))]  # where one text ends and the next begins
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        doc = np.searchsorted(at, begin, "right") - 1
        piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
        self.goes_on = np.zeros(len(begin), bool)  # the word follows another of its piece
        self.goes_on[1:] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        offsets = np.zeros(len(begin) + 1, np.int64)
        np.cumsum(end - begin, out=offsets[1:])
        flat = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(text[inside]))
        words = flat.dictionary_encode()
        self.code, self.names = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
        spoken = pc.fill_null(langs, UNKNOWN).dictionary_encode()
        self.langs = spoken.dictionary
        self.lang = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc]

    def hashes(self) -> np.ndarray:
        """A hash per word and language, for the bitmaps."""
        names = np.array([xxhash.xxh64_intdigest(w, 42) for w in self.names.to_pylist()], np.uint64)
        langs = np.array([xxhash.xxh64_intdigest(w, 7) for w in self.langs.to_pylist()], np.uint64)
        return _mixed(names[self.code] + langs[self.lang]) if len(self.code) else np.zeros(0, np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _pairs(h: np.ndarray) -> np.ndarray:
    """A hash of every word with the next one."""
    return _mixed(_mixed(h[:-1]) + h[1:])


def _may_hold(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h >> np.uint64(6)) & np.uint64(len(words) - 1)
    return (words[at] >> (h & np.uint64(63))) & np.uint64(1) == 1


def _parts(batches):
    """Texts and languages, cut to stretches of about ``PART`` bytes."""
    for b in batches:
        size = np.cumsum(np.array(pc.fill_null(pc.binary_length(b.column(0)), 0).to_numpy(zero_copy_only=False), np.int64))
        at = 0
        while at < b.num_rows:
            until = int(np.searchsorted(size, (size[at - 1] if at else 0) + PART, "right"))
            until = max(until, at + 1)
            yield Words(b.column(0).slice(at, until - at), b.column(1).slice(at, until - at))
            at = until


def _counted_words(batches):
    for w in _parts(batches):
        # one row per word and language of the part
        _, first, n = np.unique(w.lang * len(w.names) + w.code, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [w.langs.take(pa.array(w.lang[first])).cast(pa.string()), w.names.take(pa.array(w.code[first])).cast(pa.string()),
             pa.array(w.hashes()[first].view(np.int64)), pa.array(n)], ["lang", "word", "h", "n"])


def _frequent_pairs(h: np.ndarray, w: Words, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs of the words with the hashes ``h``, and where both words are of one piece and frequent."""
    good = _may_hold(words, h)
    return _pairs(h), good[:-1] & good[1:] & w.goes_on[1:]


def _frequent_threes(w: Words, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all threes, where both pairs of one are frequent, and where a pair is."""
    h, good = _frequent_pairs(w.hashes(), w, words)
    good &= _may_hold(pairs, h)
    return _mixed(_mixed(h[:-1]) + h[1:]), good[:-1] & good[1:], good


def _counted_pairs(words):
    """Counts of the pairs of frequent words, by the hashes of both."""
    def run(batches):
        # those of several parts are summed before they leave the task
        held, number = np.zeros((0, 2), np.uint64), np.zeros(0, np.int64)
        for w in _parts(batches):
            h = w.hashes()
            pair, good = _frequent_pairs(h, w, words.value)
            rows, n = _summed(np.stack([h[:-1], h[1:]], 1)[good], np.ones(np.count_nonzero(good), np.int64), pair[good])
            rows, number = np.concatenate([held, rows]), np.concatenate([number, n])
            held, number = _summed(rows, number, _mixed(_mixed(rows[:, 0]) + rows[:, 1]))
            if len(held) >= HELD_HASHES:
                yield _hash_batch(held, number, ["first", "second"])
                held, number = held[:0], number[:0]
        yield _hash_batch(held, number, ["first", "second"])

    return run


def _pair_hashes(batches):
    for b in batches:
        first, second = (b.column(c).to_numpy().view(np.uint64) for c in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(_mixed(_mixed(first) + second).view(np.int64))], ["h"])


def _counted_threes(words, pairs):
    """Counts of the threes of frequent ``pairs``, by their hashes."""
    def run(batches):
        # those of several parts are summed before they leave the task
        held, number = np.zeros((0, 1), np.uint64), np.zeros(0, np.int64)
        for w in _parts(batches):
            h, good = _frequent_threes(w, words.value, pairs.value)[:2]
            h, n = np.unique(h[good], return_counts=True)
            held, number = _summed(np.concatenate([held, h[:, None]]), np.concatenate([number, n]))
            if len(held) >= HELD_HASHES:
                yield _hash_batch(held, number, ["h"])
                held, number = held[:0], number[:0]
        yield _hash_batch(held, number, ["h"])

    return run


def _hash_batch(rows: np.ndarray, n: np.ndarray, names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in rows.T]
    return pa.RecordBatch.from_arrays([*columns, pa.array(n)], [*names, "n"])


def _summed(rows: np.ndarray, n: np.ndarray, by: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows``, sorted, and the sums of their ``n``.

    With ``by``, a hash of each, sorted by that alone; then some row may come twice if hashes meet.
    """
    order = np.lexsort(rows.T[::-1]) if by is None else np.argsort(by)
    rows, n = rows[order], n[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(1))) if len(rows) else np.zeros(0, np.int64)
    return rows[first], np.add.reduceat(n, first) if len(rows) else n


def _numbers(names: pa.Array, codes: np.ndarray, known: dict[str, int]) -> np.ndarray:
    """The numbers in ``known``, which grows, of ``codes`` into ``names``; -1 stays."""
    used, at = np.unique(codes, return_inverse=True)
    found = [-1 if c < 0 else known.setdefault(names[c].as_py(), len(known)) for c in used.tolist()]
    return np.array(found, np.int64)[at].reshape(codes.shape)


def _suffixes(words, pairs, longest, threes=None, shortest=2):
    """Suffixes of ``shortest`` words or more, two or three."""
    def run(batches):
        # suffixes of several parts are summed before they leave the task
        langs, names, held, weight = {}, {}, np.zeros((0, longest + 1), np.int64), np.zeros(0, np.int64)
        for w in _parts(batches):
            h, on, good = _frequent_threes(w, words.value, pairs.value)
            if threes is not None:
                on &= _may_hold(threes.value, h)
            start, steps = np.flatnonzero(good), np.append(on, np.zeros(longest, bool))
            if shortest > 2:
                start = start[steps[start]]
            rows = np.full((len(start), longest + 1), -1, np.int64)
            rows[:, 0], rows[:, 1], rows[:, 2] = w.lang[start], w.code[start], w.code[start + 1]
            alive = np.ones(len(start), bool)
            for d in range(1, longest - 1):
                alive &= steps[start + d - 1]
                rows[alive, d + 2] = w.code[start[alive] + d + 1]
            rows, n = _summed(rows, np.ones(len(rows), np.int64))
            if not len(rows):
                continue
            rows[:, 0], rows[:, 1:] = _numbers(w.langs, rows[:, 0], langs), _numbers(w.names, rows[:, 1:], names)
            held, weight = _summed(np.concatenate([held, rows]), np.concatenate([weight, n]))
            if len(held) >= HELD_ROWS:
                yield _suffix_batch(held, weight, langs, names)
                langs, names, held, weight = {}, {}, held[:0], weight[:0]
        yield _suffix_batch(held, weight, langs, names)

    return run


def _suffix_batch(rows: np.ndarray, n: np.ndarray, langs: dict[str, int], names: dict[str, int]) -> pa.RecordBatch:
    size = (rows[:, 1:] >= 0).sum(1)
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    flat = pa.array(list(names), pa.string()).take(pa.array(rows[:, 1:][rows[:, 1:] >= 0]))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(langs), pa.string()).take(pa.array(rows[:, 0])), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(n)],
        ["lang", "words", "n"])


# --- the sort of a range --------------------------------------------------------


def frequent_prefixes(rows: np.ndarray, weight: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """``(row, depth, count)`` of the prefixes that ``least`` or more of the weighted ``rows`` begin with.

    A three-way quicksort of row pointers, one column at a time; -1 ends a row. A
    partition that weighs less than ``least`` is left at once.
    """
    found, todo = [], [(np.arange(len(rows)), 0)]
    while todo:
        pointers, depth = todo.pop()
        if weight[pointers].sum() < least:
            continue
        key = rows[pointers, depth]
        pivot = key[len(key) // 2]
        low, high = pointers[key < pivot], pointers[key > pivot]
        same = pointers[key == pivot] if len(low) or len(high) else pointers
        todo += [(part, depth) for part in (low, high) if len(part)]
        if pivot < 0:
            continue
        count = int(weight[same].sum())
        if count >= least:
            found.append((int(same[0]), depth + 1, count))
            if depth + 1 < rows.shape[1]:
                todo.append((same, depth + 1))
    return found


def _ranks(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Every string's rank in the byte order of the distinct ones, and these in that order."""
    coded = column.combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    order = pc.sort_indices(coded.dictionary.cast(pa.binary()))  # as Spark orders strings
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return rank[codes] if len(codes) else np.zeros(0, np.int64), coded.dictionary.take(order)


def _range_counts(least, longest):
    def run(batches):
        held = pa.Table.from_batches([b for b in batches if b.num_rows], schema=_SUFFIX)
        if not held.num_rows:
            return
        lang, langs = _ranks(held.column(0))
        lists = held.column(1).combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        word, words = _ranks(pa.chunked_array([lists.flatten()]))
        weight = held.column(2).to_numpy()
        del held, lists
        rows = np.full((len(lang), longest + 1), -1, np.int64)
        rows[:, 0] = lang
        rows[:, 1:][np.arange(longest) < size[:, None]] = word
        # prefixes of the first and last row may go on in another range
        order = np.lexsort(rows.T[::-1])
        rows, weight = rows[order], weight[order]
        found = {(tuple(rows[row, :depth].tolist())): n for row, depth, n in frequent_prefixes(rows, weight, least) if depth > 2}
        for edge in (rows[0], rows[-1]):
            for depth in range(3, int((edge >= 0).sum()) + 1):
                key = tuple(edge[:depth].tolist())
                if key not in found:
                    found[key] = int(weight[(rows[:, :depth] == edge[:depth]).all(1)].sum())
        keys = list(found)
        flat = np.array([c for k in keys for c in k[1:]], np.int64)
        offsets = np.append(0, np.cumsum([len(k) - 1 for k in keys])).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [langs.take(pa.array([k[0] for k in keys], pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), words.take(pa.array(flat))),
             pa.array([found[k] for k in keys], pa.int64())], ["lang", "words", "n"])

    return run


_SUFFIX = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("n", pa.int64())])
_ROWS = "lang string, words array<string>, n long"


# --- the job --------------------------------------------------------------------


def _shared_bitmap(hashes: DataFrame):
    """The bitmap of ``h``, sent to the tasks (2 MB)."""
    spark = hashes.sparkSession
    words = spark.range(1).select(bitmap.of_hashes(hashes, "h", bitmap.MANY_BITS)).first()[0]
    return spark.sparkContext.broadcast(np.array(words, np.int64).view(np.uint64))


def _in_larger_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` in tasks of ``SPLITS`` splits, in whole rounds of the cores; as many tasks as cores if there are so many splits."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rounds = -(-rows.rdd.getNumPartitions() // (SPLITS * cores))
    return rows.coalesce(max(rounds, 1) * cores)


def _cut_after_pairs(pairs: DataFrame, single: DataFrame, long: DataFrame) -> DataFrame:
    """``(lang, words, n)``: the occurrences of each of ``pairs``, named by ``single`` words, that no suffix of ``long`` begins with."""
    first = single.select("lang", F.col("h").alias("first"), F.col("word").alias("a"))
    second = single.select(F.col("h").alias("second"), F.col("word").alias("b"))
    named = pairs.join(first, "first").join(second, "second").select("lang", F.array("a", "b").alias("words"), "n")
    going_on = long.groupBy("lang", F.slice("words", 1, 2).alias("words")).agg(F.sum("n").alias("more"))
    rest = F.col("n") - F.coalesce("more", F.lit(0))
    return named.join(going_on, ["lang", "words"], "left").select("lang", "words", rest.alias("n")).where("n > 0")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Word counts ``(lang, word, n)`` over all of ``(text, lang)``, and ``(lang, words, n)`` of the frequent phrases.

    Phrases have one to ``longest`` words and occur ``least`` times or more.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counted = texts.mapInArrow(_counted_words, "lang string, word string, h long, n long")
    words = kept(counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("n")), "phrase-words")
    single = words.where(F.col("n") >= least)
    in_words = _shared_bitmap(single.select("h"))

    def frequent(counted: DataFrame, keys: list[str], purpose: str) -> DataFrame:
        return kept(counted.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") >= least), purpose)

    pairs = frequent(texts.mapInArrow(_counted_pairs(in_words), "first long, second long, n long"), ["first", "second"], "phrase-pairs")
    in_pairs = _shared_bitmap(pairs.mapInArrow(_pair_hashes, "h long"))
    joined = _in_larger_tasks(texts)  # the rows of the passes before would not fit
    in_threes = _shared_bitmap(frequent(joined.mapInArrow(_counted_threes(in_words, in_pairs), "h long, n long"), ["h"], "phrase-threes"))
    if words.groupBy("h").count().where("count > 1").isEmpty():  # two hashes are two words
        long = kept(joined.mapInArrow(_suffixes(in_words, in_pairs, longest, in_threes, 3), _ROWS), "phrase-long-suffixes")
        suffixes = kept(long.unionByName(_cut_after_pairs(pairs, single, long)), "phrase-suffixes")
    else:
        suffixes = kept(joined.mapInArrow(_suffixes(in_words, in_pairs, longest, in_threes), _ROWS), "phrase-suffixes")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-suffixes.count() // RANGE_ROWS))
    counts = suffixes.repartitionByRange(parts, "lang", "words").mapInArrow(_range_counts(least, longest), _ROWS)
    phrases = counts.groupBy("lang", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    every = single.select("lang", F.array("word").alias("words"), "n").unionByName(phrases)
    return words.select("lang", "word", "n"), kept(every, "phrase-counts")


def _joined(words):
    return F.array_join(words, " ")


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, words, a, l, r, n, score)`` of every phrase of two words or more, by its weakest cut."""
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    keyed = phrases.select("lang", _joined("words").alias("phrase"), F.col("n").alias("f"))
    long = phrases.where(F.size("words") > 1).select("lang", "words", F.col("n").alias("a"))
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "*", _joined(F.slice("words", F.lit(1), F.col("k"))).alias("left"),
        _joined(F.slice("words", F.col("k") + 1, F.size("words"))).alias("right"))
    left = keyed.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = keyed.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    met = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(total, "lang")
    exact = "CAST((CAST(1000 * n AS DECIMAL(20,0)) * CAST(a AS DECIMAL(18,0))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS LONG)"
    met = met.withColumn("score", F.expr(exact))
    best = met.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))
    return best.select("lang", _joined("words").alias("phrase"), "words", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def not_covered(found: DataFrame, share: int = 100) -> DataFrame:
    """The phrases that no longer one holds with ``share`` percent of their count or more."""
    size = F.size("words")
    inner = (
        found.where(size > 2).select("lang", "words", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("size"))
        .select("lang", "words", "a", "size", F.explode(F.sequence(F.lit(1), size - F.col("size") + 1)).alias("at"))
        .groupBy("lang", _joined(F.slice("words", F.col("at"), F.col("size"))).alias("phrase")).agg(F.max("a").alias("within"))
    )
    covered = F.coalesce(100 * F.col("within") >= share * F.col("a"), F.lit(False))
    return found.join(inner, ["lang", "phrase"], "left").where(~covered).drop("within")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases."""
    words, phrases = phrase_counts(docs, least, longest)
    found = not_covered(kept(scored(words, phrases), "phrase-scores"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
