"""Benchmark passages in documents, found by winnowed fingerprints.

A-Z lower-cased, words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. A window is
``WINDOW`` = 13 consecutive words of an item; an item of fewer words, but not
none, is one window. A document word inside any occurrence of a window is hit.

**Winnowing.** Hash every run of ``GRAM`` = 8 words; of every 6 runs that follow
each other keep the one with the smallest hash. As 8 + 6 - 1 = 13, two texts that
share 13 words share the run kept from them, so no shared window is missed.
Benchmark and documents are joined on these hashes. Items of m < 13 words have
a single run, of all m words; documents hash every run of m words for the
lengths m that occur.

**Extension.** Every kept run of an item carries the words around it, as far as
a window with this run can reach. A met run is extended to both sides while the
words agree; at 13 words or more, what was passed over is hit. Equal words are
compared, so hash collisions cannot make a hit.

**Scale.** Documents are read once, and their texts never shuffled: a bitmap of
fixed size (see ``bitmap``) of the benchmark's hashes tells, inside the row, the
few runs to look at; those, with the words around them, go to an exact join.
Only built-in functions are used.

NULL texts have no words, items with none are never met. Rows of ``docs`` equal
in ``doc_id`` and text give equal rows; an item id that occurs several times
counts once; a NULL item id counts as no item, but its words are hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.functions.arrays import let
from gradmill.llm import bitmap
from gradmill.llm.tables import kept, lower_ascii

WINDOW = 13
GRAM = 8
#: Runs that follow each other, of which one is kept.
GUARD = WINDOW - GRAM + 1
#: Words on each side of a run that a window with it can reach.
REACH = WINDOW - GRAM
#: What is no word, after lower-casing; fixed by the definition of a word.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A document is contaminated if one word in so many is hit.
SHARE = 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def _runs(hashed: Column, n: int) -> Column:
    """The hashes of all runs of ``n`` words, in order; none if there are fewer words."""
    return F.when(
        F.size(hashed) >= n,
        F.transform(F.sequence(F.lit(1), F.size(hashed) - (n - 1)),
                    lambda i: F.xxhash64(F.slice(hashed, i, F.lit(n)))),
    ).otherwise(F.array().cast("array<long>"))


def _winnowed(runs: Column, test) -> Column:
    """0-based places of the kept runs whose hash passes ``test``.

    Of ``GUARD`` runs that follow each other, the first with the smallest hash.
    """
    def of_least(least: Column) -> Column:
        good = F.filter(F.sequence(F.lit(1), F.size(least)), lambda i: test(F.get(least, i - 1)))
        return F.array_distinct(F.transform(good, lambda i: (
            i - 2 + F.array_position(F.slice(runs, i, F.lit(GUARD)), F.get(least, i - 1))).cast("int")))

    windows = F.sequence(F.lit(1), F.greatest(F.size(runs) - (GUARD - 1), F.lit(1)))
    return let(F.transform(windows, lambda i: F.array_min(F.slice(runs, i, F.lit(GUARD)))), of_least)


def _hashed(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _all_places(runs: Column, test) -> Column:
    """0-based places of all runs whose hash passes ``test``."""
    return F.filter(F.sequence(F.lit(0), F.size(runs) - 1), lambda i: test(F.get(runs, i)))


def _around(w: Column, at: Column, n: int, reach: int) -> tuple[Column, Column]:
    """The words before (nearest first) and from the start of a run of ``n`` on."""
    left = F.when(at > 0, F.reverse(F.slice(w, F.greatest(at - (reach - 1), F.lit(1)), F.least(at, F.lit(reach)))))
    return F.coalesce(left, F.array().cast("array<string>")), F.slice(w, at + 1, F.lit(n + reach))


def item_runs(items: DataFrame) -> DataFrame:
    """``(hash, n, need, before, after, item_ids)``: what to meet and what has to follow.

    ``n`` is the length of the run, ``need`` the length an extended match has to
    have. Equal runs with equal words around are one row with all their items.
    """
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    long = w.where(F.size("w") >= WINDOW)
    kept_runs = let(_hashed(F.col("w")), lambda h: let(_runs(h, GRAM), lambda r: F.transform(
        _winnowed(r, lambda v: v.isNotNull()), lambda i: F.struct(i.alias("at"), F.get(r, i).alias("hash")))))
    long = long.select("item_id", "w", F.explode_outer(kept_runs).alias("run"))
    before, after = _around(F.col("w"), F.col("run.at"), GRAM, REACH)
    long = long.select("item_id", F.col("run.hash").alias("hash"), F.lit(GRAM).alias("n"),
                       F.lit(WINDOW).alias("need"), before.alias("before"), after.alias("after"))
    short = w.where(F.size("w") < WINDOW).select(
        "item_id", F.xxhash64(_hashed(F.col("w"))).alias("hash"), F.size("w").alias("n"),
        F.size("w").alias("need"), F.array().cast("array<string>").alias("before"), F.col("w").alias("after"))
    every = long.unionByName(short).groupBy("hash", "n", "need", "before", "after")
    return every.agg(F.collect_set("item_id").alias("item_ids"))


def _candidates(hashed: Column, filled: Column, n: int, winnow: bool) -> Column:
    """``(n, at, hash)`` of the runs of ``n`` words that may be in the benchmark."""

    def found(runs: Column) -> Column:
        places = (_winnowed if winnow else _all_places)(runs, lambda h: bitmap.may_hold(filled, h))
        return F.transform(
            places, lambda i: F.struct(F.lit(n).alias("n"), i.alias("at"), F.get(runs, i).alias("hash")))

    none = F.array().cast("array<struct<n:int,at:int,hash:bigint>>")
    return F.coalesce(let(_runs(hashed, n), lambda r: F.when(F.size(r) > 0, found(r))), none)


def _agreeing(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def scan(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, hits)`` of the documents.

    ``rows``: ``(row, doc_id, n_words)`` with a number per input row; ``hits``:
    ``(row, begin, end, item_ids)``, words ``begin`` to ``end - 1`` of row ``row``
    agree with words of these items.
    """
    runs = kept(item_runs(items), "item-runs")
    filled = bitmap.of_hashes(runs, "hash")
    lengths = sorted(r.n for r in runs.where(F.col("need") < WINDOW).select("n").distinct().collect())  # 12 at most

    def candidates(hashed: Column, bits: Column) -> Column:
        return F.concat(_candidates(hashed, bits, GRAM, True),
                        *(_candidates(hashed, bits, m, False) for m in lengths))

    def with_words(w: Column, bits: Column) -> Column:
        def near(c: Column) -> Column:
            # the widest reach serves short items too, which need none
            left, right = _around(w, c["at"], WINDOW, REACH)
            return F.struct(c["n"].alias("n"), c["at"].alias("at"), c["hash"].alias("hash"),
                            left.alias("before"), right.alias("after"))

        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            let(_hashed(w), lambda h: let(
                candidates(h, bits), lambda found: F.transform(found, near))).alias("found"),
        )

    # a column of its own, as a subquery may not be written inside a lambda
    marks = kept(docs.select("doc_id", "text", filled.alias("bits")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        let(F.col("bits"), lambda bits: let(words(F.col("text")), lambda w: with_words(w, bits))).alias("m"),
    ), "decontaminate")
    each = marks.where(F.size("m.found") > 0).select("row", F.explode("m.found").alias("f"))
    met = each.select("row", "f.*").alias("f").join(
        runs.alias("i"), (F.col("f.hash") == F.col("i.hash")) & (F.col("f.n") == F.col("i.n"))
    )
    left = _agreeing(F.col("f.before"), F.col("i.before"))
    right = _agreeing(F.col("f.after"), F.col("i.after"))
    hits = met.select("row", "at", "i.n", "need", left.alias("l"), right.alias("r"), "item_ids")
    hits = hits.where((F.col("r") >= F.col("n")) & (F.col("l") + F.col("r") >= F.col("need")))
    hits = hits.select("row", (F.col("at") - F.col("l")).alias("begin"), (F.col("at") + F.col("r")).alias("end"), "item_ids")
    return marks.select("row", "doc_id", F.col("m.n_words").alias("n_words")), kept(hits, "benchmark-hits")


def verdicts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, item_ids, contaminated)``: one row per document, ids sorted as strings."""
    rows, hits = scan(docs, items)
    spans = hits.select("row", "begin", "end").distinct()
    n_hit = (
        spans.select("row", F.explode(F.sequence("begin", F.col("end") - 1)).alias("word")).distinct()
        .groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = (
        hits.select("row", F.explode("item_ids").alias("item")).distinct()
        .groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("item_ids"))
    )
    out = rows.join(n_hit, "row", "left").join(found, "row", "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((hit > 0) & (SHARE * hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated."""
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    bad = verdicts(keyed, items).where("contaminated").select("doc_id.*").distinct()
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("h").alias("bad_h"))
    same = (F.xxhash64("id", "h") == F.xxhash64("bad_id", "bad_h")) & (F.col("h") == F.col("bad_h"))
    left = row.join(bad, same & F.col("id").eqNullSafe(F.col("bad_id")), "left_anti")
    return left.select(*(F.col("row")[c].alias(c) for c in docs.columns))
