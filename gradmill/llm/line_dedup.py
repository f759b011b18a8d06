"""Removal of boilerplate lines that spread over many sites.

A line is a stretch of text between newlines; its site is the document's
``source``. Lines are compared by content without surrounding blanks; blank
lines are never touched, and neither are rows whose source is NULL (they count
for no site). A line on ``min_sites`` distinct sites or more is boilerplate:
one copy stays, in the document with the smallest ``doc_id`` (NULL last; then
smallest text hash, then smallest line number), all others are removed.

How the number of sites is found:

1. One HyperLogLog sketch of the sites per line hash, merged by aggregation, so
   a line that fills a third of the corpus costs a few hundred bytes per task.
2. A sketch at twice ``min_sites`` or more decides at once, one at half of it or
   less too (sixteen standard errors away); lines between get an exact count.

Only built-in functions are used, nothing is collected, and texts are shuffled
once at most, to meet their line numbers.

NULL and empty texts stay as they are. Rows equal in ``doc_id`` and text are
one document and are treated alike. All columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.functions.arrays import let
from gradmill.llm import bitmap
from gradmill.llm.tables import kept

MIN_SITES = 10
#: log2 of the registers of a sketch: standard error 1.04 / sqrt(1024) = 3.3 %.
LOG_K = 10


def _line_hash(line: Column) -> Column:
    """NULL for blank lines."""
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.xxhash64(bare))


def _lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, site, pos, line)``: one row per line that is not blank.

    The hash and the lines are made below the explosion, so that its rows do
    not carry the text; the outer form spares a filter that splits once more.
    """
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.col("source").alias("site"), F.split("text", "\n", -1).alias("parts"))
    return (
        split.select("doc_id", "text_hash", "site", F.posexplode_outer("parts").alias("pos", "part"))
        .select("doc_id", "text_hash", "site", "pos", _line_hash(F.col("part")).alias("line"))
        .where("line IS NOT NULL")
    )


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(line, first)``: the hash of every boilerplate line and where its kept copy is."""
    place = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_hash"), F.col("pos")
    )
    seen = _lines(docs).groupBy("line").agg(
        F.hll_sketch_agg(F.col("site").cast("string"), F.lit(LOG_K)).alias("sites"),
        F.min(place).alias("first"),
    )
    spread = F.hll_sketch_estimate("sites")
    near = kept(
        seen.select("line", "first", spread.alias("spread"))
        .where(F.col("spread") > min_sites / 2),
        "line-spread",
    )
    sure = near.where(F.col("spread") >= 2 * min_sites).select("line", "first")
    unsure = near.where(F.col("spread") < 2 * min_sites).select("line", "first")
    asked = bitmap.of_hashes(unsure, "line")
    exact = (
        _lines(docs).where(F.col("site").isNotNull() & bitmap.may_hold(asked, F.col("line")))
        .groupBy("line", "site").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("line").agg(F.count(F.lit(1)).alias("n_sites"))
        .where(F.col("n_sites") >= min_sites)
    )
    return sure.unionByName(unsure.join(exact, "line").select("line", "first"))


def without_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(row, lines, removed)`` for every input row.

    ``row`` is the row as it came, ``lines`` its lines, ``removed`` the sorted
    numbers (from 0) of the lines to go, NULL if none.
    """
    found = kept(boilerplate(docs, min_sites), "boilerplate")
    filled = bitmap.of_hashes(found, "line")
    hits = (
        _lines(docs).where(bitmap.may_hold(filled, F.col("line"))).alias("l")
        .join(found.alias("b"), F.col("l.line") == F.col("b.line"))
        .where(~(F.col("l.doc_id").eqNullSafe(F.col("b.first.doc_id"))
                 & (F.col("l.text_hash") == F.col("b.first.text_hash"))
                 & (F.col("l.pos") == F.col("b.first.pos"))))
        .select(F.col("l.doc_id").alias("id"), F.col("l.text_hash").alias("hash"), "l.pos")
        .groupBy("id", "hash").agg(F.sort_array(F.collect_set("pos")).alias("removed"))
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("key"), F.xxhash64("text").alias("key_hash")
    )
    return rows.join(
        hits, F.col("key").eqNullSafe(F.col("id")) & (F.col("key_hash") == F.col("hash")), "left"
    ).select("row", F.split("row.text", "\n", -1).alias("lines"), "removed")


def cleaned_text(lines: Column, removed: Column) -> Column:
    """The lines that stay, joined again."""
    def join(all_lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), removed)
        return F.array_join(F.transform(stay, lambda i: F.get(all_lines, i)), "\n")

    return let(lines, join)


def clean(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the same columns and rows, boilerplate lines gone from ``text``."""
    marked = without_boilerplate(docs, min_sites)
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(
        cleaned_text(F.col("lines"), F.col("removed"))
    )
    return marked.select(
        *(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns)
    )
