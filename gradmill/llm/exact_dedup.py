"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are compared with every run of white space as one space. One narrow scan
counts rows by length and by the hash of the first ``HEAD`` characters. Lengths of
one row are settled by that alone, then pairs of length and prefix hash of one row.
Only rows of the pairs left get the hash of their full content (SHA-256, taken for
equality) and meet in a shuffle, as digest and id; the text is not moved. The pairs
left reach the scan as a bitmap of fixed size: where it errs, a row is hashed that need
not be, and turns out to be alone.

Groups are counted by partial and final aggregates; the one row per digest is joined
back to the narrow rows, whose hot digests are left to adaptive skew handling.

Results for the odd cases: a NULL text is an empty one, and empty texts are copies of
each other; texts are read whole, however long. Of equal texts the row with the
smallest id stays, ids that are NULL coming last; among rows that repeat an id one row
stays, any of them. An empty table gives an empty result. Other columns are
not looked at, whatever their names, and are carried only if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.llm import bitmap
from gradmill.llm.tables import kept

#: Characters of the prefix that is hashed.
HEAD = 64


def normalised(text: Column) -> Column:
    """Every run of white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _shape(text: Column, head: int) -> tuple[Column, Column]:
    return F.octet_length(text), F.xxhash64(F.substring(text, 1, head))


def open_shapes(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """``(size, prefix)``: lengths of more than one row, refined to prefix hashes of more than one row."""
    size, prefix = _shape(normalised(F.col("text")), head)
    counts = kept(
        docs.select(size.alias("size"), prefix.alias("prefix")).groupBy("size", "prefix").agg(F.count("*").alias("n")),
        "exact-shapes",
    )
    lengths = counts.groupBy("size").agg(F.sum("n").alias("n")).where("n > 1").select("size")
    return counts.join(lengths, "size", "left_semi").where("n > 1").select("size", "prefix")


def exact_duplicates(docs: DataFrame, carry: tuple[str, ...] = (), head: int = HEAD, digests: bool = False) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``(doc_id, text)``.

    The digest of a row that length or prefix settle is NULL, unless ``digests`` asks for
    all. With ``carry``, those columns of the row follow in a struct ``row``.
    """
    shapes = kept(open_shapes(docs, head).select(F.xxhash64("size", "prefix").alias("h")), "exact-open")
    marks = bitmap.of_hashes(shapes, "h", bitmap.MANY_BITS)

    row = [F.struct(*carry).alias("row")] if carry else []
    carried = ["row"] if carry else []
    # named and used more than once, so that a text is normalised once
    texts = docs.select("doc_id", normalised(F.col("text")).alias("t"), F.monotonically_increasing_id().alias("number"), *row)
    left = bitmap.may_hold(marks, F.xxhash64(*_shape(F.col("t"), head)), bitmap.MANY_BITS)
    digest = F.sha2("t", 256)
    texts = texts.withColumn("left", left).withColumn("text_sha256", digest if digests else F.when(F.col("left"), digest))
    # written, so that the number of a row stays the same for all that read it
    full = kept(texts.select("doc_id", "left", "text_sha256", "number", *carried), "exact-full")
    alone = full.where(~F.col("left")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", *carried)
    left = full.where("left")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "number")).alias("first")
    groups = kept(left.groupBy("text_sha256").agg(first, F.count("*").alias("group_size")), "exact-groups")
    met = left.join(groups, "text_sha256").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("number") == F.col("first.number")).alias("kept"), "text_sha256", *carried)
    return alone.unionByName(met)


def without_copies(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and their texts as they were."""
    return exact_duplicates(docs, tuple(docs.columns), head).where("kept").select("row.*")
