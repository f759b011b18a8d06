"""Near-duplicate groups by SimHash fingerprints and a Gray-order index.

**Fingerprints.** A-Z lower-cased, words are runs without blanks, shingles are
``shingle_words`` words joined by a space (fewer words: all of them; none:
fingerprint 0). A bit is 1 if it is set in over half of the shingles' XXH64.

**Index.** Two fingerprints with at most ``MAX_BITS`` = 3 differing bits agree on
one of four 16-bit blocks. In each of the four rotations that bring a block to
the front, fingerprints are sorted by Gray rank: equal leading bits lie side by
side, and neighbours differ in few bits. Each bucket of equal leading blocks
gets a tree over that order. A node holds the bits that all its members share
and its ancestors do not (mask and pattern); a search adds up the differences
on the way down and leaves a whole group as soon as they exceed the limit.

**Hot buckets.** Only distinct fingerprints are indexed, so copies weigh nothing.
A bucket of more than ``BUCKET`` of them is dealt anew by the next bits, again
by pigeonhole; what stays dense (a bucket of near-equal fingerprints) is cut
into slices, and every pair of slices is one unit of work. Out of a unit come the
edges of a spanning forest, never all its pairs.

**Components.** Edges are contracted by alternating large-star and small-star
steps (Kiveris et al., 2014), each written to the shared folder.

NULL texts count as empty, rows with a NULL id take part and never give their
component a name unless all of it is NULL; repeated rows are members like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.llm.tables import kept

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints that one unit of work compares at most (twice that for two slices).
BUCKET = 256
#: Bits of each of the four blocks per round: 4 x 16 = 64, then of the 48 left, then of 36.
ROUNDS = (16, 12, 9)
#: Children of a tree node.
FAN = 8
#: Pairs of fingerprint and node held at a time.
FRONTIER = 1 << 20


# --- fingerprints ---------------------------------------------------------------


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Of UTF-8 bytes, whose ``lower`` and ``split`` see ASCII letters and blanks only."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    value = np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return int(value.astype(np.int64))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``: one row per document, the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = pa.array([fingerprint(t, shingle_words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- buckets --------------------------------------------------------------------


def _rotated(value: Column, n: int) -> Column:
    if n == 0:
        return value
    return F.shiftleft(value, n).bitwiseOR(F.shiftrightunsigned(value, 64 - n))


def _rest_rotated(value: Column, done: int, n: int) -> Column:
    """The lowest ``64 - done`` bits rotated by ``n``, the others in place."""
    width = 64 - done
    if n == 0:
        return value
    rest = value.bitwiseAND((1 << width) - 1)
    turned = F.shiftleft(rest, n).bitwiseOR(F.shiftrightunsigned(rest, width - n))
    turned = turned.bitwiseAND((1 << width) - 1)
    return value.bitwiseAND(-(1 << width)).bitwiseOR(turned)


def _gray_rank(value: Column) -> Column:
    for n in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, n))
    return value


def _dealt(rows: DataFrame, done: int, block: int) -> DataFrame:
    """Every row four times, each with another block behind the ``done`` bits that are fixed."""
    turns = F.array(*(
        F.struct(F.lit(i).alias("i"),
                 (_rest_rotated(F.col("turned"), done, i * block) if done
                  else _rotated(F.col("turned"), i * block)).alias("turned"))
        for i in range(4)
    ))
    each = rows.select("bucket", "fp", F.explode(turns).alias("t"))
    head = F.shiftrightunsigned("t.turned", 64 - done - block)
    return each.select(
        F.xxhash64("bucket", "t.i", head).alias("bucket"), "fp", F.col("t.turned").alias("turned")
    )


def units(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(unit, fp, turned)``: a unit's rows have to be compared with each other.

    A unit is a bucket, or two slices of a dense one. Bucket numbers are hashes:
    if two buckets ever shared one, more would be compared and nothing lost.
    """
    rows = fps.select(F.lit(0).cast("long").alias("bucket"), "fp", F.col("fp").alias("turned"))
    ready, done = [], 0
    for block in ROUNDS:
        rows = kept(_dealt(rows, done, block), "simhash-buckets")
        done += block
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        large = kept(sizes.where(F.col("n") > bucket), "simhash-large")
        several = sizes.where((F.col("n") > 1) & (F.col("n") <= bucket)).select("bucket")
        ready.append(rows.join(several, "bucket").select("bucket", "fp", "turned", F.lit(1).alias("slices")))
        if large.isEmpty():
            break
        rows = rows.join(large, "bucket").select("bucket", "fp", "turned", "n")
    else:
        slices = F.ceil(F.col("n") / bucket).cast("int")
        ready.append(rows.select("bucket", "fp", "turned", slices.alias("slices")))
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more)
    own = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    each = every.select("bucket", "fp", "turned", "slices", own.alias("own"),
                        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other"))
    each = each.where((F.col("own") != F.col("other")) | (F.col("slices") == 1))
    pair = F.least("own", "other"), F.greatest("own", "other")
    return each.select(F.xxhash64("bucket", *pair).alias("unit"), "fp", "turned")


# --- the tree -------------------------------------------------------------------


def _levels(turned: np.ndarray, starts: np.ndarray) -> list[dict]:
    """Tree levels from the leaves up, for sorted values in groups from ``starts`` on.

    Every level has the shared bits of its nodes (``mask``, ``pattern``), the
    place of the last leaf below (``last``) and the range of children on the
    level below. The highest level has one node per group.
    """
    n = len(turned)
    level = {"all": turned, "any": turned, "last": np.arange(n), "starts": starts}
    levels = [level]
    while len(level["all"]) > len(starts):
        counts = np.diff(np.append(level["starts"], len(level["all"])))
        nodes = -(-counts // FAN)
        group = np.repeat(np.arange(len(counts)), nodes)
        first = np.concatenate([[0], np.cumsum(nodes)[:-1]])
        begin = level["starts"][group] + (np.arange(len(group)) - first[group]) * FAN
        end = np.append(begin[1:], len(level["all"]))
        level = {
            "all": np.bitwise_and.reduceat(level["all"], begin),
            "any": np.bitwise_or.reduceat(level["any"], begin),
            "last": level["last"][end - 1], "starts": first, "begin": begin, "end": end,
        }
        levels.append(level)
    for level in levels:
        level["mask"] = ~(level["all"] ^ level["any"])
        level["pattern"] = level["all"] & level["mask"]
    return levels


def close_pairs(turned: np.ndarray, starts: np.ndarray, max_bits: int):
    """Blocks of ``(i, j)``, ``i < j``: places in the same group at ``max_bits`` or less."""
    levels = _levels(turned, starts)
    top = levels[-1]
    counts = np.diff(np.append(starts, len(turned)))
    root_of = np.repeat(np.arange(len(starts)), counts)
    # as many searches at a time as could visit FRONTIER leaves
    load = np.cumsum(counts[root_of])
    at = 0
    while at < len(turned):
        base = load[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(load, base + FRONTIER, "right")))
        query = np.arange(at, stop)
        node = root_of[at:stop]
        apart = np.bitwise_count((turned[query] ^ top["pattern"][node]) & top["mask"][node]).astype(np.int64)
        above = top["mask"][node]
        for level, below in zip(levels[:0:-1], levels[-2::-1]):
            width = level["end"][node] - level["begin"][node]
            child = np.repeat(level["begin"][node], width) + _counted(width)
            query, apart, above = (np.repeat(x, width) for x in (query, apart, above))
            later = below["last"][child] > query
            query, apart, above, child = (x[later] for x in (query, apart, above, child))
            own = below["mask"][child] & ~above
            apart = apart + np.bitwise_count((turned[query] ^ below["pattern"][child]) & own)
            near = apart <= max_bits
            query, apart, node = query[near], apart[near], child[near]
            above = below["mask"][node]
        later = node > query
        yield query[later], node[later]
        at = stop


def _counted(widths: np.ndarray) -> np.ndarray:
    """0, 1, … for each width, one after another."""
    ends = np.cumsum(widths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - widths, widths)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of ``a`` and ``b``; ``label`` names each set by its smallest place."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def forest_edges(unit, fp, turned, max_bits: int = MAX_BITS):
    """``(a, b)`` fingerprint pairs that span what is linked within each unit; rows sorted by unit."""
    starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    label = np.arange(len(fp))
    for i, j in close_pairs(turned.view(np.uint64), starts, max_bits):
        _join(label, i, j)
    led = np.flatnonzero(label != np.arange(len(fp)))
    return fp[led], fp[label[led]]


def edges(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: links whose components are those of all pairs at ``max_bits`` or less.

    ``max_bits`` may be 3 at most, as four blocks are told apart.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be from 0 to 3")

    def run(batches):
        held: list[np.ndarray] = []  # rows of units that may not be over
        for b in batches:
            part = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in range(3)])
            held.append(part)
            if sum(x.shape[1] for x in held) < 1 << 15:
                continue
            rows = np.concatenate(held, axis=1)
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last unit may go on
            if cut:
                yield _arrow(*forest_edges(*rows[:, :cut], max_bits))
            held = [rows[:, cut:]]
        if held:
            yield _arrow(*forest_edges(*np.concatenate(held, axis=1), max_bits))

    dealt = units(fps, bucket).select("unit", "fp", "turned", _gray_rank(F.col("turned")).alias("rank"))
    n = dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = dealt.repartition(int(n), "unit").sortWithinPartitions("unit", "rank")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _arrow(a, b):
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


# --- components -----------------------------------------------------------------


def star_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with a link; the root is the component's smallest node."""
    links = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written before it is joined: only plain sides of a join are split where keys are hot
        least = kept(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star-least")
        large = kept(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct(), "large-star",
        )
        lower = kept(large.groupBy("a").agg(F.min("b").alias("m")), "star-lower")
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = kept(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        if _digest(after) == _digest(links):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = after


def _digest(links: DataFrame):
    h = F.xxhash64("a", "b")
    return links.agg(F.count(F.lit(1)), F.sum(h % 1000003), F.bit_xor(h)).first()


def components(marks: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``(fp, component_id)`` for every distinct fingerprint of ``(doc_id, fp)``."""
    first = kept(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = star_components(edges(first.select("fp"), max_bits, bucket))
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    named = kept(
        first.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots",
    )
    names = kept(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-names")
    return named.join(names, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)``: one row per document."""
    marks = kept(fingerprints(docs, shingle_words), "simhash")
    return marks.join(components(marks, max_bits), "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, one per component: the one with its smallest id.

    Of rows that share this id, one with the smallest text hash stays; of rows
    equal in both, one.
    """
    found = near_duplicates(docs, shingle_words, max_bits)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component_id").agg(
        F.min("doc_id").alias("stay_id"))
    # joined on a hash that is never NULL, by which the grouping below is dealt out too
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("key"), F.xxhash64("doc_id").alias("k"))
    met = row.join(stay.withColumn("k", F.xxhash64("stay_id")), "k").where(F.col("key").eqNullSafe(F.col("stay_id")))
    order = F.struct(F.xxhash64("row.text"), F.xxhash64("row"))
    one = met.groupBy("k", "key").agg(F.min_by("row", order).alias("row"))
    return one.select(*(F.col("row")[c].alias(c) for c in docs.columns))
