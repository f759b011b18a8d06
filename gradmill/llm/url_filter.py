"""URL filter: host and path rules, and a ratio of two character models for the rest.

**Rules** block or allow a host with all its subdomains, if the path starts with
the rule's; the longest fitting rule wins, of two equally long ones the last by name.

**Models.** URLs that a rule allows teach the model of accepted URLs, those that a
rule blocks the model of rejected ones. Each is a smoothed variable-order
Markov model of the bytes of ``host + path`` and an end mark: the probability of a byte
after up to ``ORDER`` bytes is its share of the longest context's count, blended with
the probability after the next shorter one by the weight ``n / (n + sqrt(n) + 1)``, where
``n`` is the context's count: often seen contexts are trusted more.

A byte with the ``ORDER`` bytes before it is a *gram*, six bytes in a long, and its
score depends on nothing else. So counts are a table of grams: summed over all URLs,
spread to the shorter contexts, and turned into one score per gram, order by order.
Contexts have at most 256 next bytes, so no key of these joins is hot. Nothing is hashed
or capped, and neither the counts nor the scores leave the executors: the URLs lie in
blocks of about ``BLOCK_BYTES``, the distinct grams of a block meet their scores, and
a block and its scores meet again.

**Score**: log-likelihood of the accepted model minus that of the rejected one, per
byte. **Calibration**: one host in ``HELD_OUT``, by its checksum, teaches no model; the
threshold is where the shares of wrongly judged accepted and rejected URLs of these
hosts add up to the least (counted in ``BINS`` bins). URLs without a rule are allowed
from the threshold on.

Without taught URLs of both sorts the method allows everything that no rule blocks;
without held-out URLs of both sorts the threshold is 0. NULL and empty URLs and those
without ``://`` have empty host and path and score 0; a URL that is only ``://`` as well.
Every row is judged, rows with the same page_id or URL alike, also with a NULL page_id;
repeated URLs count as often as they occur. A task holds one block, or one URL if that
is longer. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradmill.llm.tables import kept

#: ``(host, path, verdict)``; fixed by the contract of the query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
ORDER = 5
BLOCK_BYTES = 4 << 20
#: What a row counts in its block beside its text.
ROW_BYTES = 32
HELD_OUT = 5
BINS = 4096
#: Scores beyond this are counted in the outermost bins.
SPAN = 8.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def by_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule; NULL if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, what in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


# --- models ---------------------------------------------------------------------


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts, one text after the other, and how many each has."""
    pad = b"\0" * ORDER
    raw = np.frombuffer(b"".join(pad + t.replace(b"\0", b"\2") + b"\1" for t in texts), np.uint8)
    at = np.flatnonzero(raw)
    gram = np.zeros(len(at), np.int64)
    for back in range(ORDER, -1, -1):
        gram = gram << 8 | raw[at - back]
    return gram, np.array([len(t) + 1 for t in texts], np.int64)


def _addresses(rows) -> list[bytes]:
    hosts, paths = (rows.column(c).cast(pa.binary()).to_pylist() for c in ("host", "path"))
    return [h + p for h, p in zip(hosts, paths)]


def _in_blocks(parts: DataFrame) -> DataFrame:
    """``parts`` with the number of the ``block`` a row is in: neighbours, by their bytes."""

    def run(batches):
        first, done = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            sizes = pc.add(pc.binary_length(b.column("host")), pc.binary_length(b.column("path"))).to_numpy()
            ends = done + np.cumsum(sizes.astype(np.int64) + ROW_BYTES)
            done = int(ends[-1]) if len(ends) else done
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first + ends // BLOCK_BYTES)], [*b.schema.names, "block"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)
    return parts.mapInArrow(run, f"{kinds}, block long")


def counted(parts: DataFrame) -> DataFrame:
    """``(block, gram, good, bad)`` of rows ``(host, path, taught, block)``.

    ``taught`` is 1 for the accepted model, -1 for the rejected one, else 0. All grams
    appear, also those nothing is learned from; a block may name a gram again.
    """

    def run(batches):
        for b in batches:
            block, taught = (b.column(c).to_numpy() for c in ("block", "taught"))
            texts = _addresses(b)
            for one in np.unique(block):
                rows = np.flatnonzero(block == one)
                grams, sizes = _grams([texts[r] for r in rows])
                distinct, place = np.unique(grams, return_inverse=True)
                sort = np.repeat(taught[rows], sizes)
                good, bad = (np.bincount(place[sort == s], minlength=len(distinct)) for s in (1, -1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(distinct), one)), *map(pa.array, (distinct, good, bad))],
                    ["block", "gram", "good", "bad"])

    return parts.select("host", "path", "taught", "block").mapInArrow(run, "block long, gram long, good long, bad long")


def gram_scores(grams: DataFrame) -> DataFrame:
    """``(gram, ratio)``: log-probability of the gram's byte in the accepted model less that in the rejected."""
    sums = [F.sum(c).alias(c) for c in ("good", "bad")]
    tails = [F.struct(F.lit(k).alias("order"), F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("key"))
             for k in range(ORDER + 1)]
    counts = grams.groupBy("gram").agg(*sums).select("good", "bad", F.inline(F.array(*tails)))
    counts = counts.groupBy("order", "key").agg(*sums)
    context = Window.partitionBy("order", F.shiftright("key", 8))  # at most 256 rows
    counts = counts.select("*", *(F.sum(c).over(context).alias(f"all_{c}") for c in ("good", "bad")))
    counts = kept(counts, "url-counts")
    lower = None
    for k in range(ORDER + 1):
        level = counts.where(F.col("order") == k)
        if lower is None:
            level = level.withColumns({"p_good": F.lit(1 / 256), "p_bad": F.lit(1 / 256)})
        else:
            shorter = F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1))
            level = level.withColumn("shorter", shorter).join(lower.withColumnRenamed("key", "shorter"), "shorter")
        lower = level.select("key", *(_blended(c).alias(f"p_{c}") for c in ("good", "bad")))
    return lower.select(F.col("key").alias("gram"), (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def _blended(sort: str) -> Column:
    n = F.col(f"all_{sort}")
    new = F.sqrt(n) + 1
    return (F.col(sort) + new * F.col(f"p_{sort}")) / (n + new)


def scored(parts: DataFrame, grams: DataFrame, ratios: DataFrame) -> DataFrame:
    """``(page_id, host, path, rule, ruled, held_out, score)`` of all rows."""
    needed = grams.select("block", "gram").join(ratios, "gram").select("block", "gram", "ratio")
    names = ["page_id", "host", "path", "rule", "ruled", "held_out"]

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        known, first = np.unique(found.column("gram").to_numpy(), return_index=True)
        ratio = found.column("ratio").to_numpy()[first]
        grams, sizes = _grams(_addresses(rows))
        of = np.repeat(np.arange(len(sizes)), sizes)
        total = np.bincount(of, ratio[np.searchsorted(known, grams)], len(sizes))
        score = np.where(sizes > 1, total / sizes, 0.0)
        return rows.select(names).append_column("score", pa.array(score))

    kinds = ", ".join(f"{c} {parts.schema[c].dataType.simpleString()}" for c in names)
    return parts.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(run, f"{kinds}, score double")


def threshold_of(good: np.ndarray, bad: np.ndarray) -> float:
    """The bin edge that misjudges the least, as shares of accepted plus rejected URLs; 0 without both."""
    if not good.sum() or not bad.sum():
        return 0.0
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    passed = 1 - np.concatenate([[0], np.cumsum(bad)]) / bad.sum()
    cost = lost + passed
    ties = np.flatnonzero(cost <= cost.min() + 1e-12)
    middle = (ties[0] + ties[-1]) / 2  # the middle of the gap between both sorts, if there is one
    return float(middle * (2 * SPAN / BINS) - SPAN)


def calibrated(scores: DataFrame) -> float:
    """The threshold by the URLs of held-out hosts that a rule judges; as many rows come here as there are bins."""
    place = F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN)))
    place = F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)).cast("int")
    judged = scores.where("held_out AND ruled IS NOT NULL").groupBy(place.alias("bin"))
    n = np.zeros((2, BINS))
    for r in judged.agg(F.count_if(F.col("ruled") == "allow").alias("good"), F.count_if(F.col("ruled") == "block").alias("bad")).collect():
        n[:, r["bin"]] = r["good"], r["bad"]
    return threshold_of(*n)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, score, verdict)``: one row per page.

    ``score`` is the method's; it decides where no rule does.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    held_out = F.crc32(F.encode("host", "UTF-8")) % HELD_OUT == 0
    parts = parts.select("*", rule.alias("rule"), verdict.alias("ruled"), held_out.alias("held_out"))
    sort = F.when(F.col("ruled") == "allow", 1).when(F.col("ruled") == "block", -1)
    taught = F.when(F.col("held_out"), 0).otherwise(F.coalesce(sort, F.lit(0)))
    parts = kept(_in_blocks(parts.withColumn("taught", taught)), "url-parts")
    grams = kept(counted(parts), "url-grams")
    scores = kept(scored(parts, grams, kept(gram_scores(grams), "gram-scores")), "url-scores")
    sorts = parts.agg(F.max("taught").alias("good"), F.min("taught").alias("bad")).first()
    threshold = calibrated(scores) if (sorts["good"], sorts["bad"]) == (1, -1) else float("-inf")
    judged = F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block")
    return scores.select("page_id", "host", "path", "rule", "score", F.coalesce("ruled", judged).alias("verdict"))
