"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; it is written
as Parquet and read again before the next one. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from gradmill.llm import decontaminate, line_dedup, queries, simhash, toxicity
from gradmill.llm.tables import kept, table


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity model accepts."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_boilerplate_lines(spark, docs, sf_dir):
    """Texts without the copies of lines that spread over many sources."""
    return line_dedup.clean(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of every group of linked fingerprints."""
    return simhash.representatives(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents without a twentieth of their words in benchmark passages."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark, docs, sf_dir):
    """Pieces of tokenized documents with their places in sequences."""
    return queries.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

#: Learned scores and a packing are not to be had in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
