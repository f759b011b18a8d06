"""The whole pipeline against a plain version of every stage."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from gradmill.llm import line_dedup, toxicity
from tests.llm import test_decontaminate, test_line_dedup, test_packing, test_simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]

    model = toxicity.fit(docs, read("labels"))
    scores = model.scores([t for _, t, _ in rows])
    rows = [r for r, s in zip(rows, scores) if s < toxicity.THRESHOLD]

    sources = {i: s for i, _, s in rows}
    rows = [(int(i), t) for i, t in test_line_dedup.slow(rows, line_dedup.MIN_SITES)]

    marks = [(i, test_simhash.slow_fingerprint(t)) for i, t in rows]
    first = test_simhash.slow_components(marks)
    rows = [r for n, r in enumerate(rows) if first[n] == r[0]]

    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    bad = {r[0] for r in test_decontaminate.slow(rows, items) if r[4]}
    rows = [r for r in rows if str(r[0]) not in bad]

    test_packing.check(rows, corpus_pipeline.run(spark, sf_dir).collect())
    assert set(sources) >= {i for i, _ in rows}


def test_stages_keep_the_columns_and_take_any_rows(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, removed int, fp long"
    odd = [(None, None, None, None, None, "r", 1, 2), (1, "", "en", "s", 0, "r", 1, 2),
           (1, "same text", "en", "s", 9, "r", 1, 2), (1, "same text", "en", "s", 9, "r", 1, 2)]
    for docs in (spark.createDataFrame(odd, schema), spark.createDataFrame([], schema)):
        assert [name for name, _ in corpus_pipeline.STAGES] == [
            "toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            rows = out.count()
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.schema.simpleString() == docs.schema.simpleString()
            assert rows <= docs.count()
