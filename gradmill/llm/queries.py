"""The registered results of the operators of this package."""

from __future__ import annotations

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from gradmill.llm import (
    centroids, collocations, decontaminate, exact_dedup, line_dedup, packing, passages, pii, simhash, token_counts, toxicity, url_filter,
    vector_search,
)
from gradmill.llm.tables import table


def op1_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def number(kind):
        mine = F.filter(base, lambda s: s["kind"] == kind)
        return F.size(mine).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op2_decontaminate(spark, sf_dir):
    found = decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def packed(docs):
    """With the public byte-level vocabulary; its place is asked of the driver alone."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return packing.pack(docs, f.read(), public_tokenizers.PATTERN)


def op3_vector_search(spark, sf_dir):
    vectors = vector_search.usable(table(spark, sf_dir, "embeddings"))
    return vector_search.top_k(vectors, F.col("vec_id") % 100 == 0)


def op4_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def op5_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_line_dedup(spark, sf_dir):
    marked = line_dedup.without_boilerplate(table(spark, sf_dir, "documents"))
    removed = F.coalesce(F.col("removed"), F.array().cast("array<int>"))
    text = F.when(F.col("removed").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(
        line_dedup.cleaned_text(F.col("lines"), F.col("removed"))
    )
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        F.sha2(text, 256).alias("text_sha256"),
    )


def op7_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def word_vocabulary() -> list[str]:
    """The plain pieces of the 32,000-piece vocabulary."""
    vocabulary = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [i for i in range(vocabulary.get_piece_size())
             if not (vocabulary.is_control(i) or vocabulary.is_unknown(i) or vocabulary.is_byte(i))]
    return [vocabulary.id_to_piece(i) for i in plain]


def op8_token_counts(spark, sf_dir):
    starts, parts = token_counts.word_pieces(word_vocabulary())
    return token_counts.count(table(spark, sf_dir, "documents"), token_counts.Automaton(starts, parts))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_passages(spark, sf_dir):
    return passages.repeated(table(spark, sf_dir, "documents"))


def op11_centroids(spark, sf_dir):
    found, final = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(spark, found, final)


def op12_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digests=True)


def op13_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


def all_queries():
    return {name: f for name, f in globals().items() if name.startswith("op")}


OP6_SQL = """
WITH parts AS (
    SELECT doc_id, source, unnest(s) AS part, unnest(range(len(s))) AS pos
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS s FROM documents)
),
lines AS (
    SELECT *, nullif(trim(part, ' ' || chr(9) || chr(13)), '') AS line FROM parts
),
spread AS (
    SELECT line, min(struct_pack(doc_id := doc_id, pos := pos)) AS first
    FROM lines WHERE line IS NOT NULL
    GROUP BY line HAVING count(DISTINCT source) >= 10
),
marked AS (
    SELECT l.doc_id, l.pos, l.part,
           s.line IS NOT NULL AND NOT (l.doc_id = s.first.doc_id AND l.pos = s.first.pos) AS gone
    FROM lines l LEFT JOIN spread s ON l.line = s.line
)
SELECT d.doc_id, coalesce(m.n_lines, 0) AS n_lines, coalesce(m.n_removed, 0) AS n_removed,
       sha256(coalesce(m.text, '')) AS text_sha256
FROM documents d LEFT JOIN (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
           string_agg(part, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS text
    FROM marked GROUP BY doc_id
) m USING (doc_id)
"""


OP3_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE embedding IS NOT NULL
),
scored AS (
    SELECT q.vec_id AS query_id, p.vec_id,
           CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * p.x[i])) AS BIGINT) AS score
    FROM v q JOIN v p ON q.vec_id % 100 = 0 AND q.vec_id <> p.vec_id AND len(q.x) = len(p.x)
),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP2_SQL = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) b
       WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM iw) x),
lens AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n) x),
met AS (SELECT o.doc_id, o.i, o.n, win.item_id FROM occ o JOIN win ON o.n = win.n AND o.g = win.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) x GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) x GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN found ON dw.doc_id = found.doc_id
"""


def _op11_sql(rounds: int = 5) -> str:
    """Lloyd's rounds, one after the other; products of whole doubles are exact here."""
    x = "list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE)))"
    parts = [f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, x, list_dot_product(x, x) AS xx
    FROM (SELECT vec_id, {x} AS x FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
          AND len(list_filter(embedding, lambda e: isfinite(CAST(e AS DOUBLE)))) = 64)
),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM
    (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT 40)
)"""]
    for n in range(rounds + 1):
        parts.append(f"""
a{n} AS MATERIALIZED (
    SELECT v.row, min(struct_pack(d := v.xx - 2 * list_dot_product(v.x, k.x) + list_dot_product(k.x, k.x), c := k.c)) AS b
    FROM v, c{n} k GROUP BY v.row
)""")
        if n < rounds:
            parts.append(f"""
c{n + 1} AS MATERIALIZED (
    SELECT k.c, coalesce(m.x, k.x) AS x FROM c{n} k LEFT JOIN (
        SELECT c, list(floor(s / n) ORDER BY i) AS x FROM (
            SELECT c, i, sum(e) AS s, count(*) AS n
            FROM (SELECT b.c AS c, unnest(x) AS e, unnest(range(64)) AS i FROM a{n} JOIN v USING (row)) u GROUP BY c, i) t
        GROUP BY c) m ON m.c = k.c
)""")
    return ",".join(parts) + f"""
SELECT v.vec_id, CAST(b.c AS INTEGER) AS cluster, CAST(b.d AS BIGINT) AS distance,
       CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(k.x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN c{rounds} k ON k.c = b.c
"""


OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""

OP13_SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents) x
),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (
    SELECT lang, g, CAST(count(*) AS HUGEINT) AS f FROM (
        SELECT lang, w[i:i + k - 1] AS g FROM (
            SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
            FROM pieces, (SELECT unnest(range(1, 6)) AS k) s WHERE len(w) >= k) y) z
    GROUP BY lang, g HAVING count(*) >= 100
),
cuts AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
best AS (
    SELECT c.lang, c.g, min(struct_pack(score := 1000 * c.a * t.n // (l.f * r.f), k := c.k, l := l.f, r := r.f)) AS b, any_value(c.a) AS a,
           any_value(t.n) AS n
    FROM cuts c JOIN total t ON t.lang = c.lang JOIN f l ON l.lang = c.lang AND l.g = c.g[1:c.k]
    JOIN f r ON r.lang = c.lang AND r.g = c.g[c.k + 1:len(c.g)]
    GROUP BY c.lang, c.g
),
inner_ AS (
    SELECT lang, g[i:i + s - 1] AS g, max(a) AS within FROM (
        SELECT lang, g, a, s, unnest(range(1, len(g) - s + 2)) AS i FROM (
            SELECT lang, g, a, unnest(range(2, len(g))) AS s FROM best WHERE len(g) > 2) x) y
    GROUP BY lang, g[i:i + s - 1]
),
ranked AS (
    SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.b.score DESC, a DESC, array_to_string(b.g, ' ')) AS rank,
           array_to_string(b.g, ' ') AS phrase, a, b.b.l AS l, b.b.r AS r, n, b.b.score AS score
    FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.g = b.g
    WHERE i.g IS NULL OR 100 * i.within < 100 * a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def all_oracles():
    return {
        "op2_decontaminate": OP2_SQL, "op3_vector_search": OP3_SQL, "op6_line_dedup": OP6_SQL, "op11_centroids": _op11_sql(),
        "op12_exact_dedup": OP12_SQL, "op13_collocations": OP13_SQL,
    }
