"""Queries on whole corpora: decontamination, near duplicates, and the full chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.text import GENERIC_SOLUTIONS
from corpusflow.operators import decontam, dedup, ngrams, tokens
from corpusflow.plans.corpus import clean_corpus
from corpusflow.plans.queries_tokens import PIECES_SQL
from corpusflow.plans.registry import query, table, texts

# ---- decontamination ---------------------------------------------------------------------------

_HIT = "EXISTS (SELECT 1 FROM benchmark b WHERE contains(lower(d.text), lower(trim(b.text, ' ' || chr(10)))))"
_CLEAN = f"SELECT doc_id, lang FROM documents d WHERE NOT {_HIT}"


def _strings(spark, sf):
    return decontam.benchmark_strings(table(spark, sf, "benchmark"), "text", GENERIC_SOLUTIONS)


@query("decontaminate", _CLEAN)
def decontaminate(spark, sf):
    docs = texts(spark, sf, "documents")
    return decontam.decontaminate(docs, _strings(spark, sf), "text", "doc_id").select("doc_id", "lang")


@query("decontaminate_anchored", _CLEAN)
def decontaminate_anchored(spark, sf):
    docs = texts(spark, sf, "documents")
    return decontam.decontaminate_anchored(docs, _strings(spark, sf), "text", "doc_id").select("doc_id", "lang")


def _listed(spark, sf):
    """Two lists in order: even items first, then odd ones."""
    items = table(spark, sf, "benchmark")
    odd = F.col("item_id") % 2
    return items.select(
        F.when(odd == 0, "first").otherwise("second").alias("benchmark"),
        F.col("text").alias("string"),
        (odd * 1_000_000 + F.col("item_id")).alias("ord"),
    )


@query(
    "contamination_hits",
    """
    SELECT doc_id, min(ord) AS hit_ord, min_by(benchmark, ord) AS hit_benchmark, min_by(md5(b.text), ord) AS hit_md5
    FROM documents d JOIN (
      SELECT text, item_id % 2 * 1000000 + item_id AS ord,
             CASE WHEN item_id % 2 = 0 THEN 'first' ELSE 'second' END AS benchmark FROM benchmark) b
    ON contains(lower(d.text), lower(b.text)) GROUP BY doc_id
    """,
)
def contamination_hits(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    hits = decontam.contamination_hits(docs, _listed(spark, sf), "text", "ord")
    return hits.select("doc_id", "hit_ord", "hit_benchmark", F.md5("hit_string").alias("hit_md5"))


@query(
    "removal_report",
    f"""
    SELECT removed, total, removed * 100.0::DOUBLE / total AS percent FROM (
      SELECT count(*) FILTER (WHERE {_HIT}) AS removed, count(*) AS total FROM documents d)
    """,
)
def removal_report(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return decontam.removal_report(decontam.flag_contaminated(docs, _strings(spark, sf), "text", "doc_id"))


# ---- near duplicates ---------------------------------------------------------------------------

_HASHES = dedup.BANDS * dedup.ROWS


def minhash_sql(docs: str, n: int = dedup.NGRAM, hashes: int = _HASHES) -> str:
    """Common table expressions up to ``minima`` (doc_id, k, m)."""
    functions = ", ".join(
        f"({k}, {a}::HUGEINT, {b}::HUGEINT)" for k, (a, b) in enumerate(map(dedup.permutation, range(hashes)))
    )
    p = ngrams.PRIME
    powers = ", ".join(f"({e}, {pow(ngrams.BASE, e, p)}::HUGEINT)" for e in range(n))
    return f"""
      functions(k, a, b) AS (VALUES {functions}),
      powers(e, power) AS (VALUES {powers}),
      words AS (
        SELECT doc_id, generate_subscripts(w, 1) AS pos, len(w) AS len,
               ('0x' || substr(md5(unnest(w)), 1, 15))::HUGEINT AS h
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM {docs}) WHERE len(w) > 0),
      grams AS (
        SELECT s.doc_id, s.pos, w.h, least(s.len, {n}) - 1 - (w.pos - s.pos) AS e
        FROM words s JOIN words w ON w.doc_id = s.doc_id AND w.pos BETWEEN s.pos AND s.pos + {n - 1}
        WHERE s.pos <= greatest(s.len - {n - 1}, 1)),
      shingles AS (
        SELECT DISTINCT doc_id, sum(h * power % {p}) % {p} AS x
        FROM grams JOIN powers USING (e) GROUP BY doc_id, pos),
      minima AS (
        -- 2^61 is 1 modulo the prime, so the upper 61 bits of the product count as much as the lower ones.
        SELECT doc_id, k, min(((v & {p})::BIGINT + (v >> 61)::BIGINT) % {p}) AS m
        FROM (SELECT doc_id, k, x * a + b AS v FROM shingles, functions) GROUP BY doc_id, k)
    """


def clusters_sql(docs: str) -> str:
    """Common table expressions up to ``removed`` (doc_id, cluster)."""
    return f"""
      {minhash_sql(docs)},
      bands AS (
        SELECT doc_id, k // {dedup.ROWS} AS band, string_agg(m::VARCHAR, ',' ORDER BY k) AS key
        FROM minima GROUP BY 1, 2),
      edges AS (
        SELECT DISTINCT doc_id, hub FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY band, key) AS hub FROM bands)
        WHERE doc_id <> hub),
      reach(id, label) AS (
        SELECT doc_id, doc_id FROM edges UNION SELECT hub, hub FROM edges
        UNION SELECT e.b, r.label FROM reach r JOIN (
          SELECT doc_id AS a, hub AS b FROM edges UNION ALL SELECT hub, doc_id FROM edges) e ON e.a = r.id),
      removed AS (SELECT id AS doc_id, min(label) AS cluster FROM reach GROUP BY id HAVING min(label) <> id)
    """


@query(
    "minhash_signature",
    f"""
    WITH {minhash_sql('documents')}
    SELECT doc_id, md5(coalesce(string_agg(m::VARCHAR, ' ' ORDER BY k), '')) AS signature_md5
    FROM documents LEFT JOIN minima USING (doc_id) GROUP BY doc_id
    """,
)
def minhash_signature(spark, sf):
    signatures = dedup.minhash_signature(texts(spark, sf, "documents"), "text", "doc_id")
    return signatures.select("doc_id", F.md5(F.array_join("signature", " ")).alias("signature_md5"))


@query("band_edges", f"WITH RECURSIVE {clusters_sql('documents')} SELECT doc_id, hub FROM edges")
def band_edges(spark, sf):
    bands = dedup.document_bands(texts(spark, sf, "documents"), "text", "doc_id")
    return dedup.band_edges(dedup.band_keys(bands, "doc_id"), "doc_id")


@query("duplicate_clusters", f"WITH RECURSIVE {clusters_sql('documents')} SELECT doc_id, cluster FROM removed")
def duplicate_clusters(spark, sf):
    bands = dedup.document_bands(texts(spark, sf, "documents"), "text", "doc_id")
    return dedup.near_duplicates(bands, "doc_id")


@query(
    "keep_one_per_cluster",
    f"""
    WITH RECURSIVE {clusters_sql('documents')}
    SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM removed)
    """,
)
def keep_one_per_cluster(spark, sf):
    kept = dedup.keep_one_per_cluster(texts(spark, sf, "documents"), "text", "doc_id")
    return kept.select("doc_id", "source", F.md5("text").alias("text_md5"))


@query(
    "dedup_report",
    f"""
    WITH RECURSIVE {clusters_sql('documents')},
    flagged AS (SELECT len({PIECES_SQL}) AS n, doc_id NOT IN (SELECT doc_id FROM removed) AS keep FROM documents)
    SELECT count(*) AS docs_before, count(*) FILTER (WHERE keep) AS docs_after, sum(n)::BIGINT AS tokens_before,
           sum(n) FILTER (WHERE keep)::BIGINT AS tokens_after FROM flagged
    """,
)
def dedup_report(spark, sf):
    # Tokens are counted before the join, so that texts stay out of it.
    docs = texts(spark, sf, "documents").withColumn("n_tokens", tokens.token_length("text"))
    return dedup.dedup_report(dedup.flag_duplicates(docs, "text", "doc_id"), F.col("n_tokens"))


@query(
    "verify_jaccard",
    rf"""
    WITH RECURSIVE {clusters_sql('documents')},
    lists AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents),
    grams5 AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM lists WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams5 GROUP BY doc_id),
    shared AS (
      SELECT e.doc_id, e.hub, count(*) AS both_have FROM edges e
      JOIN grams5 a ON a.doc_id = e.doc_id JOIN grams5 b ON b.doc_id = e.hub AND b.g = a.g GROUP BY e.doc_id, e.hub)
    SELECT s.doc_id, hub, both_have / (a.n + b.n - both_have) AS jaccard FROM shared s
    JOIN sizes a ON a.doc_id = s.doc_id JOIN sizes b ON b.doc_id = s.hub
    WHERE both_have / (a.n + b.n - both_have) >= 0.8
    """,
)
def verify_jaccard(spark, sf):
    docs = texts(spark, sf, "documents")
    bands = dedup.document_bands(docs, "text", "doc_id")
    edges = dedup.band_edges(dedup.band_keys(bands, "doc_id"), "doc_id")
    return dedup.verify_jaccard(edges, docs, "text", "doc_id", 0.8)


@query(
    "clean_corpus",
    f"""
    WITH RECURSIVE scored AS (
      SELECT doc_id, source, text FROM documents d
      WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality >= 1) AND NOT {_HIT}),
    {clusters_sql('scored')}
    SELECT source, count(*) AS docs, sum(len({PIECES_SQL}))::BIGINT AS tokens FROM scored
    WHERE doc_id NOT IN (SELECT doc_id FROM removed) GROUP BY source
    """,
)
def clean_corpus_query(spark, sf):
    docs, labels = texts(spark, sf, "documents"), table(spark, sf, "labels")
    clean = clean_corpus(docs, labels, _strings(spark, sf), least=1)
    return tokens.count_tokens(clean, tokens.token_length("text"), ["source"])
