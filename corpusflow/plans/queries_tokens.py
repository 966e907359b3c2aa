"""Queries on tokens, shards, weights and mixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.numbers import round_half_even
from corpusflow.operators import audit, generations, mixture, tokens
from corpusflow.operators.rows import merge_shuffled
from corpusflow.plans.corpus import listed_manifest, weighted_manifest, with_shard
from corpusflow.plans.registry import in_order, query, table, texts
from corpusflow.session import checkpointed, scratch_path
from corpusflow.sources import readers, sinks

PIECES_SQL = r"regexp_extract_all(text, '\p{L}+|\p{N}|[^\s\p{L}\p{N}]+')"
EOD = 0

# ---- tokens ------------------------------------------------------------------------------------

_VOCAB = (
    "SELECT token, n, row_number() OVER (ORDER BY n DESC, token) - 1 AS id FROM ("
    f"SELECT token, count(*) AS n FROM (SELECT unnest({PIECES_SQL}) AS token FROM documents) GROUP BY token)"
)

_ENCODED = f"""
  SELECT doc_id, string_agg(coalesce(id, -1)::VARCHAR, ' ' ORDER BY pos) AS tokens FROM (
    SELECT doc_id, unnest({PIECES_SQL}) AS token, generate_subscripts({PIECES_SQL}, 1) AS pos FROM documents)
  LEFT JOIN (SELECT token, id FROM ({_VOCAB})) USING (token)
  GROUP BY doc_id
"""


@query("build_vocab", _VOCAB)
def build_vocab(spark, sf):
    return tokens.build_vocab(texts(spark, sf, "documents"), "text")


def _encoded(spark, sf, **options):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    vocab = tokens.build_vocab(docs, "text")
    return tokens.encode(docs, "text", vocab, "doc_id", **options)


@query(
    "tokenize",
    f"SELECT doc_id, md5(coalesce(e.tokens, '')) AS tokens_md5 FROM documents LEFT JOIN ({_ENCODED}) e USING (doc_id)",
)
def tokenize(spark, sf):
    encoded = _encoded(spark, sf)
    return encoded.select("doc_id", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query(
    "tokenize_joined",
    f"SELECT doc_id, md5(coalesce(e.tokens, '')) AS tokens_md5 FROM documents LEFT JOIN ({_ENCODED}) e USING (doc_id)",
)
def tokenize_joined(spark, sf):
    encoded = _encoded(spark, sf, max_rows=1)
    return encoded.select("doc_id", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query(
    "append_eod",
    f"""
    SELECT doc_id, md5(concat_ws(' ', e.tokens, '{EOD}')) AS tokens_md5
    FROM documents LEFT JOIN ({_ENCODED}) e USING (doc_id)
    """,
)
def append_eod(spark, sf):
    encoded = _encoded(spark, sf).withColumn("tokens", tokens.append_eod("tokens", EOD))
    return encoded.select("doc_id", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("token_length", f"SELECT doc_id, len({PIECES_SQL}) AS token_length FROM documents")
def token_length(spark, sf):
    docs = texts(spark, sf, "documents")
    return docs.select("doc_id", tokens.token_length("text").alias("token_length"))


@query(
    "count_tokens",
    f"""
    SELECT source, lang, count(*) AS docs, sum(len({PIECES_SQL}))::BIGINT AS tokens
    FROM documents GROUP BY source, lang
    """,
)
def count_tokens(spark, sf):
    return tokens.count_tokens(texts(spark, sf, "documents"), tokens.token_length("text"), ["source", "lang"])


@query(
    "throughput",
    f"""
    SELECT sum(len({PIECES_SQL}))::BIGINT AS tokens, sum(len({PIECES_SQL})) / 12.5 AS tokens_per_second
    FROM conversations
    """,
)
def throughput(spark, sf):
    said = table(spark, sf, "conversations")
    return tokens.throughput(said.select(tokens.token_length("text").alias("n")), "n", 12.5)


_BEFORE = f"""
  SELECT doc_id, source, n, sum(n) OVER (ORDER BY md5('1:' || doc_id), doc_id)::BIGINT - n AS before,
         sum(n) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT - n AS before_in_source
  FROM (SELECT doc_id, source, len({PIECES_SQL}) AS n FROM documents)
"""


def _sized(spark, sf):
    docs = texts(spark, sf, "documents")
    # Texts are cut into tokens once; positions need the sizes only.
    return checkpointed(docs.select("doc_id", "source", tokens.token_length("text").alias("n")))


@query("files_by_max_tokens", f"SELECT doc_id, n, before // 10000 AS file FROM ({_BEFORE})")
def files_by_max_tokens(spark, sf):
    shuffled = _sized(spark, sf).withColumn("digest", F.md5(F.concat(F.lit("1:"), F.col("doc_id").cast("string"))))
    placed = tokens.files_by_max_tokens(shuffled, "n", 10_000, ["digest", "doc_id"])
    return placed.select("doc_id", "n", "file")


@query(
    "skip_and_cap_tokens",
    f"SELECT doc_id, source, n FROM ({_BEFORE}) WHERE before_in_source >= 1000 AND before_in_source < 9000",
)
def skip_and_cap_tokens(spark, sf):
    return tokens.skip_and_cap_tokens(_sized(spark, sf), "n", ["doc_id"], ["source"], skip=1000, cap=8000)


def _packed_sql(length: int, extra: int) -> str:
    second = "" if not extra else (
        f" UNION ALL SELECT place // {length} - 1, place, token FROM numbered WHERE place % {length} = 0 AND place > 0"
    )
    return f"""
      WITH pieces AS (
        SELECT doc_id, unnest({PIECES_SQL}) AS token, generate_subscripts({PIECES_SQL}, 1) AS pos FROM documents),
      numbered AS (SELECT token, row_number() OVER (ORDER BY doc_id, pos) - 1 AS place FROM pieces),
      placed AS (SELECT place // {length} AS seq, place, token FROM numbered{second})
      SELECT seq, md5(string_agg(token, ' ' ORDER BY place)) AS tokens_md5 FROM placed
      GROUP BY seq HAVING count(*) = {length + extra}
    """


def _packed(spark, sf, plus_one):
    docs = checkpointed(texts(spark, sf, "documents").select("doc_id", tokens.pieces("text").alias("tokens")))
    packed = tokens.pack_sequences(docs, "tokens", 512, ["doc_id"], plus_one=plus_one)
    return packed.select("seq", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("pack_sequences", _packed_sql(512, 1))
def pack_sequences(spark, sf):
    return _packed(spark, sf, True)


@query("pack_sequences_exact", _packed_sql(512, 0))
def pack_sequences_exact(spark, sf):
    return _packed(spark, sf, False)


@query(
    "merge_tokenized",
    f"""
    SELECT id, kind, md5(tokens) AS tokens_md5, row_number() OVER (ORDER BY md5('3:' || id || ':' || kind), id, kind) - 1 AS position FROM (
      SELECT doc_id AS id, 'documents' AS kind, array_to_string({PIECES_SQL}, ' ') AS tokens FROM documents
      UNION ALL SELECT item_id, 'benchmark', array_to_string({PIECES_SQL}, ' ') FROM benchmark)
    """,
)
def merge_tokenized(spark, sf):
    def part(name, key):
        return table(spark, sf, name).select(
            F.col(key).alias("id"), F.lit(name).alias("kind"), tokens.pieces("text").alias("tokens")
        )

    merged = merge_shuffled([part("documents", "doc_id"), part("benchmark", "item_id")], 3, ["id", "kind"])
    return in_order(merged.select("id", "kind", F.md5(F.array_join("tokens", " ")).alias("tokens_md5")))


# ---- shards and weights ------------------------------------------------------------------------

# Shards of the test tables hold thousands of tokens, not billions.
UNIT = 1e3

_SHARDS = f"""
  SELECT source, shard, bytes, round_even(bytes / 2000.0::DOUBLE * 100, 0) / 100 AS weight FROM (
    SELECT source, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 4 AS shard,
           (sum(len({PIECES_SQL})) * 2)::BIGINT AS bytes
    FROM documents GROUP BY 1, 2)
"""


def _sharded(spark, sf):
    return with_shard(texts(spark, sf, "documents"), 4)


def _shards(spark, sf):
    return mixture.shard_size(_sharded(spark, sf), tokens.token_length("text"), unit=UNIT)


@query("shard_size", _SHARDS)
def shard_size(spark, sf):
    return _shards(spark, sf)


@query(
    "source_stats",
    f"""
    SELECT source, count(*) AS n_shards, round(sum(bytes) / 1000.0, 6) AS total_size,
      round(sum(bytes) / 2000.0, 6) AS total_tokens, round(avg(bytes) / 2000.0, 6) AS avg_tokens_per_shard,
      round(stddev_pop(bytes / 1000.0), 6) AS std_shard_size, round(avg(bytes) / 1000.0, 6) AS avg_shard_size,
      round(min_by(bytes, shard) / 1000.0, 6) AS first_shard_size,
      round(CASE source WHEN 'src3' THEN 1.5 ELSE sum(bytes) / 2000.0 END, 6) AS used_tokens,
      round(abs(20 - sum(bytes) / 2000.0), 6) AS difference
    FROM ({_SHARDS}) GROUP BY source
    """,
)
def source_stats(spark, sf):
    shards = _shards(spark, sf)
    expected = shards.select("source").distinct().withColumn("expected_tokens", F.lit(20.0))
    used = spark.createDataFrame([("src3", 1.5)], "source string, used_tokens double")
    stats = mixture.source_stats(shards, expected, used, unit=UNIT).drop("expected_tokens")
    return stats.select(
        "source", "n_shards", *[F.round(c, 6).alias(c) for c in stats.columns if c not in ("source", "n_shards")]
    )


_OVERRIDES = {"src3": 1.0, "src5": 0.0, "src7": 3.0}
_OVERRIDES_SQL = "(VALUES ('src3', 1.0::DOUBLE), ('src5', 0.0), ('src7', 3.0)) o(source, override)"


@query("apply_overrides", f"SELECT s.source, shard, weight, override FROM ({_SHARDS}) s LEFT JOIN {_OVERRIDES_SQL} USING (source)")
def apply_overrides(spark, sf):
    shards = _shards(spark, sf).select("source", "shard", "weight")
    return mixture.apply_overrides(shards, _OVERRIDES)


@query(
    "weights_override_first_shard",
    f"""
    SELECT s.source, shard, coalesce(override, weight) AS weight
    FROM ({_SHARDS}) s LEFT JOIN {_OVERRIDES_SQL} USING (source) WHERE override IS NULL OR shard = 0
    """,
)
def weights_override_first_shard(spark, sf):
    return mixture.weights_override_first_shard(_shards(spark, sf), _OVERRIDES).select("source", "shard", "weight")


@query(
    "weights_override_scaled",
    f"""
    SELECT source, shard, CASE WHEN override IS NULL THEN weight
             ELSE round_even(weight * (override / total) * 100, 0) / 100 END AS weight
    FROM (SELECT s.source, shard, weight, override, sum(weight) OVER (PARTITION BY s.source) AS total
          FROM ({_SHARDS}) s LEFT JOIN {_OVERRIDES_SQL} USING (source))
    WHERE override IS NULL OR override <> 0
    """,
)
def weights_override_scaled(spark, sf):
    return mixture.weights_override_scaled(_shards(spark, sf), _OVERRIDES).select("source", "shard", "weight")


_PATH_SQL = (
    "(CASE source WHEN 'src1' THEN '/small' ELSE '/data' END) || '/' || source || '/' || source || '_' || shard"
    " || '/gpt2-preprocessed_content_document'"
)


@query("manifest_paths", f"SELECT source, shard, {_PATH_SQL} AS path, printf('%.2f', weight) AS weight_text FROM ({_SHARDS})")
def manifest_paths(spark, sf):
    return _shards(spark, sf).select(
        "source",
        "shard",
        mixture.manifest_path("/data", "source", "shard", {"src1": "/small"}).alias("path"),
        mixture.format_weight("weight").alias("weight_text"),
    )


@query(
    "render_manifest",
    f"""
    SELECT string_agg(printf('%.2f', weight) || ' ' || '/data/' || source || '/' || source || '_' || shard
             || '/gpt2-preprocessed_content_document', ' ' ORDER BY source, shard) AS manifest
    FROM (SELECT s.source, shard, coalesce(override, weight) AS weight
          FROM ({_SHARDS}) s LEFT JOIN {_OVERRIDES_SQL} USING (source) WHERE override IS NULL OR shard = 0)
    """,
)
def render_manifest(spark, sf):
    weights = weighted_manifest(_sharded(spark, sf), tokens.token_length("text"), _OVERRIDES, "/data", UNIT)
    return mixture.render_manifest(weights, ["source", "shard"])


@query(
    "write_manifest_line",
    f"""
    SELECT string_agg(printf('%.2f', weight) || ' ' || {_PATH_SQL}, ' ' ORDER BY source, shard) AS manifest FROM ({_SHARDS})
    """,
)
def write_manifest_line(spark, sf):
    path = scratch_path(spark, "manifest")
    entries = _shards(spark, sf).withColumn("path", mixture.manifest_path("/data", "source", "shard", {"src1": "/small"}))
    sinks.write_manifest_line(entries, ["source", "shard"], path)
    return spark.read.text(path).toDF("manifest")


@query(
    "manifest_lines",
    f"""
    WITH e AS (SELECT row_number() OVER (ORDER BY source, shard) - 1 AS ord, weight, {_PATH_SQL} AS path FROM ({_SHARDS}))
    SELECT ord * 2 AS line, '- ' || printf('%.2f', weight) AS text FROM e
    UNION ALL SELECT ord * 2 + 1, '- ' || path FROM e
    """,
)
def manifest_lines(spark, sf):
    path = mixture.manifest_path("/data", "source", "shard", {"src1": "/small"})
    return mixture.manifest_lines(_shards(spark, sf).withColumn("path", path), ["source", "shard"])


_EXPECTED = "SELECT source, unnest(range(5)) AS shard FROM (SELECT DISTINCT source FROM documents)"


def _expected(spark, sf):
    from corpusflow.operators.rows import expand_shards

    sources = texts(spark, sf, "documents").select("source").distinct().withColumn("n", F.lit(5))
    return expand_shards(sources, "n").select("source", "shard")


@query("missing_shards", f"SELECT source, shard FROM ({_EXPECTED}) EXCEPT SELECT source, shard FROM ({_SHARDS})")
def missing_shards(spark, sf):
    return audit.missing_shards(_expected(spark, sf), _shards(spark, sf), ["source", "shard"])


@query(
    "shard_audit",
    f"""
    SELECT source, shard, bytes, CASE WHEN bytes IS NULL THEN 'Empty'
      WHEN bytes < 0.8 * (SELECT median(bytes) FROM ({_SHARDS})) THEN 'small' ELSE 'ok' END AS status
    FROM ({_EXPECTED}) LEFT JOIN (SELECT source, shard, bytes FROM ({_SHARDS})) USING (source, shard)
    """,
)
def shard_audit(spark, sf):
    sizes = _shards(spark, sf).select("source", "shard", "bytes")
    return audit.shard_audit(_expected(spark, sf), sizes, small=0.8)


# ---- mixtures ----------------------------------------------------------------------------------

# A weight per source: the sum of the lengths of its documents.
_WEIGHTS = "SELECT source, sum(n_chars)::BIGINT AS weight, count(*) AS size FROM documents GROUP BY source"
_QUOTAS = f"""
  SELECT source, size, base + CASE WHEN row_number() OVER (ORDER BY exact - base DESC, source) <= left_over
           THEN 1 ELSE 0 END AS quota
  FROM (SELECT *, {{n}} - sum(base) OVER () AS left_over FROM (
    SELECT *, floor(exact)::BIGINT AS base FROM (
      SELECT *, weight::DOUBLE / (sum(weight) OVER ())::DOUBLE * {{n}} AS exact FROM ({_WEIGHTS}))))
"""


def _weights(spark, sf):
    return texts(spark, sf, "documents").groupBy("source").agg(F.sum("n_chars").alias("weight"))


@query(
    "normalize_weights",
    f"SELECT source, weight, weight::DOUBLE / (sum(weight) OVER ())::DOUBLE AS share FROM ({_WEIGHTS})",
)
def normalize_weights(spark, sf):
    return mixture.normalize_weights(_weights(spark, sf))


@query("quotas", f"SELECT source, quota::BIGINT AS quota FROM ({_QUOTAS.format(n=2500)})")
def quotas(spark, sf):
    return mixture.quotas(_weights(spark, sf), 2500)


_MIXED = f"""
  SELECT doc_id, source, copy, copy * size + rank AS place FROM (
    SELECT *, unnest(range((quota // size + CASE WHEN rank < quota % size THEN 1 ELSE 0 END)::BIGINT)) AS copy
    FROM (SELECT doc_id, source, size, quota::BIGINT AS quota,
                 row_number() OVER (PARTITION BY source ORDER BY md5('5:' || doc_id), doc_id) - 1 AS rank
          FROM documents JOIN ({_QUOTAS.format(n=2500)}) USING (source)))
"""


def _mixed(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "source")
    return mixture.mix(docs, _weights(spark, sf), 2500, 5, ["doc_id"])


@query("mix", _MIXED)
def mix(spark, sf):
    return _mixed(spark, sf)


@query(
    "interleave",
    f"""
    SELECT doc_id, source, copy, row_number() OVER (ORDER BY (place + 0.5::DOUBLE) / share, source, place) - 1 AS position
    FROM ({_MIXED}) JOIN (SELECT source, weight::DOUBLE / (sum(weight) OVER ())::DOUBLE AS share FROM ({_WEIGHTS}))
    USING (source)
    """,
)
def interleave(spark, sf):
    shares = mixture.normalize_weights(_weights(spark, sf))
    return mixture.interleave(_mixed(spark, sf), shares).select("doc_id", "source", "copy", "position")


@query(
    "epochs",
    f"""
    SELECT source, round(share * 1000000 / tokens, 9) AS epochs
    FROM (SELECT source, weight::DOUBLE / (sum(weight) OVER ())::DOUBLE AS share FROM ({_WEIGHTS}))
    JOIN (SELECT source, sum(len({PIECES_SQL})) AS tokens FROM documents GROUP BY source) USING (source)
    """,
)
def epochs(spark, sf):
    shares = mixture.normalize_weights(_weights(spark, sf))
    sizes = tokens.count_tokens(texts(spark, sf, "documents"), tokens.token_length("text"), ["source"])
    seen = mixture.epochs(shares, sizes, 1e6)
    return seen.select("source", F.round("epochs", 9).alias("epochs"))


@query(
    "pass_at_k",
    """
    SELECT lang, count(*) AS problems, round(avg(c / n), 9) AS pass_at_1,
      round(avg(CASE WHEN n < 3 THEN NULL WHEN n - c < 3 THEN 1.0 ELSE
        1 - (n - c) * (n - c - 1.0) * (n - c - 2) / (n * (n - 1.0) * (n - 2)) END), 9) AS pass_at_3
    FROM (SELECT lang, source, count(*) AS n, sum(quality) AS c
          FROM documents JOIN labels USING (doc_id) GROUP BY lang, source)
    GROUP BY lang
    """,
)
def pass_at_k(spark, sf):
    tried = texts(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    rates = generations.pass_rates(tried, ["source"], F.col("quality") == 1, (1, 3), ["lang"])
    return rates.select("lang", "problems", *[F.round(c, 9).alias(c) for c in ("pass_at_1", "pass_at_3")])


@query("round_half_even", "SELECT doc_id, round_even(n_chars / 2000.0::DOUBLE * 100, 0) / 100 AS rounded FROM documents")
def round_half_even_query(spark, sf):
    return texts(spark, sf, "documents").select("doc_id", round_half_even(F.col("n_chars") / 2000.0).alias("rounded"))


# ---- from a listing of files -------------------------------------------------------------------

# The shards of the documents as text files, one per shard, of which only names and sizes are used.
# The fifth shard of every source is missing.
LISTED_UNIT = 1e4
_LISTED = f"""
  SELECT source, shard, coalesce(b, 0)::BIGINT AS bytes, round_even(coalesce(b, 0) / 20000.0::DOUBLE * 100, 0) / 100 AS weight
  FROM ({_EXPECTED}) LEFT JOIN (
    SELECT source, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 4 AS shard, sum(strlen(text) + 1) AS b
    FROM documents GROUP BY 1, 2) USING (source, shard)
"""
_LAYOUT = {"layout": "source={source}/shard={shard}", "suffix": ".txt", "unit": LISTED_UNIT}


def _listing(spark, sf):
    """(files, sources)"""
    path = scratch_path(spark, "listed")
    docs = _sharded(spark, sf).select("source", "shard", "text")
    docs.repartition("source", "shard").write.partitionBy("source", "shard").text(path)
    sources = docs.select("source").distinct().withColumn("n_shards", F.lit(5))
    return readers.list_files(spark, path), checkpointed(sources)


@query("listed_shard_sizes", _LISTED)
def listed_shard_sizes(spark, sf):
    files, sources = _listing(spark, sf)
    return mixture.listed_shard_sizes(files, sources, **_LAYOUT)


_LISTED_WEIGHTS = f"""
  SELECT source, shard, CASE WHEN override IS NULL THEN weight ELSE round_even(weight * (override / total) * 100, 0) / 100 END AS weight,
    {_PATH_SQL} AS path
  FROM (SELECT s.source, shard, weight, override, sum(weight) OVER (PARTITION BY s.source) AS total
        FROM ({_LISTED}) s LEFT JOIN {_OVERRIDES_SQL} USING (source)) WHERE override IS NULL OR override <> 0
"""


@query("listed_weights_scaled", _LISTED_WEIGHTS)
def listed_weights_scaled(spark, sf):
    return listed_manifest(*_listing(spark, sf), _OVERRIDES, "/data", other_bases={"src1": "/small"}, **_LAYOUT)


@query(
    "listed_manifest_scaled",
    f"SELECT string_agg(printf('%.2f', weight) || ' ' || path, ' ' ORDER BY source, shard) AS manifest FROM ({_LISTED_WEIGHTS})",
)
def listed_manifest_scaled(spark, sf):
    weights = listed_manifest(*_listing(spark, sf), _OVERRIDES, "/data", other_bases={"src1": "/small"}, **_LAYOUT)
    return mixture.render_manifest(weights, ["source", "shard"])


@query(
    "listed_weights_first_shard",
    f"""
    SELECT source, shard, coalesce(override, weight) AS weight, {_PATH_SQL} AS path
    FROM ({_LISTED}) LEFT JOIN {_OVERRIDES_SQL} USING (source) WHERE override IS NULL OR shard = 0
    """,
)
def listed_weights_first_shard(spark, sf):
    return listed_manifest(*_listing(spark, sf), _OVERRIDES, "/data", "first_shard", {"src1": "/small"}, **_LAYOUT)


@query(
    "listed_shard_audit",
    f"""
    SELECT source, shard, CASE WHEN bytes > 0 THEN bytes END AS bytes, CASE WHEN bytes = 0 THEN 'Empty'
      WHEN bytes < 0.8 * (SELECT median(bytes) FROM ({_LISTED}) WHERE bytes > 0) THEN 'small' ELSE 'ok' END AS status
    FROM ({_LISTED})
    """,
)
def listed_shard_audit(spark, sf):
    files, sources = _listing(spark, sf)
    sizes = checkpointed(mixture.listed_shard_sizes(files, sources, **_LAYOUT))
    return audit.shard_audit(sizes.select("source", "shard"), sizes.select("source", "shard", "bytes"), small=0.8)
