"""Queries on rows: reading, writing, filtering, ordering, positions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F


from corpusflow.functions.text import extract_delimited, number_in
from corpusflow.operators import audit, grid, index, rows
from corpusflow.plans.registry import in_order, query, table
from corpusflow.session import scratch_path
from corpusflow.sources import readers, sinks

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# ---- sources and sinks -------------------------------------------------------------------------


@query(
    "read_jsonl",
    "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents",
)
def read_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    sinks.write_jsonl(table(spark, sf, "documents"), path)
    back = readers.read_jsonl(spark, path, DOCS)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


@query("read_parquet_glob", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def read_parquet_glob(spark, sf):
    pages = readers.read_parquet_glob(spark, sf, "pages*.parquet", text_key="html")
    return pages.select("page_id", "url", F.length("text").cast("long").alias("n_chars"))


@query(
    "read_dataset",
    "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations",
)
def read_dataset(spark, sf):
    path = scratch_path(spark, "dataset")
    turns = table(spark, sf, "conversations").withColumnRenamed("text", "completion")
    turns.write.parquet(f"{path}/train")
    back = readers.read_dataset(spark, path, split="train", text_key="completion")
    return back.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


@query("read_subset", "SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE lang = 'fr'")
def read_subset(spark, sf):
    path = scratch_path(spark, "subsets")
    table(spark, sf, "documents").write.partitionBy("lang").parquet(path)
    return readers.read_subset(spark, path, "fr").select("doc_id", "source", F.md5("text").alias("text_md5"))


@query(
    "read_csv_table",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def read_csv_table(spark, sf):
    path = scratch_path(spark, "csv")
    part = table(spark, sf, "part")
    part.write.option("header", True).csv(path)
    return readers.read_csv_table(spark, path, part.schema)


@query(
    "read_sources",
    """
    SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars FROM (
      SELECT 'documents' AS source, text FROM documents
      UNION ALL SELECT 'pages', html FROM pages
      UNION ALL SELECT 'benchmark', text FROM benchmark
      UNION ALL SELECT 'conversations', text FROM conversations)
    GROUP BY source
    """,
)
def read_sources(spark, sf):
    families = [
        [readers.Source("documents", f"{sf}/documents.parquet", "text")],
        [readers.Source("pages", sf, "html", subset="pages.parquet")],
        [
            readers.Source("benchmark", f"{sf}/benchmark.parquet", "text"),
            readers.Source("conversations", f"{sf}/conversations.parquet", "text"),
        ],
    ]
    texts = readers.read_sources(spark, [s for family in families for s in family])
    return texts.groupBy("source").agg(
        F.count("*").alias("n"), F.sum(F.length("text").cast("long")).alias("chars")
    )


@query(
    "source_catalog",
    """
    SELECT 'lang=' || lang AS name, '/base' AS path, 'lang=' || lang AS subset, '/out/lang=' || lang AS output, 'text' AS text_column
    FROM (SELECT DISTINCT lang FROM documents)
    UNION ALL
    SELECT 'docs_' || i, '/jsonl/docs-' || printf('%05d', i) || '-of-00004.jsonl', NULL, '/out/docs_' || i, 'content' FROM range(4) t(i)
    """,
)
def source_catalog(spark, sf):
    path = scratch_path(spark, "folders")
    table(spark, sf, "documents").write.partitionBy("lang").parquet(path)
    families = [
        readers.folder_sources(spark, path, "text"), readers.sharded_sources("/jsonl/docs", 4, "docs", "content")
    ]
    catalog = readers.source_catalog(spark, families, "/out/")
    # The folder is another one in every run.
    return catalog.withColumn("path", F.replace("path", F.lit(path), F.lit("/base")))


_FILES = """
  SELECT doc_id, lang, source, source || '/' || lang || '/' || lpad(doc_id::VARCHAR, 9, '0')
         || CASE WHEN doc_id % 3 = 0 THEN '.json' WHEN doc_id % 3 = 1 THEN '.ds' ELSE '.txt' END AS path,
         source || '/' || lang AS folder
  FROM documents
"""


def _files(spark, sf):
    """A listing with one file per document."""
    docs = table(spark, sf, "documents")
    suffix = F.when(F.col("doc_id") % 3 == 0, ".json").when(F.col("doc_id") % 3 == 1, ".ds").otherwise(".txt")
    name = F.concat(F.lpad(F.col("doc_id").cast("string"), 9, "0"), suffix)
    folder = F.concat_ws("/", "source", "lang")
    return docs.select(
        "doc_id", "lang", "source", F.concat_ws("/", folder, name).alias("path"), folder.alias("folder")
    )


@query(
    "first_file_per_folder",
    f"SELECT folder, min(path) AS path FROM ({_FILES}) WHERE path LIKE '%.json' GROUP BY folder",
)
def first_file_per_folder(spark, sf):
    return audit.first_file_per_folder(_files(spark, sf))


@query(
    "folders_without_file",
    f"SELECT folder FROM ({_FILES}) GROUP BY folder HAVING NOT bool_or(path LIKE '%00.json')",
)
def folders_without_file(spark, sf):
    return audit.folders_without_file(_files(spark, sf), suffix="00.json")


@query(
    "filter_files_by_pattern",
    f"SELECT doc_id, path FROM ({_FILES}) WHERE regexp_full_match(path, '.*\\.ds')",
)
def filter_files_by_pattern(spark, sf):
    return audit.filter_files_by_pattern(_files(spark, sf), r".*\.ds$").select("doc_id", "path")


@query("write_jsonl_by_shard", "SELECT source AS shard, doc_id, md5(text) AS text_md5 FROM documents")
def write_jsonl_by_shard(spark, sf):
    path = scratch_path(spark, "by-shard")
    docs = table(spark, sf, "documents").withColumnRenamed("source", "shard")
    sinks.write_jsonl(docs, path, shard="shard", order=["doc_id"])
    back = spark.read.schema("doc_id bigint, text string, shard string").json(path)
    return back.select("shard", "doc_id", F.md5("text").alias("text_md5"))


@query("write_parquet_by_rank", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def write_parquet_by_rank(spark, sf):
    path = scratch_path(spark, "ranks")
    sinks.write_parquet_by_rank(table(spark, sf, "documents"), path, 4)
    return spark.read.parquet(f"{path}/data").select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "write_kept_and_removed",
    "SELECT quality >= 1 AS keep, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM labels GROUP BY 1",
)
def write_kept_and_removed(spark, sf):
    path = scratch_path(spark, "sides")
    flagged = table(spark, sf, "labels").withColumn("keep", F.col("quality") >= 1)
    sinks.write_kept_and_removed(flagged, path)
    back = spark.read.schema("doc_id bigint, quality int, toxic int, keep boolean").json(path)
    return back.groupBy("keep").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query("write_text_per_row", "SELECT item_id, text FROM benchmark")
def write_text_per_row(spark, sf):
    path = scratch_path(spark, "texts")
    sinks.write_text_per_row(table(spark, sf, "benchmark"), path, "item_id", "text")
    back = spark.read.schema("value string, item_id bigint").text(path, wholetext=True)
    # A text file ends with one line end of its own.
    return back.select("item_id", F.expr("left(value, length(value) - 1)").alias("text"))


# ---- rows --------------------------------------------------------------------------------------


@query("keep_only", "SELECT text AS content FROM documents")
def keep_only(spark, sf):
    return rows.keep_only(table(spark, sf, "documents"), "text", "content")


@query("filter_min_score", "SELECT doc_id, quality, toxic FROM labels WHERE quality >= 1")
def filter_min_score(spark, sf):
    return rows.filter_min_score(table(spark, sf, "labels"), "quality", 1)


@query("filter_rows", "SELECT doc_id, lang, n_chars FROM documents WHERE n_chars > 500 AND lang <> 'en'")
def filter_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return rows.filter_rows(docs, (F.col("n_chars") > 500) & (F.col("lang") != "en"))


@query("filter_rows_function", "SELECT doc_id, lang, n_chars FROM documents WHERE n_chars > 500 AND lang <> 'en'")
def filter_rows_function(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")

    def wanted(batch: pd.DataFrame) -> pd.Series:
        return (batch["n_chars"] > 500) & (batch["lang"] != "en")

    return rows.filter_rows(docs, wanted, ["n_chars", "lang"])


@query(
    "strip_non_empty",
    r"""
    SELECT doc_id, text FROM (
      SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS text FROM documents)
    WHERE length(text) > 0
    """,
)
def strip_non_empty(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    return rows.strip_non_empty(lines, "text")


@query("exclude_values", "SELECT doc_id, lang FROM documents WHERE lang NOT IN ('de', 'es')")
def exclude_values(spark, sf):
    return rows.exclude_values(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["de", "es"])


@query(
    "exclude_values_table",
    "SELECT doc_id, source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE n_chars > 20000)",
)
def exclude_values_table(spark, sf):
    docs = table(spark, sf, "documents")
    listed = docs.where("n_chars > 20000").select("source").distinct()
    return rows.exclude_values(docs.select("doc_id", "source"), "source", listed)


@query(
    "extract_delimited",
    r"""
    SELECT item_id,
           CASE WHEN item_id % 5 < 3 THEN trim(text, ' ' || chr(10)) END AS value,
           CASE WHEN item_id % 5 < 3 THEN 'ok' WHEN item_id % 5 = 3 THEN 'bad_markers' ELSE 'no_marker' END AS status
    FROM benchmark
    """,
)
def extract_delimited_query(spark, sf):
    item, text = F.col("item_id"), F.col("text")
    two, one = F.lit('"""'), F.lit("'''")
    prompt = (
        F.when(item % 5 == 0, F.concat(F.lit("def f():\n    "), two, F.lit("\n "), text, F.lit("\n    "), two))
        .when(item % 5 == 1, F.concat(two, F.lit("helper"), two, F.lit("\ndef g():\n"), two, text, two))
        .when(item % 5 == 2, F.concat(F.lit("def h():\n"), one, text, one, F.lit("\n")))
        .when(item % 5 == 3, F.concat(F.lit("def i():\n"), two, text))
        .otherwise(text)
    )
    found = table(spark, sf, "benchmark").select("item_id", extract_delimited(prompt).alias("_d"))
    return found.select("item_id", "_d.value", "_d.status")


@query(
    "iteration_filter",
    """
    SELECT o_orderkey || '_step' AS name, o_orderkey AS iteration FROM orders
    WHERE o_orderkey > 0 AND o_orderkey % 100 = 0
    """,
)
def iteration_filter(spark, sf):
    named = table(spark, sf, "orders").select(F.concat(F.col("o_orderkey").cast("string"), F.lit("_step")).alias("name"))
    return rows.iteration_filter(named, "name", 100)


@query(
    "sort_numeric",
    """
    SELECT c_name, number, row_number() OVER (ORDER BY number, c_name) - 1 AS position
    FROM (SELECT c_name, regexp_extract(c_name, '(\\d+)', 1)::BIGINT AS number FROM customer)
    """,
)
def sort_numeric(spark, sf):
    named = table(spark, sf, "customer").select("c_name", number_in("c_name").alias("number"))
    return in_order(rows.sort_numeric(named, "c_name"))


@query("distinct_sources", "SELECT DISTINCT source, lang FROM documents")
def distinct_sources(spark, sf):
    return rows.distinct_sources(table(spark, sf, "documents").select("source", "lang"), ["source", "lang"])


@query(
    "index_range",
    """
    SELECT doc_id, n_chars, index FROM (
      SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS index FROM documents)
    WHERE index BETWEEN 100 AND 300
    """,
)
def index_range(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return index.index_range(docs, ["n_chars", "doc_id"], 100, 300)


@query("remove_ids", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def remove_ids(spark, sf):
    from corpusflow.operators.dedup import remove_ids as remove

    toxic = table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    return remove(table(spark, sf, "documents").select("doc_id", "source"), toxic, "doc_id")


# ---- grid --------------------------------------------------------------------------------------

_GRID = """
  SELECT p_partkey AS index, p_retailprice AS param_count, p_size AS compute,
         p_partkey * 37 AS training_iters FROM part
"""


def _grid(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("index"),
        F.col("p_retailprice").alias("param_count"),
        F.col("p_size").alias("compute"),
        (F.col("p_partkey") * 37).alias("training_iters"),
    )


@query(
    "tier_by_threshold",
    """
    SELECT doc_id, n_chars,
      CASE WHEN n_chars > 2000 THEN 4 WHEN n_chars > 1000 THEN 8 WHEN n_chars > 210 THEN 16
           WHEN n_chars > 50 THEN 32 ELSE 64 END AS tier,
      CASE WHEN n_chars > 2000 THEN 4 WHEN n_chars > 1000 THEN 8 WHEN n_chars > 210 THEN 16
           ELSE 32 END AS tier_nodes
    FROM documents
    """,
)
def tier_by_threshold(spark, sf):
    from corpusflow.functions import numbers

    return table(spark, sf, "documents").select(
        "doc_id",
        "n_chars",
        numbers.tier_by_threshold("n_chars", numbers.MICRO_BATCH_TIERS, numbers.MICRO_BATCH_DEFAULT).alias("tier"),
        numbers.tier_by_threshold(
            "n_chars", numbers.MICRO_BATCH_TIERS_NODES, numbers.MICRO_BATCH_DEFAULT_NODES
        ).alias("tier_nodes"),
    )


@query(
    "derive_run_columns",
    f"""
    SELECT index, micro_batch, identifier,
      'run_' || identifier || '_bs' || micro_batch || '_idx_' || index AS run_name,
      (greatest(round_even((training_iters // 5) / 1000.0, 0), 1) * 1000)::BIGINT AS save_interval
    FROM (SELECT *, param_count::VARCHAR || 'M_' || compute AS identifier,
            CASE WHEN param_count > 2000 THEN 4 WHEN param_count > 1000 THEN 8 WHEN param_count > 210 THEN 16
                 WHEN param_count > 50 THEN 32 ELSE 64 END AS micro_batch
          FROM ({_GRID}))
    """,
)
def derive_run_columns(spark, sf):
    return grid.derive_run_columns(_grid(spark, sf)).select(
        "index", "micro_batch", "identifier", "run_name", "save_interval"
    )


@query(
    "token_budget",
    f"""
    SELECT index, 256::BIGINT * 4 * compute * 2048 AS step_tokens,
           256::BIGINT * 4 * compute * 2048 * training_iters AS total_tokens
    FROM ({_GRID})
    """,
)
def token_budget(spark, sf):
    budget = grid.token_budget(_grid(spark, sf), 256, 4, "compute", 2048, "training_iters")
    return budget.select("index", "step_tokens", "total_tokens")


@query(
    "derive_grid",
    """
    SELECT o_orderkey, training_iters, least(1000, training_iters // 10) AS lr_warmup_iters
    FROM (SELECT o_orderkey, floor(o_totalprice * 1000 / (128.0 * (1 + o_custkey % 7)))::BIGINT AS training_iters
          FROM orders)
    """,
)
def derive_grid(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") * 1000).alias("training_tokens"),
        (F.lit(128.0) * (1 + F.col("o_custkey") % 7)).alias("batch_size_tokens"),
    )
    return grid.derive_grid(orders).select("o_orderkey", "training_iters", "lr_warmup_iters")


@query(
    "stage_of_step",
    """
    SELECT o_orderkey AS step,
      CASE WHEN o_orderkey >= 12000 THEN 'decay' WHEN o_orderkey >= 500 THEN 'stable'
           WHEN o_orderkey >= 1 THEN 'warmup' END AS name,
      CASE WHEN o_orderkey >= 12000 THEN 12000 WHEN o_orderkey >= 500 THEN 500
           WHEN o_orderkey >= 1 THEN 1 END::BIGINT AS start_training_step
    FROM orders
    """,
)
def stage_of_step(spark, sf):
    steps = table(spark, sf, "orders").select(F.col("o_orderkey").alias("step"))
    stages = spark.createDataFrame(
        [("warmup", 1), ("stable", 500), ("decay", 12000)], "name string, start_training_step bigint"
    )
    return grid.stage_of_step(steps, stages).select("step", "name", "start_training_step")


@query(
    "decay_start",
    "SELECT o_orderkey, o_orderkey - floor(o_orderkey * 0.2::DOUBLE)::BIGINT AS decay_start FROM orders",
)
def decay_start(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", grid.decay_start("o_orderkey", 20).alias("decay_start"))


# ---- positions and shards ----------------------------------------------------------------------


@query("global_index", "SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS index FROM lineitem")
def global_index(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    lines = table(spark, sf, "lineitem").select(*keys)
    return index.global_index(lines, keys, rows_per_bucket=10_000).select(
        "l_orderkey", "l_linenumber", "l_partkey", "index"
    )


@query("shard_contiguous", "SELECT doc_id, ntile(7) OVER (ORDER BY source, doc_id) - 1 AS shard FROM documents")
def shard_contiguous(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return index.shard_contiguous(docs, 7, ["source", "doc_id"]).select("doc_id", "shard")


@query(
    "shard_files_ceil",
    f"""
    SELECT path, ((row_number() OVER (ORDER BY path) - 1)
           // (SELECT ceil(count(*) / 7.0)::BIGINT FROM documents)) AS shard FROM ({_FILES})
    """,
)
def shard_files_ceil(spark, sf):
    return index.shard_files_ceil(_files(spark, sf).select("path"), 7, ["path"])


@query(
    "shard_files_floor",
    f"""
    SELECT lang, path, 20 + chunk * 6 + least(i // (files // 6), 5) AS shard FROM (
      SELECT lang, path, row_number() OVER (PARTITION BY lang ORDER BY path) - 1 AS i,
             count(*) OVER (PARTITION BY lang) AS files, dense_rank() OVER (ORDER BY lang) - 1 AS chunk
      FROM ({_FILES}))
    """,
)
def shard_files_floor(spark, sf):
    files = _files(spark, sf).select("lang", "path")
    return index.shard_files_floor(files, 6, "lang", ["path"], first_shard=20)


@query(
    "shard_name",
    """
    SELECT doc_id, printf('data-%05d-of-%05d.jsonl', shard, 7) AS file, 'data_' || shard AS folder, 'data' AS bare
    FROM (SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) - 1 AS shard FROM documents)
    """,
)
def shard_name(spark, sf):
    sharded = index.shard_contiguous(table(spark, sf, "documents").select("doc_id"), 7, ["doc_id"])
    return sharded.select(
        "doc_id",
        index.shard_name(F.lit("data"), "shard", 7).alias("file"),
        index.folder_name(F.lit("data"), "shard", 7).alias("folder"),
        index.folder_name(F.lit("data"), "shard", 1).alias("bare"),
    )


@query(
    "running_total",
    """
    SELECT source, rows, sum(rows) OVER (ORDER BY source)::BIGINT AS total_so_far
    FROM (SELECT source, count(*) AS rows FROM documents GROUP BY source)
    """,
)
def running_total(spark, sf):
    chunks = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("rows"))
    return index.running_total(chunks, ["source"], "rows")


@query(
    "last_n_per_group",
    """
    SELECT user_id, event_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r <= 30
    """,
)
def last_n_per_group(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return index.last_n_per_group(events, ["user_id"], ["ts", "event_id"], 30).drop("ts")


@query(
    "latest_per_group",
    """
    SELECT event_type, user_id, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r = 1
    """,
)
def latest_per_group(spark, sf):
    events = table(spark, sf, "events").select("event_type", "user_id", "event_id", "value", "ts")
    return index.latest_per_group(events, ["event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "split_by_ratio",
    """
    SELECT doc_id, CASE WHEN i < round_even(n * (969 / 1000.0::DOUBLE), 0) THEN 'train'
                        WHEN i < round_even(n * (999 / 1000.0::DOUBLE), 0) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
    """,
)
def split_by_ratio(spark, sf):
    return index.split_by_ratio(table(spark, sf, "documents").select("doc_id"), "969,30,1", ["doc_id"])


@query(
    "split_by_hash",
    """
    SELECT doc_id, CASE WHEN u < 969 / 1000.0::DOUBLE THEN 'train' WHEN u < 999 / 1000.0::DOUBLE THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT doc_id, ('0x' || substr(md5('7:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM documents)
    """,
)
def split_by_hash(spark, sf):
    return index.split_by_hash(table(spark, sf, "documents").select("doc_id"), "969,30,1", 7, ["doc_id"])


# ---- order, samples, unions --------------------------------------------------------------------


@query(
    "shuffle_seeded",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS position FROM documents",
)
def shuffle_seeded(spark, sf):
    return index.shuffled_index(table(spark, sf, "documents").select("doc_id"), 42, ["doc_id"])


@query("take_first", "SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 200")
def take_first(spark, sf):
    return rows.take_first(table(spark, sf, "documents").select("doc_id", "source"), 200, 42, ["doc_id"])


@query(
    "sample_rate",
    "SELECT doc_id, source FROM documents WHERE ('0x' || substr(md5('7:' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.25",
)
def sample_rate(spark, sf):
    return rows.sample_rate(table(spark, sf, "documents").select("doc_id", "source"), 0.25, 7, ["doc_id"])


@query(
    "union_sources",
    """
    SELECT doc_id AS id, text, lang FROM documents
    UNION ALL SELECT item_id, text, NULL FROM benchmark
    """,
)
def union_sources(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    return rows.union_sources([docs, items])


@query(
    "expand_shards",
    """
    SELECT source, n_shards, unnest(range(n_shards)) AS shard
    FROM (SELECT source, count(*) // 20 AS n_shards FROM documents GROUP BY source)
    """,
)
def expand_shards(spark, sf):
    sources = table(spark, sf, "documents").groupBy("source").agg(F.floor(F.count("*") / 20).alias("n_shards"))
    return rows.expand_shards(sources, "n_shards")


@query("map_batches", "SELECT doc_id, upper(lang) AS lang, n_chars * 2 AS twice FROM documents")
def map_batches(spark, sf):
    import pyarrow as pa
    import pyarrow.compute as pc

    def double(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pc.utf8_upper(batch.column("lang")), pc.multiply(batch.column("n_chars"), 2)],
            names=["doc_id", "lang", "twice"],
        )

    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return rows.map_batches(docs, double, "doc_id bigint, lang string, twice bigint")


@query(
    "extract_first",
    """
    SELECT user_id, min_by(regexp_extract(props, '"k": (\\d+)', 1), event_id) AS value
    FROM events WHERE regexp_matches(props, '"k": (\\d+)') GROUP BY user_id
    """,
)
def extract_first(spark, sf):
    lines = table(spark, sf, "events").select("user_id", "event_id", "props")
    return audit.extract_first(lines, r'"k": (\d+)', "props", ["event_id"], ["user_id"])
