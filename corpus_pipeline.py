"""A training corpus from documents in five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. Null and empty texts: language identification rejects them (they
have no letter). Tables without rows pass through all stages. A column ``n_chars`` follows the text.

The first and the last stage run their functions when the caller evaluates them, so they bound the Arrow
batches of the session and leave the bound there. Results do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import bpe, language, lines, minhash, tiling
from corpusflow.llm.common import bound_batches, table, written
from corpusflow.llm.queries import vocabulary

#: Bytes of an Arrow batch. Executors and their workers keep what batches took, through all stages.
BATCH_BYTES = 2 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: texts without a letter go, and texts whose language stays ambiguous.

    Learns from the labels of ``docs``; without any label, only texts without a letter go.
    """
    bound_batches(spark, BATCH_BYTES)
    model = language.fit(docs)
    if not model["languages"]:
        return docs.where(language.has_letter(F.col("text")))
    found = language.predict(docs, model)
    return docs.where((found["lang"] != F.lit(language.UND)) & ~found["ambiguous"])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: every line that matches an earlier one goes; documents stay, however little is left."""
    done = lines.dedup_lines(docs, out="_removed_lines").drop("_removed_lines")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each group at a Jaccard similarity of 0.8 on five-word shingles stays."""
    return minhash.keep_one(docs, n=5, least=80)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold 80 % of a benchmark item in tiles of five words or more go."""
    return tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: tokens of every text, and the text that they decode to."""
    bound_batches(spark, BATCH_BYTES)
    # Encoded and decoded by one function: two would keep two Python workers a task in memory, in later stages too.
    coded = docs.withColumn("tokens", bpe.coder(spark, vocabulary())(F.col("text")))
    return coded.withColumns({
        "tokens": F.col("tokens.tokens"), "n_tokens": F.size("tokens.tokens").cast("long"), "decoded": F.col("tokens.decoded"),
    })


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_texts),
    ("bpe", encode),
]

#: SQL cannot express the classifiers and the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
