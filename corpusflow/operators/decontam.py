"""Remove documents that contain benchmark text.

A document is contaminated when its lower-cased text contains a lower-cased benchmark string
anywhere. A list up to a checked size travels to the tasks, and each text is read once whatever the number
of strings. Of a longer list a bitmap of grams does, and texts and strings are joined on the grams that both
have; every candidate is verified (``substrings``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.rows import exclude_values, strip_non_empty
from corpusflow.operators.sizing import broadcast_if_small, lookup, settle, skew_join
from corpusflow.operators.substrings import first_found, gram_counts, grams_bitmap, held_grams, own_grams
from corpusflow.session import checkpointed

# Bytes of a list that travels whole; it takes roughly ten times as much memory in a worker.
LIST_BYTES = 8 * 1024 * 1024


def benchmark_strings(
    bench: DataFrame, column: str, generic: Sequence[str] = (), benchmark: str = "benchmark"
) -> DataFrame:
    """Stripped, non-empty strings of one list without the generic ones, as (benchmark, string)."""
    cleaned = strip_non_empty(bench, column)
    if generic:
        cleaned = exclude_values(cleaned, column, generic)
    return cleaned.select(F.lit(benchmark).alias("benchmark"), F.col(column).alias("string"))


def _patterns(strings: DataFrame, column: str) -> DataFrame:
    return (
        strings.select(F.lower(F.col(column)).alias("pattern"))
        .where(F.length("pattern") > 0)
        .distinct()
    )


def _pattern_bytes(patterns: DataFrame) -> int:
    return patterns.agg(F.sum(F.octet_length("pattern")).alias("bytes")).first()["bytes"] or 0


def _hits_small(docs: DataFrame, text: str, entries: list) -> DataFrame:
    """``docs`` with the column ``_hit``, the smallest number of a string in the text."""
    if not entries:
        return docs.withColumn("_hit", F.lit(None).cast("long"))
    return docs.withColumn("_hit", first_found(docs.sparkSession, entries)(F.lower(F.col(text))))


def flag_contaminated(
    docs: DataFrame,
    strings: DataFrame,
    text: str,
    doc_id: str,
    string: str = "string",
    out: str = "keep",
    max_bytes: int = LIST_BYTES,
) -> DataFrame:
    """Add a flag that is true for documents without any benchmark string (null text is kept).

    The flag of a row comes from its text alone, however long the list is and whatever ``doc_id`` it has.
    """
    patterns = _patterns(strings, string)
    if _pattern_bytes(patterns) <= max_bytes:
        entries = [(i, row["pattern"]) for i, row in enumerate(patterns.collect())]
        flagged = _hits_small(docs, text, entries)
        return flagged.withColumn(out, F.col("_hit").isNull()).drop("_hit")
    hit = settle(contaminated_texts(docs, strings, text, string).withColumn("_hit", F.lit(True)))
    keyed = docs.withColumn("_key", text_key(text))
    return keyed.join(hit, "_key", "left").withColumn(out, F.col("_hit").isNull()).drop("_hit", "_key")


def decontaminate(
    docs: DataFrame,
    strings: DataFrame,
    text: str,
    doc_id: str,
    string: str = "string",
    max_bytes: int = LIST_BYTES,
) -> DataFrame:
    """Documents that contain none of the strings."""
    flagged = flag_contaminated(docs, strings, text, doc_id, string, "_keep", max_bytes)
    return flagged.where("_keep").drop("_keep")


def contained(docs: DataFrame, patterns: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Distinct (_id, pattern): which texts hold which of the distinct, lower-cased patterns, for lists of any length.

    Every gram of a pattern occurs in every text that holds it. A pattern with a gram that occurs in no text is held
    nowhere; of the others, each takes the gram that texts hold in the fewest places. Texts are read again for
    those grams alone; texts and patterns meet on them, and ``contains`` decides.
    """
    spark = docs.sparkSession
    listed = patterns.select("pattern", F.md5("pattern").alias("_pid"))
    runs = listed.select("_pid", F.explode(own_grams()(F.col("pattern"))).alias("r")).select("_pid", "r.*")
    runs = checkpointed(runs)
    sizes = sorted(r["q"] for r in runs.select("q").distinct().collect())
    if not sizes:
        return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("pattern")).limit(0)
    lowered = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), F.lower(F.col(text)).alias("_text"))
    # Grams that the bitmap lets through by chance meet no pattern. Of most grams only counts leave the texts.
    spread = gram_counts(lowered, "_text", grams_bitmap(runs), sizes)
    anchors = checkpointed(
        runs.join(spread, ["q", "g"], "left")
        .groupBy("_pid")
        .agg(
            F.min_by(F.struct("q", "g", "bit"), F.struct("n", "q", "g")).alias("a"),
            F.bool_and(F.col("n").isNotNull()).alias("_everywhere"),
        )
        .where("_everywhere")
        .select("_pid", "a.*")
    )
    sizes = sorted(r["q"] for r in anchors.select("q").distinct().collect())
    if not sizes:
        return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("pattern")).limit(0)
    chosen = held_grams(spark, grams_bitmap(anchors), sizes)
    held = checkpointed(lowered.select("_id", F.explode(chosen(F.col("_text"))).alias("r")).select("_id", "r.q", "r.g").distinct())
    pairs = checkpointed(skew_join(held, anchors, ["q", "g"]).select("_id", "_pid").distinct())
    rows = pairs.count()
    with_pattern = skew_join(pairs, listed, ["_pid"], rows=rows)
    # Candidates are few: their texts are picked out by a broadcast of ids where that is possible.
    candidates = broadcast_if_small(pairs.select("_id").distinct())
    texts = lowered.join(candidates, "_id", "left_semi").distinct()
    both = skew_join(with_pattern, texts, ["_id"], rows=rows)
    return both.where(F.contains("_text", "pattern")).select("_id", "pattern").distinct()


def contained_ids(docs: DataFrame, strings: DataFrame, text: str, doc_id: str, string: str = "string") -> DataFrame:
    """Distinct ids of documents that contain a string, for lists of any length."""
    patterns = checkpointed(_patterns(strings, string))
    return contained(docs, patterns, text, doc_id).select(F.col("_id").alias(doc_id)).distinct()


def text_key(text: str) -> Column:
    """What a verdict belongs to: 128 bits of the lower-cased text, null for a null one."""
    return F.md5(F.lower(F.col(text)))


def contaminated_texts(docs: DataFrame, strings: DataFrame, text: str, string: str = "string") -> DataFrame:
    """Distinct keys of texts that contain a string, as (_key)."""
    keyed = docs.select(text_key(text).alias("_key"), F.col(text).alias("_whole"))
    return contained_ids(keyed, strings, "_whole", "_key", string)


def decontaminate_anchored(
    docs: DataFrame, strings: DataFrame, text: str, doc_id: str, string: str = "string"
) -> DataFrame:
    """``decontaminate`` by the shuffled join, whatever the length of the list."""
    hit = settle(contaminated_texts(docs, strings, text, string))
    return docs.withColumn("_key", text_key(text)).join(hit, "_key", "left_anti").drop("_key")


def contamination_hits(
    docs: DataFrame,
    strings: DataFrame,
    text: str,
    order: str,
    string: str = "string",
    max_bytes: int = LIST_BYTES,
) -> DataFrame:
    """Documents with the first contained string in list order, as ``hit_<column>`` columns.

    ``order`` numbers the strings (list by list) without repeats. The hit of a row comes from its text alone. A list
    above ``max_bytes`` is joined with the texts on grams.
    """
    listed = strings.withColumn("_pattern", F.lower(F.col(string))).where(F.length("_pattern") > 0)
    first = checkpointed(listed.groupBy("_pattern").agg(F.min(F.col(order).cast("long")).alias("_n")))
    info = strings.select(F.col(order).cast("long").alias("_hit"), *[F.col(c).alias(f"hit_{c}") for c in strings.columns])
    size = first.agg(F.sum(F.octet_length("_pattern")).alias("b")).first()["b"] or 0
    if size <= max_bytes:
        entries = [(row["_n"], row["_pattern"]) for row in first.collect()]
        # Few rows, written down: all texts are read here, in batches of a bounded size.
        found = checkpointed(_hits_small(docs, text, entries).where(F.col("_hit").isNotNull()))
    else:
        keyed = docs.select(text_key(text).alias("_key"), F.col(text).alias("_whole"))
        pairs = contained(keyed, first.select(F.col("_pattern").alias("pattern")), "_whole", "_key")
        numbered = pairs.join(first, pairs["pattern"] == first["_pattern"])
        least = settle(numbered.groupBy(F.col("_id").alias("_key")).agg(F.min("_n").alias("_hit")))
        found = docs.withColumn("_key", text_key(text)).join(least, "_key").drop("_key")
    return lookup(found, settle(info), ["_hit"]).drop("_hit")


def removal_report(flagged: DataFrame, keep: str = "keep") -> DataFrame:
    """Removed rows, all rows and percent removed in one pass; null percent for an empty table."""
    return flagged.agg(
        F.coalesce(F.sum(F.when(~F.col(keep), 1).otherwise(0)), F.lit(0)).cast("long").alias("removed"),
        F.count("*").alias("total"),
    ).withColumn("percent", F.try_divide(F.col("removed") * F.lit(100.0), F.col("total")))
