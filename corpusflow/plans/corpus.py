"""The chains that a corpus goes through, from documents to a mixture."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import STOP_STRINGS
from corpusflow.operators.consistency import document_scores, split_sentences, support_scores
from corpusflow.operators.decontam import decontaminate
from corpusflow.operators.dedup import document_bands, near_duplicates, remove_ids
from corpusflow.operators.generations import align_by_position, clean_solutions
from corpusflow.operators.mixture import (
    listed_shard_sizes,
    manifest_path,
    shard_size,
    weights_override_first_shard,
    weights_override_scaled,
)
from corpusflow.operators.rows import filter_min_score
from corpusflow.operators.sizing import broadcast_if_small


def clean_corpus(
    docs: DataFrame,
    scores: DataFrame,
    strings: DataFrame,
    least: float,
    text: str = "text",
    doc_id: str = "doc_id",
    score: str = "quality",
) -> DataFrame:
    """Documents with a sufficient score, without benchmark text, one per near-duplicate cluster."""
    scored = docs.join(filter_min_score(scores, score, least).select(doc_id), doc_id, "left_semi")
    # Texts are read here for the band keys and once more for the result; only ids and keys are
    # written down in between.
    bands = document_bands(decontaminate(scored, strings, text, doc_id), text, doc_id)
    removed = broadcast_if_small(near_duplicates(bands, doc_id).select(doc_id))
    # The cheap filters run again, so that only the ids to remove meet the texts.
    return remove_ids(decontaminate(scored, strings, text, doc_id), removed, doc_id)


def weighted_manifest(
    docs: DataFrame, tokens: Column, overrides: Mapping[str, float], base: str, unit: float = 1e9
) -> DataFrame:
    """(source, shard, weight, path) from documents with a source and a shard."""
    sizes = shard_size(docs, tokens, unit=unit)
    weights = weights_override_first_shard(sizes, overrides)
    return weights.select("source", "shard", "weight", manifest_path(base, "source", "shard").alias("path"))


#: How weights set by hand are applied: to the first shard of a source alone, or over all its shards by size.
RULES = {"first_shard": weights_override_first_shard, "scaled": weights_override_scaled}


def listed_manifest(
    files: DataFrame, sources: DataFrame, overrides: Mapping[str, float], base: str, rule: str = "scaled",
    other_bases: Mapping[str, str] | None = None, **options,
) -> DataFrame:
    """(source, shard, weight, path) from a listing of files alone: sizes, weights set by hand, paths of a manifest."""
    weights = RULES[rule](listed_shard_sizes(files, sources, **options), overrides)
    return weights.select("source", "shard", "weight", manifest_path(base, "source", "shard", other_bases).alias("path"))


def self_consistency(
    texts: DataFrame, samples: DataFrame, key: str, text: str = "text", passage: str = "text"
) -> DataFrame:
    """Mean score of each text against the samples of the same key."""
    sents = split_sentences(texts, text, [key])
    return document_scores(support_scores(sents, samples, key, passage=passage), key)


def solutions(
    generations: DataFrame,
    prompts: DataFrame,
    generation_order: Sequence[str],
    prompt_order: Sequence[str],
    stops: Sequence[str] = STOP_STRINGS,
    completion: str = "completion",
    prompt: str = "prompt",
) -> DataFrame:
    """Row ``i`` of the generations with prompt ``i``, every completion cleaned."""
    aligned = align_by_position(generations, prompts, generation_order, prompt_order)
    return clean_solutions(aligned, completion, prompt, stops)


def with_shard(docs: DataFrame, n: int, doc_id: str = "doc_id") -> DataFrame:
    """A shard per document from the digest of its id."""
    digits = F.conv(F.substring(F.md5(F.col(doc_id).cast("string")), 1, 8), 16, 10).cast("long")
    return docs.withColumn("shard", F.pmod(digits, F.lit(n)))
