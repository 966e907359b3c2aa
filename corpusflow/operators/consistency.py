"""Self-consistency: sentences of a text against samples generated from the same prompt."""

from __future__ import annotations

import re
from collections.abc import Awaitable, Callable, Sequence
from functools import partial
from typing import Any, Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.numbers import div
from corpusflow.functions.text import SUPPORT_TEMPLATE, answer_to_score, sentences, strip, words
from corpusflow.operators.async_rows import map_async
from corpusflow.operators.sizing import HOT_ROWS, skew_join
from corpusflow.session import checkpointed

SAMPLES_PER_CHUNK = 32
SENTENCES_PER_BLOCK = 64


def split_sentences(df: DataFrame, text: str, keep: Sequence[str], more_than: int = 3) -> DataFrame:
    """(keep, sent_idx, sentence) for sentences with more than ``more_than`` words."""
    return df.select(*keep, F.posexplode(sentences(text, more_than)).alias("sent_idx", "sentence"))


def support_scores(
    sents: DataFrame,
    samples: DataFrame,
    key: str,
    sentence: str = "sentence",
    sent_idx: str = "sent_idx",
    passage: str = "text",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(key, sent_idx, score): the mean over samples of 1 - share of sentence words in the sample.

    0 is supported, 1 is not. The mean over samples needs only, for each word of the sentence, the
    number of samples that hold it; so sentences and samples meet on (key, word), and no pair of
    a sentence and a sample is ever built. Sentences without words score null, and sentences of
    keys without samples drop out.
    """
    held = (
        samples.select(key, F.explode(F.array_distinct(words(passage))).alias("word"))
        .groupBy(key, "word")
        .agg(F.count("*").alias("_held"))
    )
    number = samples.groupBy(key).agg(F.count("*").alias("_samples"))
    bag = checkpointed(sents.select(key, sent_idx, F.array_distinct(words(sentence)).alias("_words")))
    asked = bag.select(key, sent_idx, F.size("_words").alias("_size"), F.explode_outer("_words").alias("word"))
    found = skew_join(asked, held, [key, "word"], "left", hot_rows=hot_rows)
    summed = found.groupBy(key, sent_idx).agg(
        F.max("_size").alias("_size"), F.coalesce(F.sum("_held"), F.lit(0)).alias("_found")
    )
    supported = F.try_divide(F.col("_found"), F.col("_size") * F.col("_samples"))
    summed = checkpointed(summed)
    return skew_join(summed, number, [key], hot_rows=hot_rows).select(
        key, sent_idx, (F.lit(1.0) - supported).alias("score")
    )


class Scorer(Protocol):
    """A model that compares texts; made once per Python worker, so that loading it is paid for once."""

    def predict(self, sentences: Sequence[str], passages: Sequence[str]) -> np.ndarray:
        """A score per sentence (row) and passage (column)."""


def made_once(sent: Broadcast) -> Any:
    """What the maker in a broadcast makes, made on first use in a Python worker and kept for all tasks of it.

    A worker holds one object per broadcast for as long as the broadcast lives, and with it what was made.
    """
    if not hasattr(sent, "made"):
        sent.made = (cloudpickle.loads(sent.value)(),)
    return sent.made[0]


class PairByPair:
    """A scorer from a function of sentences and passages, a score per pair."""

    def __init__(self, function: Callable[[pd.Series, pd.Series], pd.Series]) -> None:
        self.function = function

    def predict(self, sentences: Sequence[str], passages: Sequence[str]) -> np.ndarray:
        left = pd.Series(np.repeat(np.array(sentences, dtype=object), len(passages)))
        right = pd.Series(list(passages) * len(sentences), dtype=object)
        return self.function(left, right).to_numpy(dtype=float).reshape(len(sentences), len(passages))


class AnswerScorer:
    """A scorer that puts each sentence and passage to a model as a question and reads yes, no or neither."""

    VALUES = {"yes": 0.0, "no": 1.0}

    def __init__(self, answer: Callable[[str], str], template: str = SUPPORT_TEMPLATE) -> None:
        self.answer, self.template = answer, template

    def predict(self, sentences: Sequence[str], passages: Sequence[str]) -> np.ndarray:
        out = np.full((len(sentences), len(passages)), 0.5)
        for i, sentence in enumerate(sentences):
            for j, passage in enumerate(passages):
                filled = re.sub(r"\{(\w+)\}", lambda m: {"context": passage, "sentence": sentence}[m[1]], self.template)
                said = self.answer(filled).lower().strip()
                out[i, j] = next((v for k, v in self.VALUES.items() if said.startswith(k)), 0.5)
        return out


def score_pairs(
    sents: DataFrame,
    samples: DataFrame,
    key: str,
    scorer: Callable[[pd.Series, pd.Series], pd.Series] | None,
    sample_idx: str,
    sentence: str = "sentence",
    sent_idx: str = "sent_idx",
    passage: str = "text",
    chunk: int = SAMPLES_PER_CHUNK,
    hot_rows: int = HOT_ROWS,
    make_scorer: Callable[[], Scorer] | None = None,
    sentences_per_block: int = SENTENCES_PER_BLOCK,
) -> DataFrame:
    """(key, sent_idx, score) by a model that has to see each sentence with each sample.

    The model is a function ``scorer`` of pairs, or an object with state. ``make_scorer`` is sent to the workers once and called once in each Python worker; what it makes is kept
    there for all tasks. Sentences and samples of a key, both numbered from 0, are packed into blocks, and blocks
    meet: a passage crosses once per block of sentences, a sentence once per block of passages, and
    the pairs exist only inside ``predict``. Blocks of sentences of a key with very many are dealt over several tasks.
    """
    if (scorer is None) == (make_scorer is None):
        raise ValueError("either a function of pairs or a maker of scorers")
    kept = sents.sparkSession.sparkContext.broadcast(cloudpickle.dumps(make_scorer or partial(PairByPair, scorer)))
    passages = (
        samples.withColumn("_chunk", div(F.col(sample_idx).cast("long"), chunk))
        .groupBy(key, "_chunk")
        .agg(F.collect_list(F.translate(passage, "\n", " ")).alias("_passages"))
    )
    asked = (
        sents.withColumn("_block", div(F.col(sent_idx).cast("long"), sentences_per_block))
        .groupBy(key, "_block")
        .agg(F.collect_list(F.struct(F.col(sent_idx).alias("idx"), F.col(sentence).alias("text"))).alias("_sents"))
    )

    def total(said: pa.Array, held: pa.Array) -> pa.Array:
        rows = [
            made_once(kept).predict(s, p).astype(float).sum(axis=1).tolist()
            for s, p in zip(said.to_pylist(), held.to_pylist())
        ]
        return pa.array(rows, pa.list_(pa.float64()))

    sums = F.arrow_udf(total, "array<double>")(F.col("_sents")["text"], F.col("_passages"))
    met = skew_join(checkpointed(asked), passages, [key], hot_rows=hot_rows)
    scored = met.select(key, F.col("_sents")["idx"].alias("_idx"), F.size("_passages").alias("_n"), sums.alias("_sums"))
    each = scored.select(key, "_n", F.explode(F.arrays_zip("_idx", "_sums")).alias("_s"))
    return each.groupBy(key, F.col("_s._idx").alias(sent_idx)).agg((F.sum("_s._sums") / F.sum("_n")).alias("score"))


def with_samples_asked_for(
    prompts: DataFrame, samples: DataFrame, key: str, prompt: str, n: int, open_client: Callable[[], Any],
    generate: Callable[[Any, str], Awaitable[str]], sample_idx: str = "sample_idx", passage: str = "text", **options,
) -> DataFrame:
    """(key, sample_idx, passage): the samples, and ``n`` asked for where a key has none; one that fails gives none."""
    known = samples.select(key, sample_idx, passage)
    lacking = prompts.select(key, prompt).join(known.select(key).distinct(), key, "left_anti")
    numbers = F.sequence(F.lit(0), F.lit(n - 1)).cast(f"array<{known.schema[sample_idx].dataType.simpleString()}>")
    wanted = lacking.withColumn(sample_idx, F.explode(numbers))

    async def ask(client: Any, row: Any) -> dict:
        return {passage: await generate(client, row[prompt])}

    answered = map_async(wanted, open_client, ask, f"`{passage}` string", [prompt], **options)
    given = answered.where(F.col(passage).isNotNull()).select(key, sample_idx, F.translate(passage, "\n", " ").alias(passage))
    return known.unionByName(given)


def document_scores(scores: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Mean over the sentences of each text, after the mean over samples per sentence."""
    return scores.groupBy(key).agg(F.count("*").alias("sentences"), F.avg(score).alias("score"))


def flag_by_threshold(scores: DataFrame, threshold: float = 0.5, score: str = "score") -> DataFrame:
    """Texts that score above the threshold; lower is better."""
    return scores.where(F.col(score) > F.lit(threshold))


def undefined_answers(answers: DataFrame, column: str) -> DataFrame:
    """Answers that are neither yes nor no, each once, with its count."""
    said = answers.where(F.col(column).isNotNull()).select(
        strip(F.lower(F.col(column))).alias("answer"), answer_to_score(column).alias("_score")
    )
    return said.where(F.col("_score") == 0.5).groupBy("answer").agg(F.count("*").alias("n"))
