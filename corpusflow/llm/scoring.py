"""Scores of texts by a language model: context-tree weighting over bytes, beside a unigram base.

The model learns from the texts it is told to learn from: all their grams of ``DEPTH`` bytes and the byte
after them are counted, and contexts of every length up to ``DEPTH`` are weighed (``contexts``). Nothing of it
is held whole by a task, except the contexts of less than ``LOW`` bytes, whose number is bounded whatever
the corpus. Texts are dealt into blocks; each block sends its distinct grams to shards by their nearest
context, a shard weighs its contexts and sends back what every gram costs, and so do words for the base.

Defined cases: a null text is empty, which is one end; every text has an end, and A-Z count as a-z; a row
with a null id is learned from and scored; repeated rows count each; without a text to learn from every bit has the probability 1/2; an empty
table gives no rows. A very long text is a block of its own and is read in windows. Columns beside those named are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import blocks, contexts
from corpusflow.llm.common import mix64, short_batches, written

#: Bytes of the longest context.
DEPTH = 5
#: Contexts shorter than this are shared by all shards: at most 256 ** (LOW - 1) contexts of 255 nodes each.
LOW = 3
#: Bytes of text per block (the larger, the fewer grams are named twice) and per shard of grams.
BLOCK_BYTES, SHARD_BYTES = 1 << 25, 1 << 25
KINDS = blocks.classes(blocks.WHITE)


def squeezed(codes: np.ndarray, depth: int) -> bytes:
    """Grams without the bytes that are always zero."""
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : depth + 1]).tobytes()


def widened(data, depth: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, depth + 1)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, : depth + 1] = raw
    return out.reshape(-1).view("<u8")


def word_counts(texts: DataFrame) -> DataFrame:
    """(block, word, n): the distinct words of every block and how often texts to learn from hold them."""

    def parts(batches):
        for (block,), rows in blocks.runs(batches, 1, 2):
            words, edges, _ = blocks.split_words(rows.column(2), KINDS)
            if len(words):
                learn = np.repeat(rows.column(1).to_numpy(zero_copy_only=False), np.diff(edges))
                yield block, *blocks.summed([words], learn)

    def count(batches):
        for block, (word,), n in blocks.counted(parts(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), block)), word, pa.array(n)], ["block", "word", "n"])

    return texts.select("block", "learn", "text").mapInArrow(count, "block bigint, word string, n bigint")


def gram_lists(texts: DataFrame, shards: int, depth: int, low: int) -> DataFrame:
    """(shard, block, codes, counts): the distinct grams of every block, as often as texts to learn from hold them."""

    def make(batches):
        def rows_of(block, codes, counts):
            near = codes >> np.uint64(8 * (depth + 1 - low))
            shard = (mix64(near.copy()) % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            shard, codes, counts = shard[order], codes[order], counts[order].astype("<u4")
            starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            ends = np.append(starts[1:], len(shard))
            return pa.RecordBatch.from_arrays([
                pa.array(shard[starts]), pa.array(np.full(len(starts), block)),
                pa.array([squeezed(codes[a:b], depth) for a, b in zip(starts, ends)], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ], ["shard", "block", "codes", "counts"])

        now, held = None, []
        for (block,), rows in blocks.runs(batches, 1, 2):
            if block != now and held:
                yield rows_of(now, *_gathered(held))
                held = []
            now = block
            learn = rows.column(1).to_numpy(zero_copy_only=False)
            for code, place, edges in contexts.windows(rows.column(2), depth):
                of = np.diff(np.clip(edges, place, place + len(code)))
                used = np.repeat(learn, of) if not learn.all() else None
                if used is None:
                    held.append(contexts.distinct(code))
                else:
                    held.append(contexts.distinct(code[used]))
                    rest = contexts.distinct(code[~used])[0]
                    held.append((rest, np.zeros(len(rest), np.int64)))
                if len(held) > 8:
                    held = [_gathered(held)]
        if held:
            yield rows_of(now, *_gathered(held))

    return texts.select("block", "learn", "text").mapInArrow(make, "shard int, block bigint, codes binary, counts binary")


def _gathered(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(p) for p in zip(*parts))
    return contexts.distinct(codes, counts)


def _shards(batches, weigh, depth: int):
    """``weigh(levels, lists)`` of one shard after the other; ``lists`` are the (block, codes) it came from."""
    now, held = None, []
    for (shard,), rows in blocks.runs(batches, 1):
        if shard != now and held:
            yield from weigh(held)
            held = []
        now = shard
        for block, codes, counts in zip(rows.column(1).to_pylist(), rows.column(2), rows.column(3)):
            held.append((block, widened(codes.as_buffer(), depth), np.frombuffer(counts.as_buffer(), "<u4")))
    if held:
        yield from weigh(held)


def _weighed(held, depth: int, low: int) -> list[contexts.Level]:
    codes, counts = _gathered([(h[1], h[2].astype(np.int64)) for h in held])
    return contexts.levels(codes, counts, depth, low)


def short_contexts(lists: DataFrame, depth: int, low: int) -> list[contexts.Top]:
    """The nodes of the contexts of less than ``low`` bytes."""

    def weigh(held):
        columns = contexts.parts_above(_weighed(held, depth, low)[-1])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "zeros", "ones", "logs"])

    parts = lists.mapInArrow(lambda batches: _shards(batches, weigh, depth), "key bigint, zeros bigint, ones bigint, logs bigint")
    sums = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "logs")])
    with short_batches(lists.sparkSession):
        found = sums.toArrow()
    order = np.argsort(found["key"].to_numpy())
    key, zeros, ones, logs = (found[c].to_numpy()[order] for c in ("key", "zeros", "ones", "logs"))
    return contexts.tops(key, zeros, ones, logs / contexts.UNIT, low)


def gram_costs(lists: DataFrame, top: list[contexts.Top], depth: int, low: int) -> DataFrame:
    """(block, codes, costs): log10 of the probability of every gram of every block, as floats of 4 bytes."""
    sent = lists.sparkSession.sparkContext.broadcast(top)

    def weigh(held):
        found = _weighed(held, depth, low)
        cost = contexts.log10_of(found, sent.value)
        for block, codes, _ in held:
            own = cost[np.searchsorted(found[0].codes, codes)].astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([squeezed(codes, depth)], pa.binary()), pa.array([own.tobytes()], pa.binary())],
                ["block", "codes", "costs"],
            )

    return lists.mapInArrow(lambda batches: _shards(batches, weigh, depth), "block bigint, codes binary, costs binary")


def _scored(stream: DataFrame, id_kind: str, depth: int, places: int, words: int, ends: int) -> DataFrame:
    """Texts with the sums of what their block's notes say about their grams and words."""
    base = float(places + words + 1)

    def cost_of_places(texts, codes, costs):
        total = np.zeros(len(texts))
        for code, place, edges in contexts.windows(texts, depth):
            order = np.argsort(code, kind="stable")
            ranked = code[order]
            starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
            own = costs[np.searchsorted(codes, ranked[starts])]
            cost = np.empty(len(code))
            cost[order] = np.repeat(own, np.diff(np.append(starts, len(code))))
            low = int(np.searchsorted(edges, place, side="right")) - 1
            high = int(np.searchsorted(edges, place + len(code), side="left"))
            total[low:high] += np.add.reduceat(cost, np.maximum(edges[low:high] - place, 0))
        return total

    def score(batches):
        now, grams, listed = None, [], []
        for (block, kind), rows in blocks.runs(batches, 2, 5):
            if block != now:
                now, grams, listed = block, [], []
            if kind == 0:
                grams += [
                    (widened(a.as_buffer(), depth), np.frombuffer(b.as_buffer(), "<f4")) for a, b in zip(rows.column(7), rows.column(8))
                ]
                continue
            if kind == 1:
                listed.append((rows.column(5), rows.column(6)))
                continue
            if len(grams) > 1:
                codes, costs = (np.concatenate(p) for p in zip(*grams))
                order = np.argsort(codes, kind="stable")
                grams = [(codes[order], costs[order])]
            if len(listed) > 1:
                listed = [tuple(pa.concat_arrays(parts) for parts in zip(*listed))]
            texts = rows.column(5)
            found, edges, _ = blocks.split_words(texts, KINDS)
            found = found.dictionary_encode()
            known = np.zeros(len(found.dictionary), dtype=np.int64)
            if listed:
                place = pc.fill_null(pc.index_in(found.dictionary, value_set=listed[0][0]), -1).to_numpy()
                known = np.append(listed[0][1].to_numpy(), 0)[place]
            codes_of, owner = found.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(edges))
            sums = [np.bincount(owner, weights=v[codes_of], minlength=len(texts)) for v in (np.log10((known + 1) / base), known > 0)]
            cost = cost_of_places(texts, *grams[0])
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            yield pa.RecordBatch.from_arrays([
                rows.column(3), rows.column(4), pa.array(np.diff(edges) + 1), pa.array(sums[1].astype(np.int64) + (ends > 0)),
                pa.array(np.full(len(texts), places)), pa.array(sums[0] + np.log10((ends + 1) / base)), pa.array(cost),
                pa.array(-cost / np.log10(2) / (sizes + 1)),
            ], ["id", "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    kinds = "learn boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"
    return stream.mapInArrow(score, f"id {id_kind}, {kinds}")


def score_texts(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, low: int = LOW,
    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(id, learn, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every text.

    ``learn`` says which rows the model learns from. ``score``: log10 of the probability that the model gives the
    text and its end; ``base_score``: the same of its words and its end, each alone, counts plus one.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).alias("id"), F.coalesce(learn, F.lit(True)).alias("learn"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = blocks.blocked(slim, "text", block_bytes)
    size = texts.agg(
        F.sum(F.octet_length("text") + 1).alias("bytes"), F.sum(F.col("learn").cast("long")).alias("ends"),
    ).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, int(size["bytes"] or 0) // shard_bytes)
    ends = int(size["ends"] or 0)

    # Words: counts of all texts to learn from, told to every block that holds the word.
    listed = word_counts(texts)
    of_word = Window.partitionBy("word")
    counted = written(listed.withColumns({
        "c": F.sum("n").over(of_word), "nth": F.row_number().over(of_word.orderBy("block")),
    }), "words")
    sums = counted.agg(F.sum("n").alias("n"), F.count_if((F.col("nth") == 1) & (F.col("c") > 0)).alias("v")).first()
    places, words = int(sums["n"] or 0) + ends, int(sums["v"]) + (ends > 0)

    lists = written(gram_lists(texts, shards, depth, low), "grams")
    dealt = lists.repartition(parts, "shard").sortWithinPartitions("shard", "block")
    costs = gram_costs(dealt, short_contexts(dealt, depth, low), depth, low)

    id_kind = docs.schema[doc_id].dataType.simpleString()
    columns = ["block", "kind", "place", "id", "learn", "text", "c", "codes", "costs"]
    gone = {"id": id_kind, "learn": "boolean", "text": "string", "c": "bigint", "codes": "binary", "costs": "binary"}

    def noted(df: DataFrame, kind: int, *have: str) -> DataFrame:
        rows = blocks.padded(df, **{name: k for name, k in gone.items() if name not in have})
        rows = rows if "place" in rows.columns else rows.withColumn("place", F.lit(0).cast("long"))
        return rows.withColumn("kind", F.lit(kind)).select(columns)

    known = counted.where(F.col("c") > 0).select("block", F.col("word").alias("text"), "c")
    notes = noted(costs, 0, "codes", "costs").unionByName(noted(known, 1, "text", "c"))
    stream = blocks.beside(noted(texts, 2, "id", "learn", "text"), notes)
    return _scored(stream, id_kind, depth, places, words, ends)
