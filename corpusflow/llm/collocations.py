"""Phrases whose words stand together more often than apart, counted in counting quotient filters.

Words that occur often enough get dense ids, the words of a text become ids through its block's own list
(``blocks``), and n-grams of ids are counted in filters (``quotients``) where the texts are; filters
travel by shard and are merged there. A phrase can only be frequent if all its words are, so words below
the bound need no id and no count is lost.

Defined cases: a null or empty text has no words; a null group is the group ``und``; a very long text is a
block of its own; repeated rows count each; an empty table gives no rows. Ties of the cut go to the
shortest first part, ties of the rank to the phrase's bytes. Columns beside those named are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import blocks, quotients
from corpusflow.llm.common import written
from corpusflow.operators.index import global_index
from corpusflow.operators.sizing import broadcast_if_small, lookup, skew_join

#: Between words, and between pieces that no phrase crosses.
SPACES, STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"
#: n-grams that a task gathers before it makes a filter of them.
HELD = 1 << 20
#: n-grams per shard, by which the number of shards follows the corpus: a task holds one shard at a time.
SHARD_GRAMS = 1 << 22
#: Filters of a shard that are read before they are merged.
FAN_IN = 64


def word_counts(texts: DataFrame) -> DataFrame:
    """(block, lang, word, n): the distinct words of every block."""
    kinds = blocks.classes(SPACES, STOPS)

    def parts(batches):
        for (block,), rows in blocks.runs(batches, 1, 2):
            words, edges, _ = blocks.split_words(rows.column(2), kinds)
            if len(words):
                langs = rows.column(1).take(pa.array(np.repeat(np.arange(rows.num_rows), np.diff(edges))))
                yield block, *blocks.summed([langs, words], np.ones(len(words), np.int64))

    def count(batches):
        for block, (lang, word), n in blocks.counted(parts(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), block)), lang, word, pa.array(n)], ["block", "lang", "word", "n"])

    return texts.select("block", "lang", "text").mapInArrow(count, "block bigint, lang string, word string, n bigint")


def vocabulary(counts: DataFrame, least: int) -> DataFrame:
    """(id, lang, word, f): words that occur ``least`` times in their group, numbered from 0 over all groups."""
    often = counts.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return written(global_index(written(often, "often"), ["lang", "word"], out="id"), "vocabulary")


def filters(texts: DataFrame, known: DataFrame, shapes: dict[int, quotients.Shape]) -> DataFrame:
    """(shard, size, data): filters of the n-grams of frequent words, by size of n-gram.

    ``known``: (block, lang, word, id), the frequent words that each block holds.
    """
    kinds = blocks.classes(SPACES, STOPS)

    def make(batches):
        held: dict[int, list] = {size: [] for size in shapes}
        amount = dict.fromkeys(shapes, 0)

        def flush(size):
            s = shapes[size]
            keys = [np.concatenate(k) for k in zip(*held[size])]
            held[size], amount[size] = [], 0
            packed = quotients.permute(*quotients.pack(keys, s), s)
            found = quotients.encode(*quotients.counted(*packed, np.ones(len(keys[0]), np.int64), s), s)
            return pa.RecordBatch.from_arrays([
                pa.array(np.array([f[0] for f in found], np.int32)), pa.array(np.full(len(found), size, np.int32)),
                pa.array([f[1] for f in found], pa.binary()),
            ], ["shard", "size", "data"])

        at, names = None, {}
        for (block, kind), rows in blocks.runs(batches, 2, 4):
            if block != at:
                at, names = block, {}
            if kind == 0:
                for lang in rows.column(3).unique():
                    own = rows.filter(pc.equal(rows.column(3), lang))
                    names.setdefault(lang.as_py(), []).append((own.column(5), own.column(6)))
                continue
            langs = rows.column(3).dictionary_encode()
            words, edges, joined = blocks.split_words(rows.column(4), kinds)
            words = words.dictionary_encode()
            codes, ids = words.indices.to_numpy(), np.full(len(words), -1, np.int64)
            of = np.repeat(langs.indices.to_numpy(), np.diff(edges))
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                if lang not in names:
                    continue
                if len(names[lang]) > 1:
                    names[lang] = [tuple(pa.concat_arrays(parts) for parts in zip(*names[lang]))]
                listed, numbers = names[lang][0]
                place = pc.fill_null(pc.index_in(words.dictionary, value_set=listed), -1).to_numpy()
                number = np.append(numbers.to_numpy(), -1)[place]
                ids = np.where(of == i, number[codes], ids)
            good = ids >= 0
            for size in shapes:
                n = max(len(ids) - size + 1, 0)
                whole = good[:n].copy()
                for j in range(1, size):
                    whole &= good[j: n + j] & joined[j: n + j]
                start = np.flatnonzero(whole)
                for low in range(0, len(start), HELD):
                    piece = start[low: low + HELD]
                    held[size].append([ids[piece + j] for j in range(size)])
                    amount[size] += len(piece)
                    if amount[size] >= HELD:
                        yield flush(size)
        for size in shapes:
            if amount[size]:
                yield flush(size)

    notes = blocks.padded(known.withColumns({"kind": F.lit(0), "place": F.lit(0).cast("long")}), text="string")
    rows = blocks.padded(texts.withColumn("kind", F.lit(1)), word="string", id="bigint")
    columns = ["block", "kind", "place", "lang", "text", "word", "id"]
    stream = blocks.beside(rows.select(columns), notes.select(columns))
    return stream.mapInArrow(make, "shard int, size int, data binary")


def gram_counts(made: DataFrame, shapes: dict[int, quotients.Shape], least: int) -> DataFrame:
    """(size, w1, w2, w3, a) of all n-grams that occur ``least`` times; w3 is -1 for pairs."""

    def merge(batches):
        def entries(at, parts):
            if len(parts) == 1:
                return parts[0]
            return quotients.counted(*(np.concatenate(p) for p in zip(*parts)), shapes[at[1]])

        def done(at, waiting, parts):
            if waiting:
                parts = [*parts, quotients.merged(at[0], waiting, shapes[at[1]])]
            upper, lower, counts = entries(at, parts)
            often = counts >= least
            ids = quotients.unpack(*quotients.restore(upper[often], lower[often], shapes[at[1]]), shapes[at[1]])
            ids += [np.full(len(ids[0]), -1)] * (3 - at[1])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids[0]), at[1], np.int32)), *map(pa.array, ids), pa.array(counts[often])],
                ["size", "w1", "w2", "w3", "a"],
            )

        now, waiting, parts = None, [], []
        for at, rows in blocks.runs(batches, 2):
            if at != now:
                if now is not None:
                    yield done(now, waiting, parts)
                now, waiting, parts = at, [], []
            for data in rows.column(2):
                waiting.append(data.as_buffer())
                if len(waiting) == FAN_IN:
                    parts = [entries(at, [*parts, quotients.merged(at[0], waiting, shapes[at[1]])])]
                    waiting = []
        if now is not None:
            yield done(now, waiting, parts)

    parts = int(made.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = made.repartition(parts, "shard").sortWithinPartitions("shard", "size")
    return dealt.mapInArrow(merge, "size int, w1 bigint, w2 bigint, w3 bigint, a bigint")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, inside: int = 50, top: int = 2000,
    scale: int = 1_000_000, block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of every group.

    ``a``, ``l``, ``r``: how often the phrase, and the two parts of its worst cut, occur; ``n``: words of the
    group. ``score``: ``scale * a * a / (l * r)`` rounded down. A phrase goes where a longer one that
    holds it has ``inside`` per cent of its count.
    """
    spark = docs.sparkSession
    group = F.coalesce(F.col(lang), F.lit("und"))
    texts = blocks.blocked(docs.select(group.alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")), "text", block_bytes)
    counts = written(word_counts(texts), "words")
    known = vocabulary(counts, least)
    found = known.agg(F.count("*").alias("words"), F.sum("f").alias("places")).first()
    bits = max(1, int(found["words"]).bit_length())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, -(-int(found["places"] or 0) // SHARD_GRAMS))
    shapes = {size: quotients.shape(bits, size, (shards - 1).bit_length(), HELD // shards) for size in (2, 3)}
    listed = counts.join(known, ["lang", "word"]).select("block", "lang", "word", "id")
    grams = written(gram_counts(filters(texts, listed, shapes), shapes, least), "grams")
    pairs = grams.where("size = 2").select("w1", "w2", "a")
    threes = grams.where("size = 3").select("w1", "w2", "w3", "a")

    # Pairs that a longer phrase takes over.
    held = threes.select(F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    longer = held.groupBy("p.w1", "p.w2").agg(F.max("a").alias("longer"))
    left = pairs.join(longer, ["w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))

    # Counts of the parts of three words that are pairs.
    heads = pairs.select("w1", "w2", F.col("a").alias("head"))
    tails = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("tail"))
    threes = skew_join(skew_join(threes, heads, ["w1", "w2"]), tails, ["w2", "w3"])
    both = left.select("w1", "w2", F.lit(-1).cast("long").alias("w3"), "a", *[F.lit(None).cast("long").alias(c) for c in ("head", "tail")])
    both = written(both.unionByName(threes.select(both.columns)), "candidates")

    # Words and their counts.
    for i in (1, 2, 3):
        own = known.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"t{i}"), F.col("f").alias(f"f{i}"), *(["lang"] if i == 1 else []))
        both = lookup(both, own, [f"w{i}"], "left" if i == 3 else "inner")

    def score(l, r):  # noqa: E741
        wide = lambda x: x.cast("decimal(15,0)")
        over = (wide(F.col("a")) * wide(F.col("a")) * F.lit(scale).cast("decimal(7,0)")).cast("decimal(38,0)")
        return F.call_function("div", over, (wide(l) * wide(r)).cast("decimal(38,0)"))

    pair = F.col("t3").isNull()
    cuts = F.when(pair, F.array(
        F.struct(score(F.col("f1"), F.col("f2")).alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f2").alias("r")),
    )).otherwise(F.array(
        F.struct(score(F.col("f1"), F.col("tail")).alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("tail").alias("r")),
        F.struct(score(F.col("head"), F.col("f3")).alias("score"), F.lit(2).alias("k"), F.col("head").alias("l"), F.col("f3").alias("r")),
    ))
    scored = both.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", F.array_min(cuts).alias("cut"))
    # The best of each group come from the best of its parts, so that no task reads what all tasks kept.
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = F.pmod(F.xxhash64("phrase"), F.lit(math.isqrt(parts) + 1))
    first = Window.partitionBy("lang", dealt).orderBy(*order)
    ranked = scored.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(broadcast_if_small(words), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").cast("long").alias("score"),
    )
