"""Benchmark decontamination by greedy string tiling.

A text and a benchmark item are compared as word sequences. Word n-grams that both hold, found by rolling
hashes, are joined as seeds; seeds on one diagonal are maximal matches. The longest match is marked, then
the longest of what is left unmarked on both sides, and so on, down to the length of a seed. The share of
the item's words under such tiles decides, so a passage is found whatever the order of its parts.

Words of a text are hashed where it is read, and only n-grams that a bitmap of the items' n-grams (of
fixed size) lets pass leave the task. Copies of a text are tiled once. A verdict depends on the text alone.

Defined cases: words are runs of ASCII letters and digits and of all characters beyond ASCII, in lower
case; an item shorter than a seed must occur whole; an item without words matches nothing; a null or
empty text is clean. Rows with equal ids are judged by their texts; repeated items count once; null ids
of items are ids. Columns beside those named pass through or are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common
from corpusflow.llm.common import text_key, written
from corpusflow.operators.sizing import broadcast_if_small, fits, skew_join

SEED = 5
LEAST = 80
#: Bits of the filter of the items' n-grams: half a megabyte in each task.
FILTER = 1 << 22


def _rolled(words: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-grams of all texts and where each starts; none goes over the end of a text."""
    if len(words) < size:
        return words[:0], np.zeros(0, dtype=np.int64)
    total = common.mix64(words[: len(words) - size + 1] + np.uint64(size))
    for j in range(1, size):
        total *= np.uint64(0x9FB21C651E98DF25)
        total += words[j: len(words) - size + 1 + j]
    total = common.mix64(total)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    start = np.flatnonzero(owner[: len(total)] == owner[size - 1: size - 1 + len(total)])
    return total[start], start


def _grams(sizes: list[int], own: bool, bits=None):
    """text -> its n-grams (gram, at).

    ``own``: only the size that fits each text, with the number of words; else all ``sizes`` that pass ``bits``.
    """

    def of(texts: pa.Array) -> pa.Array:
        words, _, edges, _ = common.hash_words(texts, "plain")
        lengths = np.diff(edges)
        parts = []
        for size in sizes:
            gram, start = _rolled(words, edges, size)
            if own:
                owner = np.searchsorted(edges, start, side="right") - 1
                fitting = np.minimum(lengths[owner], SEED) == size
                gram, start = gram[fitting], start[fitting]
            else:
                passed = bits.value[(gram & np.uint64(FILTER - 1)).astype(np.int64)]
                gram, start = gram[passed], start[passed]
            parts.append((gram, start))
        gram = np.concatenate([p[0] for p in parts])
        start = np.concatenate([p[1] for p in parts])
        order = np.argsort(start, kind="stable")
        gram, start = gram[order], start[order]
        owner = np.searchsorted(edges, start, side="right") - 1
        rows = pa.StructArray.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array((start - edges[owner]).astype(np.int32)),
             pa.array(lengths[owner].astype(np.int32))], ["gram", "at", "n"]
        )
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)), rows)

    # Marked so that a filter on the result does not run it a second time, in a second Python worker a task.
    return F.arrow_udf(of, "array<struct<gram:bigint,at:int,n:int>>").asNondeterministic()


def tiles(pos: list[int], at: list[int], n: int, seed: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (place in the item, place in the text, length) of seeds that start at ``pos`` and ``at``.

    Longest first; of equal lengths the one that comes first in the item, then in the text.
    """
    seed = min(seed, n)
    a, b = np.asarray(pos, dtype=np.int64), np.asarray(at, dtype=np.int64)
    pairs = np.unique(np.stack([b - a, a], axis=1), axis=0)
    breaks = np.flatnonzero(np.append(True, (np.diff(pairs[:, 0]) != 0) | (np.diff(pairs[:, 1]) != 1)))
    ends = np.append(breaks[1:], len(pairs))
    heap = [
        (-(int(e - s) + seed - 1), int(pairs[s, 1]), int(pairs[s, 1] + pairs[s, 0])) for s, e in zip(breaks, ends)
    ]
    heapq.heapify(heap)
    in_item, in_text, out = set(), set(), []
    while heap:
        size, i, j = heapq.heappop(heap)
        free = [i + t not in in_item and j + t not in in_text for t in range(-size)]
        if all(free):
            in_item.update(range(i, i - size))
            in_text.update(range(j, j - size))
            out.append((i, j, -size))
            continue
        # What is left of a match competes again with its own length.
        t = 0
        while t < len(free):
            if not free[t]:
                t += 1
                continue
            stop = t
            while stop < len(free) and free[stop]:
                stop += 1
            if stop - t >= seed:
                heapq.heappush(heap, (t - stop, i + t, j + t))
            t = stop
    return out


def _tile():
    def of(seeds: pa.Array, n: pa.Array) -> pa.Array:
        out = []
        for pairs, size in zip(seeds.to_pylist(), n.to_pylist()):
            found = tiles([p["pos"] for p in pairs], [p["at"] for p in pairs], size)
            out.append([{"item_at": i, "text_at": j, "words": k} for i, j, k in found])
        kind = pa.list_(pa.struct([("item_at", pa.int32()), ("text_at", pa.int32()), ("words", pa.int32())]))
        return pa.array(out, kind)

    return F.arrow_udf(of, "array<struct<item_at:int,text_at:int,words:int>>").asNondeterministic()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    least: int = LEAST,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(id, item, n_words, covered, tiles, _key) for every text and item with ``least`` hundredths covered.

    ``_key`` is the digest of the text.
    """
    known = items.select(F.col(item_id).alias("item"), F.lower(item_text).alias("t")).distinct()
    grams = _grams(list(range(1, SEED + 1)), own=True)(F.col("t"))
    seeds = written(
        known.select("item", F.xxhash64("t").alias("item_ref"), F.explode(grams).alias("g"))
        .select("item", "item_ref", "g.gram", F.col("g.at").alias("pos"), "g.n"),
        "seeds",
    )
    # The filter has a fixed size, whatever the number of items.
    used = seeds.select(F.col("gram").bitwiseAND(F.lit(FILTER - 1)).cast("int").alias("bit")).distinct().toArrow()
    bits = np.zeros(FILTER, dtype=bool)
    bits[used["bit"].to_numpy()] = True
    sizes = sorted(r[0] for r in seeds.select(F.least("n", F.lit(SEED))).distinct().collect())
    spark = docs.sparkSession
    found = _grams(sizes, own=False, bits=spark.sparkContext.broadcast(bits))(F.lower(F.col(text)))
    if not sizes:
        found = F.array().cast("array<struct<gram:bigint,at:int,n:int>>")
    read = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("t"), found.alias("hits")).where(F.size("hits") > 0)
    hits = written(read.select("_id", text_key(F.col("t")).alias("_key"), "hits"), "hits")
    # Copies have equal hits; they are tiled once.
    texts = hits.groupBy("_key").agg(F.first("hits").alias("hits"))
    places = texts.select("_key", F.explode("hits").alias("h")).select("_key", "h.gram", "h.at")
    met = places.join(F.broadcast(seeds), "gram") if fits(seeds) else skew_join(written(places, "places"), seeds, ["gram"])
    # Words under seeds bound what tiles can cover.
    gathered = met.groupBy("_key", "item", "item_ref", "n").agg(F.collect_list(F.struct("pos", "at")).alias("pairs"))
    distinct = F.size(F.array_distinct(F.transform("pairs", lambda p: p["pos"])))
    enough = F.lit(100) * distinct * F.least("n", F.lit(SEED)) >= F.lit(least) * F.col("n")
    tiled = gathered.where(enough).select("_key", "item", "n", _tile()(F.col("pairs"), F.col("n")).alias("tiles"))
    covered = F.aggregate(F.transform("tiles", lambda t: t["words"]), F.lit(0), lambda a, b: a + b)
    judged = tiled.withColumn("covered", covered).where(F.lit(100) * F.col("covered") >= F.lit(least) * F.col("n"))
    judged = written(judged, "contaminated")
    rows = skew_join(hits.select("_id", "_key"), judged, ["_key"])
    return rows.select(
        F.col("_id").alias(doc_id), "item", F.col("n").alias("n_words"), "covered", "tiles", "_key"
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the texts that cover a benchmark item; null texts stay."""
    found = contamination(docs, items, doc_id=doc_id, text=text, **options)
    bad = broadcast_if_small(written(found.select(F.col("_key").alias("_bad")).distinct(), "contaminated-keys"))
    return docs.join(bad, text_key(docs[text]) == bad["_bad"], "left_anti")
