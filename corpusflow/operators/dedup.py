"""Near-duplicate removal: MinHash signatures, bands, connected components.

Signatures (Broder 1997) of word 5-grams, 14 bands of 8 rows (sizes as published for web corpora);
documents equal in one whole band are linked; each connected component keeps its smallest id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.text import let, words
from corpusflow.operators.ngrams import LIMB, PRIME, blocks, ngrams, times_plus, word_hashes
from corpusflow.operators.sizing import HOT_ROWS, broadcast_if_small, skew_join
from corpusflow.session import checkpointed

NGRAM, BANDS, ROWS = 5, 14, 8
# Shingles handled at a time, so that the arrays stay in the processor's cache.
CACHED = 1 << 14
MAX_ROUNDS = 100
# Bits of the bitmap of buckets, at most: 32 MB.
BITMAP_BITS = 28


def permutation(i: int) -> tuple[int, int]:
    """Multiplier (not 0) and offset of hash function ``i``, from md5."""
    draw = [int(hashlib.md5(f"{part}:{i}".encode()).hexdigest()[:15], 16) for part in "ab"]
    return draw[0] % (PRIME - 1) + 1, draw[1] % PRIME


def _minima(values: np.ndarray, starts: np.ndarray, permutations) -> np.ndarray:
    """Matrix of minima of 61 bits, one row per list; no list is empty."""
    out = np.empty((len(permutations), len(starts)), dtype=np.uint64)
    high, low = values >> np.uint64(LIMB), values & np.uint64((1 << LIMB) - 1)
    moved, spare, mid = (np.empty_like(values) for _ in range(3))
    for k, (a, b) in enumerate(permutations):
        times_plus(high, low, a, b, moved, spare, mid)
        np.minimum.reduceat(moved, starts, out=out[k])
    return out.T


def _signature_udf(n: int, hashes: int):
    permutations = [permutation(i) for i in range(hashes)]

    def of_block(lists: pa.Array) -> pa.Array:
        found, counts = ngrams(*word_hashes(lists), n, short=True)
        edges = (np.cumsum(counts) - counts)[np.flatnonzero(counts)]
        out = np.empty((len(edges), hashes), dtype=np.int64)
        done = 0
        while done < len(edges):
            # Whole lists up to the size of the cache, one at least.
            stop = max(int(np.searchsorted(edges, edges[done] + CACHED)), done + 1)
            end = edges[stop] if stop < len(edges) else len(found)
            part = slice(edges[done], end)
            out[done:stop] = _minima(found[part], edges[done:stop] - edges[done], permutations)
            done = stop
        sizes = np.concatenate(([0], np.cumsum(np.where(counts > 0, hashes, 0)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(sizes), pa.array(out.ravel()))

    def signatures(lists: pa.Array) -> pa.Array:
        parts = [of_block(block) for block in blocks(lists)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return F.arrow_udf(signatures, "array<bigint>")


def minhash_signature(
    docs: DataFrame,
    text: str,
    doc_id: str,
    n: int = NGRAM,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, signature) with ``bands * rows`` minima; an empty array for a text without words."""
    signature = _signature_udf(n, bands * rows)
    listed = F.coalesce(words(text), F.array().cast("array<string>"))
    return docs.select(doc_id, signature(listed).alias("signature"))


def band_arrays(
    signatures: DataFrame, doc_id: str, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(id, keys): one key of 128 bits per band, equal for equal minima; no keys without a signature.

    At the size of a large corpus 64 bits would agree by chance.
    """

    def key(band: Column) -> Column:
        part = F.slice(F.col("signature"), band * F.lit(rows) + F.lit(1), rows)
        return F.struct(F.xxhash64(part).alias("a"), F.xxhash64(part, F.lit(1)).alias("b"))

    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)
    some = F.when(F.size("signature") > 0, keys).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))
    return signatures.select(doc_id, some.alias("keys"))


def band_keys(arrays: DataFrame, doc_id: str) -> DataFrame:
    """(id, band, key): one row per band."""
    return arrays.select(doc_id, F.posexplode("keys").alias("band", "key"))


def repeated_buckets(keys: DataFrame, doc_id: str) -> DataFrame:
    """(band, key, hub, _n) of the buckets of several members."""
    return checkpointed(
        keys.groupBy("band", "key")
        .agg(F.min(doc_id).alias("hub"), F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
    )


def _slots(band: np.ndarray, a: np.ndarray, bits: int) -> np.ndarray:
    """The bit of a bitmap that stands for a key."""
    mixed = (a.astype(np.uint64) ^ band.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed >> np.uint64(64 - bits)


def keys_in_buckets(arrays: DataFrame, buckets: DataFrame, doc_id: str, most_bits: int = BITMAP_BITS) -> DataFrame:
    """(id, band, key) of the keys that may belong to a bucket; of the others about one in sixteen.

    A bitmap of the buckets goes to the tasks, 32 MB at most, so that the keys of documents like no other
    are not moved. Where buckets are so many that it fills up, more keys pass.
    """
    amount = buckets.count()
    bits = min(most_bits, max(15, (16 * amount).bit_length()))

    def slot(band: pa.Array, a: pa.Array) -> pa.Array:
        return pa.array(_slots(band.to_numpy(), a.to_numpy(), bits).astype(np.int64))

    slots = buckets.select((F.arrow_udf(slot, T.LongType())(F.col("band").cast("long"), F.col("key.a")) + 1).alias("s"))
    packed = slots.groupBy(F.bitmap_bucket_number("s").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    bitmap = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for row in packed.toLocalIterator():
        bitmap[(row["piece"] - 1) * 4096: row["piece"] * 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    shared = arrays.sparkSession.sparkContext.broadcast(bitmap)

    def known(lists: pa.Array) -> pa.Array:
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        a, b = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
        band = np.arange(len(flat)) - np.repeat(offsets[:-1], np.diff(offsets))
        at = _slots(band, a, bits)
        held = np.flatnonzero((shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
        key = pa.StructArray.from_arrays([pa.array(a[held]), pa.array(b[held])], ["a", "b"])
        rows = pa.StructArray.from_arrays([pa.array(band[held].astype(np.int32)), key], ["band", "key"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(held, offsets).astype(np.int32)), rows)

    kind = "array<struct<band:int,key:struct<a:bigint,b:bigint>>>"
    return arrays.select(doc_id, F.explode(F.arrow_udf(known, kind)(F.col("keys"))).alias("k")).select(doc_id, "k.band", "k.key")


def band_edges(
    keys: DataFrame, doc_id: str, hot_rows: int = HOT_ROWS, buckets: DataFrame | None = None
) -> DataFrame:
    """Star edges (id, hub): every member of a bucket to its smallest id.

    ``m`` copies give ``m - 1`` edges per band, never pairs. Bucket minima are pre-aggregated before
    the shuffle, and very large buckets are salted.
    """
    buckets = repeated_buckets(keys, doc_id) if buckets is None else buckets
    # Only buckets of several members matter, so only their members count.
    rows = buckets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hubs = buckets.select("band", "key", "hub")
    members = skew_join(keys, hubs, ["band", "key"], rows=rows, hot_rows=hot_rows, counts=buckets)
    return members.where(F.col(doc_id) != F.col("hub")).select(doc_id, "hub").distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has a parent."""
    roles = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("lo"), F.lit(0), F.lit(1))
    )
    broken = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        (F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))
    )
    return broken.isEmpty()


def duplicate_clusters(
    edges: DataFrame, a: str = "a", b: str = "b", hot_rows: int = HOT_ROWS, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """(id, cluster) for every id that is not the smallest of its connected component.

    Alternating large-star and small-star steps (Kiveris et al. 2014). Each round is written to the
    checkpoint folder, so neither the plan nor the recovery work grows with the rounds. Raises if
    the rounds do not suffice instead of returning part of a result.
    """
    x, y = F.col(a), F.col(b)
    current = checkpointed(
        edges.where(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct()
    )
    for _ in range(max_rounds):
        if _is_star(current):
            return current.select(F.col("hi").alias("id"), F.col("lo").alias("cluster"))
        # Large star: larger neighbours of a node move to the smallest one around it.
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            current.select(F.col("lo"), F.col("hi"))
        )
        around = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = (
            skew_join(both, around, ["u"], hot_rows=hot_rows)
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        moved = checkpointed(moved)
        # Small star: smaller neighbours of a node, and the node, move to the smallest of them.
        least = moved.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = skew_join(moved, least, ["hi"], hot_rows=hot_rows)
        pulled = joined.where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        kept = least.select("hi", F.col("m").alias("lo"))
        current = checkpointed(pulled.unionAll(kept).distinct())
    raise RuntimeError(f"components not closed after {max_rounds} rounds")


def verify_jaccard(
    edges: DataFrame, docs: DataFrame, text: str, doc_id: str, least: float, n: int = NGRAM
) -> DataFrame:
    """Edges (id, hub) whose exact n-gram Jaccard similarity is at least ``least``, with it.

    Shingle sets are joined to the edges, so only linked documents are read in full. The set of a
    hub with very many members is repeated over salts.
    """

    def grams(w: Column) -> Column:
        count = F.size(w) - F.lit(n - 1)
        many = F.transform(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
            lambda i: F.xxhash64(F.slice(w, i, n)),
        )
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(many))

    edges = checkpointed(edges)
    linked = broadcast_if_small(edges.select(F.explode(F.array(doc_id, "hub")).alias(doc_id)).distinct())
    sets = checkpointed(
        docs.join(linked, doc_id, "left_semi").select(doc_id, let(words(F.col(text)), grams).alias("_set"))
    )
    left = edges.join(sets, doc_id)
    both = skew_join(
        left.select(doc_id, "hub", F.col("_set").alias("_a")),
        sets.select(F.col(doc_id).alias("hub"), F.col("_set").alias("_b")),
        ["hub"],
    )
    shared = F.size(F.array_intersect("_a", "_b"))
    similarity = F.try_divide(shared, F.size("_a") + F.size("_b") - shared)
    return both.select(doc_id, "hub", similarity.alias("jaccard")).where(F.col("jaccard") >= F.lit(least))


def remove_ids(docs: DataFrame, ids: DataFrame, doc_id: str) -> DataFrame:
    return docs.join(ids, doc_id, "left_anti")


def near_duplicates(arrays: DataFrame, doc_id: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, cluster) of the documents to remove, from the band keys of all."""
    buckets = repeated_buckets(band_keys(arrays, doc_id), doc_id)
    edges = band_edges(keys_in_buckets(arrays, buckets, doc_id), doc_id, hot_rows, buckets)
    clusters = duplicate_clusters(edges, doc_id, "hub", hot_rows)
    return clusters.withColumnRenamed("id", doc_id)


def document_bands(
    docs: DataFrame, text: str, doc_id: str, n: int = NGRAM, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Band keys of all documents, written down: texts are read once and never shuffled."""
    signatures = minhash_signature(docs, text, doc_id, n, bands, rows)
    return checkpointed(band_arrays(signatures, doc_id, bands, rows))


def keep_one_per_cluster(docs: DataFrame, text: str, doc_id: str, **options) -> DataFrame:
    """Documents without the larger ids of each near-duplicate cluster."""
    removed = near_duplicates(document_bands(docs, text, doc_id, **options), doc_id)
    return remove_ids(docs, broadcast_if_small(removed.select(doc_id)), doc_id)


def flag_duplicates(
    docs: DataFrame, text: str, doc_id: str, out: str = "keep", **options
) -> DataFrame:
    """``docs`` with a flag that is false for rows to remove."""
    removed = near_duplicates(document_bands(docs, text, doc_id, **options), doc_id)
    gone = broadcast_if_small(removed.select(doc_id, F.lit(True).alias("_gone")))
    return docs.join(gone, doc_id, "left").withColumn(out, F.col("_gone").isNull()).drop("_gone")


def dedup_report(flagged: DataFrame, tokens: Column, keep: str = "keep") -> DataFrame:
    """Documents and tokens before and after, in one pass."""

    def total(value: Column, only_kept: bool) -> Column:
        value = F.when(F.col(keep), value) if only_kept else value
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    counted = flagged.select(keep, tokens.cast("long").alias("_tokens"))
    return counted.agg(
        F.count("*").alias("docs_before"),
        total(F.lit(1), True).alias("docs_after"),
        total(F.col("_tokens"), False).alias("tokens_before"),
        total(F.col("_tokens"), True).alias("tokens_after"),
    )
