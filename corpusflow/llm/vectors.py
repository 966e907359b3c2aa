"""Near-duplicate vectors by Euclidean p-stable hashing, with exact cosines.

Normalised vectors are projected on random directions and the projections are cut into steps; a table's
key is a tuple of steps. Vectors that share a key in any table are compared by their cosines in double
precision. Vectors with a cosine of 0.9 lie 0.447 apart, so the chance that a pair shares a key is known;
tuples grow with the number of vectors (so that chance meetings stay few) and tables with them (so that
the wanted recall at the least cosine stays).

Equal vectors are one class before anything is compared. A key that many classes share is cut into blocks,
and every pair of blocks is compared in a task of its own, so no key is held whole anywhere.

Defined cases: a null vector, one without components, with a null or non-finite component, or of length 0
links with nothing and is its own component; vectors of different dimensions link with nothing; equal
vectors always link; rows with equal ids are rows of their own; a null id never represents a component
that has another id. Columns beside id and vector are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common, exchange
from corpusflow.llm.common import written
from corpusflow.operators.dedup import duplicate_clusters
from corpusflow.operators.sizing import lookup, skew_join

#: Width of a step, and the wanted chance to find a pair at the least cosine.
STEP, RECALL = 2.5, 0.97
#: Classes of a block, and rows of a group above which products are taken as matrices.
BLOCK, SMALL = 1024, 12


def chance(apart: float, step: float = STEP) -> float:
    """The chance that a projection of two points at this distance falls into one step."""
    ratio = step / apart
    inside = math.erf(ratio / math.sqrt(2))
    return inside - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def plan(n: int, least: float, recall: float = RECALL) -> tuple[int, int]:
    """(projections per key, tables) for ``n`` vectors."""
    near, far = chance(math.sqrt(2 - 2 * least)), chance(math.sqrt(2))
    width = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    return width, math.ceil(math.log(1 - recall) / math.log(1 - near**width))


def valid(vector: Column) -> Column:
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; very large and small components do no harm."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _keys(width: int, tables: int):
    """vector -> one key per table."""

    def of(vectors: pa.Array) -> pa.Array:
        sizes = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        out = np.zeros((len(vectors), tables), dtype=np.uint64)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            draw = np.random.default_rng([17, size])
            directions = draw.standard_normal((size, tables * width))
            shift = draw.uniform(0, STEP, tables * width)
            for low in range(0, len(rows), 1 << 10):
                part = rows[low: low + (1 << 10)]
                units = _units(flat[starts[part][:, None] + np.arange(size)])
                steps = np.floor((units @ directions + shift) / STEP).astype(np.int64).view(np.uint64)
                steps = steps.reshape(len(part), tables, width)
                key = np.arange(1, tables + 1, dtype=np.uint64) + np.uint64(size << 32) + np.zeros((len(part), 1), np.uint64)
                for j in range(width):
                    key = common.mix64(key * np.uint64(0x9FB21C651E98DF25) + steps[:, :, j])
                out[part] = key
        return common.lists(out.view(np.int64).ravel(), np.full(len(vectors), tables))

    return F.arrow_udf(of, "array<bigint>")


def _links(members: DataFrame, size: int, wide: bool, least: float) -> DataFrame:
    """(a, b) of classes with a cosine of ``least`` or more that share a group (key, low, high).

    ``members`` is (key, low, high, block, cid, vector) with vectors of ``size`` components.
    """
    kind = np.dtype([
        ("key", "<i8"), ("low", "<i4"), ("high", "<i4"), ("block", "<i4"), ("cid", "<i8"),
        ("vector", "<f8" if wide else "<f4", (size,)),
    ])
    parts = exchange.partitions(members)
    buckets = parts * exchange.BUCKETS

    def pack(batches):
        def rows_of():
            for batch in batches:
                rows = np.empty(batch.num_rows, dtype=kind)
                for i, name in enumerate(kind.names[:-1]):
                    rows[name] = batch.column(i).to_numpy()
                rows["vector"] = batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                yield rows

        def block(rows):
            group = rows["key"].astype(np.uint64)
            mixed = common.mix64(group + (rows["low"].astype(np.uint64) << np.uint64(32)) + rows["high"].astype(np.uint64))
            return exchange.block(rows, mixed % np.uint64(buckets))

        for rows in rows_of():
            yield block(rows)

    def compare(rows: np.ndarray):
        rows = rows[np.lexsort((rows["cid"], rows["high"], rows["low"], rows["key"]))]
        units, cid, block = _units(rows["vector"]), rows["cid"], rows["block"]
        across = rows["low"] != rows["high"]
        change = [rows[c][1:] != rows[c][:-1] for c in ("key", "low", "high")]
        starts = np.flatnonzero(np.append(True, change[0] | change[1] | change[2]))
        sizes = np.diff(np.append(starts, len(rows)))
        rest = np.repeat(sizes, sizes) - (np.arange(len(rows)) - np.repeat(starts, sizes))
        found = []
        at, step = np.flatnonzero((rest > 1) & np.repeat(sizes <= SMALL, sizes)), 0
        while len(at):
            step += 1
            at = at[rest[at] > step]
            cosine = np.einsum("ij,ij->i", units[at], units[at + step])
            good = at[cosine >= least]
            found.append((good, good + step))
        for start, count in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
            part = units[start: start + count]
            i, j = np.nonzero(np.triu(part @ part.T >= least, 1))
            found.append((i + start, j + start))
        if not found:
            return
        i, j = (np.concatenate(v) for v in zip(*found))
        kept = (cid[i] != cid[j]) & (~across[i] | (block[i] != block[j]))
        a, b = np.minimum(cid[i], cid[j])[kept], np.maximum(cid[i], cid[j])[kept]
        pairs = np.unique(np.stack([a, b], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches):
        for rows in exchange.by_bucket(batches, kind):
            yield from compare(rows)

    packed = members.select("key", "low", "high", "block", "cid", "vector").mapInArrow(pack, exchange.PACKED)
    return exchange.dealt(packed, parts).mapInArrow(run, "a bigint, b bigint").distinct()


def components(
    rows: DataFrame, least: float = 0.9, recall: float = RECALL, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    value = F.col(vector)
    node = F.concat(F.hex(F.xxhash64(value)), F.lit("."), F.hex(F.xxhash64(F.lit(1), value)))
    read = written(
        rows.select(F.col(vec_id).alias("_id"), F.when(valid(value), node).alias("node"), value.alias("vector")), "vectors"
    )
    grouped = read.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("_id").alias("low_id"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    classes = written(grouped.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    width, tables = plan(classes.count(), least, recall)
    keyed = classes.select("cid", F.explode(_keys(width, tables)(F.col("vector"))).alias("key"))
    entries = written(keyed, "vector-keys")
    shared = entries.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    members = lookup(entries, written(shared, "vector-shared"), ["key"])
    blocks = F.ceil(F.col("c") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("block", own)
    # A class goes to every pair of blocks that its own block is part of.
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "cid"
    )
    paired = written(paired, "vector-members")
    links = None
    wide = "double" in dict(read.dtypes)["vector"]
    for (size,) in sorted(classes.select(F.size("vector")).distinct().collect()):
        same = classes.where(F.size("vector") == size).select("cid", "vector")
        found = _links(skew_join(paired, same, ["cid"]), size, wide, least)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = rows.sparkSession.createDataFrame([], "a bigint, b bigint")
    links = written(links, "vector-links")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("cid").alias("b"), "copies")
    degrees = lookup(both, copies, ["b"]).groupBy("a").agg(F.sum("copies").alias("others"))
    clusters = duplicate_clusters(links, "a", "b").select(F.col("id").alias("cid"), "cluster")
    named = lookup(classes.select("cid", "node", "low_id", "copies"), clusters, ["cid"], "left")
    named = named.withColumn("root", F.coalesce("cluster", "cid"))
    lows = named.groupBy("root").agg(F.min("low_id").alias("component"))
    told = named.join(lows, "root").join(degrees.withColumnRenamed("a", "cid"), "cid", "left").select(
        "node", "component", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    out = lookup(read.select("_id", "node"), written(told, "vector-answers"), ["node"], "left")
    component = F.when(F.col("n_links").isNotNull(), F.col("component")).otherwise(F.col("_id"))
    return out.select(
        F.col("_id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"),
    )
