"""Near-duplicate documents by circulant MinHash, with every link confirmed on the full shingle sets.

Two permutations give all coordinates of a signature: the first scatters shingles over a ring of 2^32
places, the second orders the places, and coordinate ``k`` reads the order through a shift of the ring
by ``k`` steps. Bands of coordinates are buckets. Rows with equal shingle sets become one class before
anything is compared, so copies cost nothing, however many there are.

Every class is first compared with one hub of its bucket, confirmed links are closed to components, and
only buckets that still hold several components go on. There all pairs of different components meet as
bitmaps inside tasks: each bit says whether the shingles that fall to it are odd in number, so each bit
that two sets do not share stands for a shingle that one of them lacks, and a pair becomes a row only if
its bitmaps leave a link possible. A first pass names one such pair of every two components, so that
large groups close; a second one names all that are left between components. A bucket of many classes is
cut into blocks, and a task compares two of them at a time. So no link between classes that share a bucket
is lost. 60 bands of 7 miss a pair at similarity 0.8 with a probability of 7e-7; pairs at 0.4 share a
bucket with one of 0.1.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z; fewer words than a shingle are one
shingle; a null or wordless text has the empty set, is linked with nothing and is its own component. Rows
with equal ids are rows of their own that share an id. A null id never represents a component that has
another id. Columns beside id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common, exchange
from corpusflow.llm.common import written
from corpusflow.operators.dedup import duplicate_clusters
from corpusflow.operators.sizing import broadcast_if_small, lookup, skew_join

BANDS, ROWS = 60, 7
#: Distinct shingles whose minima are taken together; their 32-bit places stay in the cache.
CACHED = 1 << 15
#: Cells into which the shingles of a set are counted, and the highest count.
CELLS, FULL = 256, 255
#: Bits of the bitmap of a set, a multiple of 64.
BITS = 1 << 10
#: Classes of a bucket that meet inside one task at a time.
BLOCK = 1 << 11
#: Pairs that a task gathers before it hands them on.
FOUND = 1 << 16
#: A class in a bucket. ``side`` 0 meets ``side`` 1 only; those of 2 meet each other.
MEMBER = np.dtype([
    ("key", "<i8"), ("part", "<i8"), ("side", "<i4"), ("n", "<i8"), ("node", "S16"), ("component", "S16"), ("bits", "<u8", BITS // 64),
])


def order(ring: np.ndarray, out: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The second permutation, of 32-bit places on the ring, without new arrays."""
    np.right_shift(ring, np.uint32(16), out=other)
    np.bitwise_xor(ring, other, out=out)
    out *= np.uint32(0x85EBCA6B)
    np.right_shift(out, np.uint32(13), out=other)
    out ^= other
    out *= np.uint32(0xC2B2AE35)
    return out


def circulant_minima(places: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """(sets, n) minima of the second permutation under ``n`` shifts of the ring."""
    out = np.empty((n, len(starts)), dtype=np.uint32)
    shifted, value, other = places.copy(), np.empty_like(places), np.empty_like(places)
    for k in range(n):
        np.minimum.reduceat(order(shifted, value, other), starts, out=out[k])
        shifted += np.uint32(0x9E3779B9)  # the step of the ring
    return out.T


def _sets(texts: pa.Array, n: int):
    """Per text its sorted distinct shingle hashes."""
    words, _, edges, _ = common.hash_words(texts)
    for i in range(len(texts)):
        found = words[edges[i]: edges[i + 1]]
        yield np.unique(common.shingles(found, n)) if len(found) else found


def _blocks(sets):
    """Runs of (row, set) with about CACHED shingles."""
    rows, held, size = [], [], 0
    for row, values in enumerate(sets):
        if not len(values):
            continue
        rows.append(row)
        held.append(values)
        size += len(values)
        if size >= CACHED:
            yield rows, held
            rows, held, size = [], [], 0
    if rows:
        yield rows, held


def _sketch(n: int, bands: int, rows: int):
    """text -> (number of shingles, digest of the set, one key per band)."""

    def of(texts: pa.Array) -> pa.Array:
        counts = np.zeros(len(texts), dtype=np.int64)
        at, nodes, keys = [], [], []
        for found, sets in _blocks(_sets(texts, n)):
            sizes = np.array([len(s) for s in sets])
            counts[found] = sizes
            starts = np.cumsum(sizes) - sizes
            flat = np.concatenate(sets)
            at += found
            nodes.append(common.digests(flat, starts))
            # The first permutation scatters shingles over the ring.
            places = (common.mix64(flat ^ np.uint64(0x452821E638D01377)) >> np.uint64(32)).astype(np.uint32)
            minima = circulant_minima(places, starts, bands * rows).reshape(len(sets), bands, rows)
            key = np.full((len(sets), bands), 0, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
            for j in range(rows):
                key = common.mix64(key * np.uint64(0x9FB21C651E98DF25) + minima[:, :, j])
            keys.append(key.view(np.int64))
        at = np.array(at, dtype=np.int64)
        sizes = np.zeros(len(texts), dtype=np.int64)
        sizes[at] = bands
        flat = np.concatenate(keys).ravel() if keys else np.zeros(0, dtype=np.int64)
        node = common.binary16(np.concatenate(nodes) if nodes else np.zeros((0, 2)), at, len(texts))
        return pa.StructArray.from_arrays(
            [pa.array(counts), node, common.lists(flat, sizes)], ["n_shingles", "node", "keys"]
        )

    return F.arrow_udf(of, "struct<n_shingles:bigint,node:binary,keys:array<bigint>>")


def _full_sets(n: int):
    """text -> (digest of the set, sorted distinct shingle hashes, how many fall into each cell, bitmap of odd counts)."""

    def of(texts: pa.Array) -> pa.Array:
        held = list(_sets(texts, n))
        sizes = np.array([len(s) for s in held], dtype=np.int64)
        at = np.flatnonzero(sizes)
        flat = np.concatenate(held) if held else np.zeros(0, dtype=np.uint64)
        pairs = np.zeros((0, 2))
        if len(at):
            pairs = common.digests(flat, (np.cumsum(sizes) - sizes)[at])

        def counted(places):
            owner = np.repeat(np.arange(len(texts)) * places, sizes)
            return np.bincount(owner + (flat % np.uint64(places)).astype(np.int64), minlength=len(texts) * places)

        def binary(values, width):
            data = pa.py_buffer(values.tobytes())
            return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(texts), [None, data]).cast(pa.binary())

        cells = np.minimum(counted(CELLS), FULL).astype(np.uint8)
        odd = np.packbits((counted(BITS) & 1).astype(bool), bitorder="little")
        return pa.StructArray.from_arrays(
            [common.binary16(pairs, at, len(texts)), common.lists(flat.view(np.int64), sizes), binary(cells, CELLS), binary(odd, BITS // 8)],
            ["node", "set", "cells", "bits"],
        )

    # Marked so that a filter on the result does not run it a second time, in a second Python worker a task.
    return F.arrow_udf(of, "struct<node:binary,set:array<bigint>,cells:binary,bits:binary>").asNondeterministic()


def _may_link(least: int):
    """(cells, cells, size, size) -> whether the sets can be that similar.

    Two sets share at most the smaller count of every cell. A full cell tells nothing.
    """

    def of(x: pa.Array, y: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        one, other = (common.flat_bytes(c)[0].reshape(-1, CELLS) for c in (x, y))
        n, m = n.to_numpy().astype(np.int64), m.to_numpy().astype(np.int64)
        lower = np.minimum(one, other)
        shared = np.where((lower == FULL).any(axis=1), np.minimum(n, m), lower.sum(axis=1, dtype=np.int64))
        return pa.array(100 * shared >= least * (n + m - shared))

    return F.arrow_udf(of, "boolean")


def sketches(docs: DataFrame, doc_id: str, text: str, n: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(_id, _ref, n_shingles, node, keys), written down; ``_ref`` finds the text again."""
    read = docs.select(
        F.col(doc_id).alias("_id"), common.text_key(F.col(text)).alias("_ref"), _sketch(n, bands, rows)(F.col(text)).alias("s")
    )
    return written(read.select("_id", "_ref", "s.*"), "minhash")


def confirm(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) of classes with ``100 * intersection >= least * union`` on their full sets.

    Counts by cell refute most pairs below ``least``, so that their sets need not travel.
    """
    slim = sets.select("node", "cells", F.size("set").alias("size"))
    near = lookup(pairs, slim.toDF("a", "ca", "na"), ["a"])
    near = lookup(near, slim.toDF("b", "cb", "nb"), ["b"]).where(_may_link(least)("ca", "cb", "na", "nb"))
    pairs = written(near.select("a", "b"), "near")
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    counts = pairs.groupBy("b").agg(F.count("*").alias("_n"))
    both = skew_join(pairs.join(left, "a"), right, ["b"], rows=pairs.count(), counts=counts)
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return both.where(F.lit(100) * shared >= F.lit(least) * union).select("a", "b")


def _near(x: np.ndarray, y: np.ndarray, both: np.ndarray, least: int) -> np.ndarray:
    """Whether sets of ``both`` shingles together can be that similar, by their bitmaps.

    100 |intersection| >= least |union| turned into shingles that one side lacks.
    """
    apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return (100 + least) * apart <= (100 - least) * both


def compared(members: DataFrame, least: int, parts: int, first: bool, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b) of a bucket and of different components whose bitmaps leave a link possible.

    ``members`` is (key, size, node, n, component, bits). With ``first``, one pair of every two components
    that meet in a task will do. A bucket of more than ``block`` classes is cut into blocks, and each two
    of them meet by themselves, so a task holds two blocks of it at a time.
    """
    width = BITS // 8
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("long")
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks"))
    cut = members.withColumn("blocks", blocks).withColumn("own", own)
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int"))
    part = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
    rows = cut.select("key", part.alias("part"), side.alias("side"), "n", "node", "component", "bits")
    buckets = parts * exchange.BUCKETS

    def records(batches):
        for batch in batches:
            out = np.empty(batch.num_rows, dtype=MEMBER)
            for name, column in zip(("key", "part", "side", "n"), batch.columns):
                out[name] = column.to_numpy(zero_copy_only=False)
            for name, column in zip(("node", "component"), batch.columns[4:]):
                out[name] = common.flat_bytes(column)[0].view("S16")
            out["bits"] = common.flat_bytes(batch.column(6))[0].reshape(-1, width).view("<u8")
            yield out

    def pack(batches):
        def packed(found):
            place = common.mix64(found["key"].view(np.uint64) + common.mix64(found["part"].astype(np.uint64)))
            return exchange.block(found, (place % np.uint64(buckets)).astype(np.int64))

        return exchange.gathered(records(batches), packed)

    def binary(values):
        data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(values), [None, data]).cast(pa.binary())

    def compare(rows):
        rows = rows[np.lexsort((rows["part"], rows["key"]))]
        key, cell, side, n, bits = (np.ascontiguousarray(rows[c]) for c in ("key", "part", "side", "n", "bits"))
        names, component = np.unique(rows["component"], return_inverse=True)
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])))
        sizes = np.diff(np.append(starts, len(rows)))
        rest = np.repeat(sizes, sizes) - (np.arange(len(rows)) - np.repeat(starts, sizes))  # rows to the end of the unit

        def told(held):
            i, j = (np.concatenate(v) for v in zip(*held))
            if first:
                low, high = np.minimum(component[i], component[j]), np.maximum(component[i], component[j])
                one = np.unique(low * len(names) + high, return_index=True)[1]
                i, j = i[one], j[one]
            return i, j

        held, step, at = [(np.zeros(0, np.int64),) * 2], 0, np.flatnonzero(rest > 1)
        while len(at):
            step += 1
            at = at[rest[at] > step]
            later = at + step
            small, large = np.minimum(n[at], n[later]), np.maximum(n[at], n[later])
            meet = (component[at] != component[later]) & ((side[at] != side[later]) | (side[at] == 2))
            meet &= 100 * small >= least * large
            i, j = at[meet], later[meet]
            near = _near(bits[i], bits[j], n[i] + n[j], least)
            held.append((i[near], j[near]))
            if sum(len(i) for i, _ in held) >= FOUND:
                held = [told(held)]
                if not first or len(held[0][0]) >= FOUND // 2:
                    yield pa.RecordBatch.from_arrays([binary(rows["node"][v]) for v in held[0]], ["x", "y"])
                    held = [(np.zeros(0, np.int64),) * 2]
        yield pa.RecordBatch.from_arrays([binary(rows["node"][v]) for v in told(held)], ["x", "y"])

    def run(batches):
        for rows in exchange.by_bucket(batches, MEMBER):
            yield from compare(rows)

    found = exchange.dealt(rows.mapInArrow(pack, exchange.PACKED), parts).mapInArrow(run, "x binary, y binary")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def clusters_in_buckets(members: DataFrame, sets: DataFrame, least: int, block: int = BLOCK) -> DataFrame:
    """(node, cluster) for every node that is not the smallest of its component.

    Components are those of all links between classes of a bucket. ``members`` is (key, node, n), in
    buckets of several nodes only. A pair inside one component need not be looked at.
    """
    hubs = members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("h")).select("key", "h.*")
    hubs = written(hubs.select("key", F.col("node").alias("hub"), F.col("n").alias("nb")), "hubs")
    met = skew_join(members.withColumnRenamed("n", "na"), hubs, ["key"])
    fair = F.lit(100) * F.least("na", "nb") >= F.lit(least) * F.greatest("na", "nb")
    # The hub is the smallest node of its bucket.
    tested = written(met.where((F.col("node") != F.col("hub")) & fair).select(
        F.col("hub").alias("a"), F.col("node").alias("b")
    ).distinct(), "pairs")
    links = written(confirm(tested, sets, least), "links")
    parts, left = exchange.partitions(members), members
    for first in (True, False):
        clusters = duplicate_clusters(links, "a", "b").select(F.col("id").alias("node"), "cluster")
        now = lookup(left, clusters, ["node"], "left").select("key", "node", "n", F.coalesce("cluster", "node").alias("component"))
        # A bucket is open while it holds several components.
        mixed = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"))
        mixed = written(mixed.where(F.col("x") != F.col("y")).select("key", "size"), "mixed")
        if mixed.isEmpty():
            return clusters
        open_now = written(lookup(now, mixed, ["key"]), "open")
        with_bits = lookup(open_now, sets.select("node", "bits"), ["node"])
        fresh = compared(with_bits, least, parts, first, block).join(tested, ["a", "b"], "left_anti")
        fresh = written(fresh, "pairs")
        links = links.unionByName(written(confirm(fresh, sets, least), "links"))
        tested = tested.unionByName(fresh)
        left = open_now.select("key", "node", "n")
    return duplicate_clusters(links, "a", "b").select(F.col("id").alias("node"), "cluster")


def components(
    docs: DataFrame,
    n: int = 5,
    least: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept, _ref, _root) per row: near-duplicate components of whole texts.

    ``least`` is the least similarity in hundredths. ``_ref`` is 128 bits of the text; ``_root`` names
    a component of several rows and is null for a row of its own.
    """
    read = sketches(docs, doc_id, text, n, bands, rows)
    classes = written(
        read.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.min("_id").alias("low"), F.min("_ref").alias("_ref"), F.count("*").alias("copies"),
            F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
        ),
        "classes",
    )
    entries = classes.select(F.explode("keys").alias("key"), "node", "n")
    shared = entries.groupBy("key").agg(F.count("*").alias("_c")).where(F.col("_c") > 1).select("key")
    members = written(lookup(entries, written(shared, "shared"), ["key"]), "members")
    # Texts are read again only where a class shares a bucket.
    wanted = members.select("node").distinct()
    refs = lookup(classes.select("node", "_ref"), wanted, ["node"]).select("_ref").distinct()
    again = lookup(docs.select(common.text_key(F.col(text)).alias("_ref"), F.col(text).alias("_t")), written(refs, "refs"), ["_ref"])
    full = again.dropDuplicates(["_ref"]).select(_full_sets(n)(F.col("_t")).alias("s")).select("s.*")
    sets = written(full.where(F.col("node").isNotNull()).groupBy("node").agg(F.first(F.struct("set", "cells", "bits")).alias("s")).select("node", "s.*"), "sets")
    clusters = clusters_in_buckets(members, sets, least)
    # Only classes of several rows or of a larger component differ from their own id.
    grouped = lookup(classes.select("node", "low", "copies"), clusters, ["node"], "left").withColumn(
        "root", F.coalesce("cluster", "node")
    )
    lows = grouped.groupBy("root").agg(F.min("low").alias("component"), F.sum("copies").alias("rows"))
    several = lows.where(F.col("rows") > 1).select("root", "component")
    named = written(lookup(grouped.select("node", "root"), several, ["root"]).select("node", "root", "component"), "named")
    out = lookup(read.select("_id", "_ref", "n_shingles", "node"), named, ["node"], "left")
    component = F.when(F.col("root").isNotNull(), F.col("component")).otherwise(F.col("_id"))
    return out.select(
        F.col("_id").alias(doc_id), "n_shingles", component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"), "_ref", F.col("root").alias("_root"),
    )


def keep_one(docs: DataFrame, n: int = 5, least: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component, the one of its smallest id.

    Rows are found again by id and text hash, so rows that share an id are told apart and null ids
    count. Of repeated rows one stays. Only what goes is looked up; texts are not shuffled.
    """
    found = written(components(docs, n, least, doc_id, text), "components")
    rows = found.where(F.col("_root").isNotNull()).select(F.col(doc_id).alias("_id"), "_ref", "_root")
    best = rows.groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_ref")).alias("best"))
    is_best = F.col("_id").eqNullSafe(F.col("best._id")) & (F.col("_ref") == F.col("best._ref"))
    marked = written(skew_join(rows, best, ["_root"]).select("_id", "_ref", is_best.alias("stays")), "marked")
    gone = written(marked.where(~F.col("stays")).select("_id", "_ref").distinct(), "gone")
    twice = marked.where("stays").groupBy("_id", "_ref").count().where(F.col("count") > 1)
    twice = written(twice.select("_id", "_ref"), "twice")

    def without(df: DataFrame, these: DataFrame, how: str) -> DataFrame:
        these = broadcast_if_small(these)
        same = df[doc_id].eqNullSafe(these["_id"]) & common.text_key(df[text]).eqNullSafe(these["_ref"])
        return df.join(these, same, how)

    left = without(docs, gone, "left_anti")
    if twice.isEmpty():
        return left
    again = without(left, twice, "left_semi").dropDuplicates([doc_id, text])
    return without(left, twice, "left_anti").unionByName(again)
