"""Positions and running sums over a whole table, without a one-task window.

Rows are cut into range buckets of their order keys, each bucket is ranked on its own, and the
totals of the earlier buckets are added. Bucket edges come from a sample, but any edges give the
same result; they only decide how even the work is.
"""

from __future__ import annotations

import json
import warnings
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.numbers import ColumnOrName, digest_below, div, seeded_digest
from corpusflow.functions.text import let
from corpusflow.operators.sizing import broadcast_if_small, settle
from corpusflow.session import checkpointed

ROWS_PER_BUCKET = 65_536
MAX_BUCKETS = 20_000
SAMPLES_PER_BUCKET = 16


def _key(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def sorted_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """All keys of a small table in order, as JSON; collects them."""
    return [row[0] for row in df.orderBy(*keys).select(F.to_json(_key(keys))).collect()]


def edges_at_or_below(df: DataFrame, keys: Sequence[str], edges: Sequence[str]) -> Column:
    """How many of the sorted ``edges`` (JSON) are at or below the key.

    A binary search in an array that the optimizer folds into one literal.
    """
    if len(keys) == 1:
        # Outside a struct nothing is at or above a null, which is right for a key that sorts
        # first; as an edge it has no use.
        edges = [edge for edge in edges if json.loads(edge).get(keys[0]) is not None]
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = "array<struct<" + ",".join(f"`{k}`:{fields[k]}" for k in keys) + ">>"
    literal = F.from_json(F.lit("[" + ",".join(edges) + "]"), schema)
    if len(keys) == 1:
        # Plain values compare faster than structs.
        literal = literal[keys[0]]
    if not edges:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(edges):
        steps.insert(0, F.lit(step))
        step *= 2

    def search(key: Column) -> Column:
        def advance(low: Column, step: Column) -> Column:
            inside = F.get(literal, low + step - F.lit(1)) <= key
            return F.when(inside, low + step).otherwise(low)

        return F.aggregate(F.array(*steps), F.lit(0), advance)

    return let(F.col(keys[0]) if len(keys) == 1 else _key(keys), search)


def _edges(
    df: DataFrame, keys: Sequence[str], rows: int, buckets: int
) -> tuple[list[str], list[str]]:
    """Keys that cut the table into buckets of about equal size, from a bounded sample.

    Uses the first of the key columns only, as long as no value of theirs fills a bucket alone.
    """
    share = min(1.0, SAMPLES_PER_BUCKET * buckets / rows)
    sample = df.select(*keys)
    picked = sorted_keys(sample.sample(fraction=share, seed=7) if share < 1.0 else sample, keys)
    if not picked:
        return list(keys), []
    stride = len(picked) / buckets
    edges = [picked[int(i * stride)] for i in range(1, buckets)]
    parsed = [json.loads(key) for key in picked]
    for n in range(1, len(keys)):
        ties = Counter(tuple(row.get(k) for k in keys[:n]) for row in parsed)
        if max(ties.values()) <= stride:
            return list(keys[:n]), edges
    return list(keys), edges


def prefix_sums(
    df: DataFrame,
    order: Sequence[str],
    weight: ColumnOrName | None = None,
    partition: Sequence[str] = (),
    out: str = "index",
    rows: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the sum of ``weight`` over all earlier rows (of the same ``partition``).

    Without a weight every row counts 1, which makes ``out`` the 0-based position. ``order`` must
    tell any two rows of a partition apart. Partitions of any size are cut into buckets as well. A
    null weight counts 0.
    """
    order, partition = list(order), list(partition)
    keys = partition + [c for c in order if c not in partition]
    value = F.lit(1).cast("long") if weight is None else (
        F.col(weight) if isinstance(weight, str) else weight
    )
    if weight is not None:
        value = F.coalesce(value, F.lit(0))
    rows = df.count() if rows is None else rows
    buckets = min(MAX_BUCKETS, -(-rows // rows_per_bucket)) if rows else 1
    cut_by, edges = _edges(df, keys, rows, buckets) if buckets > 1 else (keys, [])

    def within(groups: Sequence[str]) -> Column:
        window = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(*order)
        if weight is None:
            return F.row_number().over(window).cast("long") - F.lit(1)
        upto = F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, 0))
        return upto - value

    if not edges:
        return df.withColumn(out, within(partition))

    bucketed = df.withColumn("_bucket", edges_at_or_below(df, cut_by, edges))
    totals = bucketed.groupBy(*partition, "_bucket").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*(partition or [F.lit(0)])).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *[F.col(p).alias(f"_p_{i}") for i, p in enumerate(partition)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"),
    )
    if not partition:
        # One row per bucket, MAX_BUCKETS at most.
        offsets = F.broadcast(offsets)
    else:
        # One row per bucket and one more per partition.
        offsets = settle(offsets)
    same = F.col("_bucket") == F.col("_b")
    for i, p in enumerate(partition):
        same = same & F.col(p).eqNullSafe(F.col(f"_p_{i}"))
    ranked = bucketed.withColumn("_within", within([*partition, "_bucket"]))
    return (
        ranked.join(offsets, same, "left")
        .withColumn(out, F.col("_within") + F.col("_offset"))
        .select(*df.columns, out)
    )


def range_buckets(
    df: DataFrame, order: Sequence[str], rows: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> Column | None:
    """Number of the range of ``order`` in which a row lies: ranges of about equal size, from a sample, in order.

    None where one range holds all rows.
    """
    rows = df.count() if rows is None else rows
    buckets = min(MAX_BUCKETS, -(-rows // rows_per_bucket)) if rows else 1
    cut_by, edges = _edges(df, list(order), rows, buckets) if buckets > 1 else (list(order), [])
    return edges_at_or_below(df, cut_by, edges) if edges else None


def last_values(
    df: DataFrame, order: Sequence[str], value: str, out: str = "last", rows: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add the last non-null ``value`` at or before each row, over the whole table.

    Ranges of the order are searched each on its own; what a range ends with is carried into those after it.
    """
    bucket = range_buckets(df, order, rows, rows_per_bucket)
    if bucket is None:
        upto = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(upto))
    bucketed = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # MAX_BUCKETS rows at most.
    ends = bucketed.where(F.col(value).isNotNull()).groupBy("_bucket").agg(F.max_by(value, _key(order)).alias("_end"))
    every = bucketed.select("_bucket").distinct().join(ends, "_bucket", "left")
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.broadcast(every.select(F.col("_bucket").alias("_b"), F.last("_end", ignorenulls=True).over(earlier).alias("_before")))
    found = bucketed.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
    return found.join(carried, F.col("_bucket") == F.col("_b"), "left").withColumn(
        out, F.coalesce("_own", "_before")
    ).select(*df.columns, out)


def global_index(df: DataFrame, order: Sequence[str], out: str = "index", **options) -> DataFrame:
    """0-based position of every row in ``order``."""
    return prefix_sums(df, order, out=out, **options)


def index_range(df: DataFrame, order: Sequence[str], start: int, end: int, **options) -> DataFrame:
    """Rows at positions ``start`` to ``end``, both included."""
    return global_index(df, order, **options).where(F.col("index").between(start, end))


def shard_contiguous(
    df: DataFrame, n: int, order: Sequence[str], out: str = "shard", **options
) -> DataFrame:
    """Contiguous shards of near-equal size; the first ``rows % n`` hold one row more."""
    rows = df.count()
    small, extra = divmod(rows, n)
    i = F.col("_index")
    head = F.lit(extra * (small + 1))
    shard = F.when(i < head, div(i, small + 1)).otherwise(
        F.lit(extra) + div(i - head, max(small, 1))
    )
    indexed = global_index(df, order, out="_index", rows=rows, **options)
    return indexed.withColumn(out, shard.cast("long")).drop("_index")


def shard_files_ceil(
    files: DataFrame, n: int, order: Sequence[str], out: str = "shard", **options
) -> DataFrame:
    """``ceil(files / n)`` files per shard; the last shards may stay empty."""
    rows = files.count()
    per_shard = max(1, -(-rows // n))
    indexed = global_index(files, order, out="_index", rows=rows, **options)
    return indexed.withColumn(out, div("_index", per_shard)).drop("_index")


def shard_files_floor(
    files: DataFrame,
    n: int,
    chunk: str,
    order: Sequence[str],
    first_shard: int = 0,
    out: str = "shard",
    **options,
) -> DataFrame:
    """``files // n`` files per shard within a chunk, the last shard takes the rest.

    Shards are numbered on from chunk to chunk. A chunk with fewer than ``n`` files has all of them
    in its last shard.
    """
    counts = files.groupBy(chunk).agg(F.count("*").alias("_files"))
    chunks = global_index(checkpointed(counts), [chunk], out="_chunk")
    indexed = prefix_sums(files, order, partition=[chunk], out="_index", **options)
    per_shard = div("_files", n)
    position = F.when(
        per_shard > 0, F.least(div("_index", F.greatest(per_shard, F.lit(1))), F.lit(n - 1))
    ).otherwise(F.lit(n - 1))
    shard = F.lit(first_shard) + F.col("_chunk") * F.lit(n) + position
    # Files without a chunk are a chunk of their own.
    chunks = broadcast_if_small(chunks.withColumnRenamed(chunk, "_of"))
    return (
        indexed.join(chunks, F.col(chunk).eqNullSafe(F.col("_of")))
        .withColumn(out, shard.cast("long"))
        .select(*files.columns, out)
    )


def shard_name(prefix: ColumnOrName, shard: ColumnOrName, n: int) -> Column:
    """``prefix-00003-of-00008.jsonl``."""
    prefix = F.col(prefix) if isinstance(prefix, str) else prefix
    shard = F.col(shard) if isinstance(shard, str) else shard
    return F.format_string("%s-%05d-of-%05d.jsonl", prefix, shard.cast("long"), F.lit(n).cast("long"))


def folder_name(prefix: ColumnOrName, shard: ColumnOrName, n: ColumnOrName | int) -> Column:
    """``prefix_3``, or the bare prefix where there is one shard only."""
    prefix = F.col(prefix) if isinstance(prefix, str) else prefix
    shard = F.col(shard) if isinstance(shard, str) else shard
    n = F.lit(n) if isinstance(n, int) else (F.col(n) if isinstance(n, str) else n)
    return F.when(n == 1, prefix).otherwise(F.concat_ws("_", prefix, shard.cast("string")))


def running_total(
    chunks: DataFrame, order: Sequence[str], value: str, out: str = "total_so_far", **options
) -> DataFrame:
    """Sum of ``value`` up to and including each chunk; a null value adds nothing."""
    before = prefix_sums(chunks, order, weight=value, out="_before", **options)
    return before.withColumn(out, F.col("_before") + F.coalesce(F.col(value), F.lit(0))).drop("_before")


def last_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each group; Spark cuts every group to ``n`` before the shuffle too."""
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where(
        F.col("_rank") <= n
    ).drop("_rank")


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each group; the last order column breaks ties."""
    newest = F.max_by(F.struct(*[c for c in df.columns if c not in keys]), _key(order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def _ratios(ratios: str | Sequence[float], names: Sequence[str]) -> list[float]:
    listed = [float(r) for r in (ratios.split(",") if isinstance(ratios, str) else ratios)]
    if len(listed) != len(names):
        raise ValueError("one ratio per name")
    if any(later > earlier for earlier, later in zip(listed, listed[1:])):
        warnings.warn(f"a later split is larger than one before it: {listed}", stacklevel=3)
    return listed


def split_by_hash(
    df: DataFrame,
    ratios: str | Sequence[float],
    seed: int,
    ids: Sequence[str],
    names: Sequence[str] = ("train", "validation", "test"),
    out: str = "split",
) -> DataFrame:
    """Splits with shares of about ``ratios``, by the digest of the ids: a row's split depends on nothing but itself.

    Nothing is counted or moved, and rows that are added later leave the others where they are.
    """
    listed = _ratios(ratios, names)
    digest, done, split = seeded_digest(seed, *ids), 0.0, None
    last = max(i for i, ratio in enumerate(listed) if ratio > 0)
    for i, (ratio, name) in enumerate(zip(listed, names)):
        done += ratio
        # The last split that has a share takes the rest, whatever the float sum says.
        branch = (digest_below(digest, 1.0 if i >= last else done / sum(listed)), F.lit(name))
        split = F.when(*branch) if split is None else split.when(*branch)
    return df.withColumn(out, split)


def split_by_ratio(
    df: DataFrame,
    ratios: str | Sequence[float],
    order: Sequence[str],
    names: Sequence[str] = ("train", "validation", "test"),
    out: str = "split",
    **options,
) -> DataFrame:
    """Contiguous splits with shares ``ratios`` (text such as ``969,30,1``), normalized by sum."""
    ratios = _ratios(ratios, names)
    rows, total = df.count(), sum(ratios)
    i, done, split = F.col("_index"), 0.0, None
    for ratio, name in zip(ratios, names):
        done += ratio
        # The last bound is the row count, whatever the float sum says.
        bound = rows if name == names[-1] else round(rows * (done / total))
        branch = (i < F.lit(bound), F.lit(name))
        split = F.when(*branch) if split is None else split.when(*branch)
    return global_index(df, order, out="_index", rows=rows, **options).withColumn(out, split).drop("_index")


def shuffle_seeded(df: DataFrame, seed: int, ids: Sequence[str]) -> DataFrame:
    """All rows in an order drawn from ``seed`` and the ids."""
    return df.orderBy(seeded_digest(seed, *ids), *ids)


def shuffled_index(
    df: DataFrame, seed: int, ids: Sequence[str], out: str = "position", **options
) -> DataFrame:
    """Position of every row in the order of ``shuffle_seeded``."""
    digest = df.withColumn("_digest", seeded_digest(seed, *ids))
    return global_index(digest, ["_digest", *ids], out=out, **options).drop("_digest")
