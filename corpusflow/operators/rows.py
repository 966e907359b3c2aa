"""Projections, filters, samples and unions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.numbers import ColumnOrName, as_column, digest_below, seeded_digest
from corpusflow.functions.text import leading_number, number_in, strip
from corpusflow.operators.index import shuffle_seeded
from corpusflow.operators.selection import kth_keys
from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.session import checkpointed


def keep_only(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.select(F.col(column).alias(name or column))


def filter_min_score(df: DataFrame, column: str, least: float) -> DataFrame:
    """Rows with a score of at least ``least``; pushed down into Parquet scans."""
    return df.where(F.col(column) >= F.lit(least))


def filter_rows(
    df: DataFrame, predicate: Column | Callable[[pd.DataFrame], pd.Series], columns: Sequence[str] = ()
) -> DataFrame:
    """Rows for which a column expression holds, or a function over batches of ``columns``."""
    if isinstance(predicate, Column):
        return df.where(predicate)
    keep = F.pandas_udf(lambda batch: predicate(batch).astype(bool), "boolean")
    return df.where(keep(F.struct(*[F.col(c) for c in columns])))


def strip_non_empty(df: DataFrame, column: str) -> DataFrame:
    """The column stripped; rows that are null or empty after that drop out."""
    return df.withColumn(column, strip(column)).where(F.length(column) > 0)


def exclude_values(df: DataFrame, column: str, values: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose value is not listed; a null value stays. The list may be a one-column table."""
    if isinstance(values, DataFrame):
        listed = values.toDF(column)
        return df.join(broadcast_if_small(listed), column, "left_anti")
    return df.where(F.col(column).isNull() | ~F.col(column).isin(list(values)))


def iteration_filter(df: DataFrame, name: str, every: int, out: str = "iteration") -> DataFrame:
    """Rows whose name starts with a positive multiple of ``every``; add that number."""
    return df.withColumn(out, leading_number(name)).where(
        (F.col(out) > 0) & (F.col(out) % F.lit(every) == 0)
    )


def distinct_sources(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def sort_numeric(df: DataFrame, name: str) -> DataFrame:
    """Order by the number in the name; equal numbers by name."""
    return df.orderBy(number_in(name), name)


def take_first(df: DataFrame, n: int, seed: int, ids: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of the seeded order; all rows for ``n <= 0``.

    The ``n``-th key is selected by counting, so that only the rows up to it are moved and sorted, over as many
    tasks as they need. Rows of one id come in the order of their contents; of equal rows any will do.
    """
    if n <= 0:
        return shuffle_seeded(df, seed, ids)
    content = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    keyed = df.withColumn("_key", F.concat(seeded_digest(seed, *ids), content))
    keys = checkpointed(keyed.select(F.col("_key").alias("key")))
    cut = kth_keys(keys, df.sparkSession.range(n, n + 1).select(F.col("id").alias("k"))).first()
    if cut is None:
        return shuffle_seeded(df, seed, ids)
    before = keyed.where(F.col("_key") < cut["key"])
    last = keyed.where(F.col("_key") == cut["key"]).dropDuplicates(["_key"])
    last = last.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n - cut["below"])))).drop("_copy")
    return shuffle_seeded(before.unionByName(last).drop("_key"), seed, ids)


def sample_rate(df: DataFrame, rate: float, seed: int, ids: Sequence[str]) -> DataFrame:
    """A share of the rows, the same ones on any partitioning."""
    return df.where(digest_below(seeded_digest(seed, *ids), rate))


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_shuffled(parts: Sequence[DataFrame], seed: int, ids: Sequence[str]) -> DataFrame:
    """All parts in one seeded order, sorted by range over the cluster."""
    return shuffle_seeded(union_sources(parts), seed, ids)


def expand_shards(sources: DataFrame, n_shards: ColumnOrName, out: str = "shard") -> DataFrame:
    """One row per source and shard 0 … n-1; none for a source without shards."""
    n = as_column(n_shards).cast("long")
    shards = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return sources.withColumn(out, F.explode(shards))


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema
) -> DataFrame:
    """A user function over Arrow batches, in as many tasks as ``df`` has partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return df.mapInArrow(run, schema)
