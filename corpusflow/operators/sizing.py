"""Size checks before anything is broadcast, and joins that bear hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import checkpointed

# A side may be broadcast up to these bounds.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Below this many rows no key can be hot enough to matter.
HOT_ROWS = 1_000_000
# A key is hot when it holds more than this share of the rows, so there are at most 1/share of them.
HOT_SHARE = 0.001


def approx_bytes(df: DataFrame) -> Column:
    """Rough bytes of a row: lengths of strings, 8 for anything else, array elements counted."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            size = F.octet_length(F.col(f"`{field.name}`")) + F.lit(16)
        elif kind == "array":
            size = F.size(F.col(f"`{field.name}`")) * F.lit(16) + F.lit(16)
        else:
            size = F.lit(8)
        total = total + F.coalesce(size.cast("long"), F.lit(8))
    return total


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within the bounds; reads at most ``max_rows + 1`` rows."""
    head = df.select(approx_bytes(df).alias("bytes")).limit(max_rows + 1)
    row = head.agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).first()
    return row["rows"] <= max_rows and (row["bytes"] or 0) <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint if it fits; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def settle(df: DataFrame) -> DataFrame:
    """A derived table, expected to be short, written down once and then broadcast if it fits."""
    return broadcast_if_small(checkpointed(df))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows: int | None = None,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi-join (``inner`` or ``left``) whose left side may hold a large share under one key.

    A key above ``hot_share`` of the left rows is salted: its left rows are dealt out over as many
    salts as bring each below that share, and its right rows are repeated for every salt. There are
    at most ``1 / hot_share`` such keys, and only they are broadcast. Left rows are counted, so
    write an expensive left side down first; where the rows per key are known already, give them
    as ``counts`` (on, _n).
    """
    on = list(on)
    rows = left.count() if rows is None else rows
    if rows <= hot_rows:
        return left.join(right, on, how)
    bound = max(1, int(rows * hot_share))
    if counts is None:
        counts = left.groupBy(*on).agg(F.count("*").alias("_n"))
    needed = F.ceil(F.col("_n") / F.lit(bound)).cast("int").alias("_salts")
    hot = F.broadcast(counts.where(F.col("_n") > bound).select(*on, needed))
    others = [F.col(c) for c in left.columns if c not in on]
    deal = F.xxhash64(*others) if others else F.monotonically_increasing_id()
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(deal, F.col("_salts")).cast("int")).otherwise(F.lit(0))
    salts = F.when(F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(
        F.array(F.lit(0))
    )
    dealt = left.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    repeated = right.join(hot, on, "left").withColumn("_salt", F.explode(salts)).drop("_salts")
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")


def lookup(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a table with one row per key: by broadcast if it fits, else salted and shuffled."""
    if fits(table, max_rows, max_bytes):
        return left.join(F.broadcast(table), list(on), how)
    return skew_join(left, table, on, how)
