"""The k-th smallest key of a table, or of each group of it, without sorting and without a task that sees all rows.

Keys are strings in which byte order is the order that is asked for. Each round counts the keys of the
open groups by their next characters, takes the part that holds the k-th key, and skips all characters which the
keys of that part share; it moves one row per group, part and task. A few rounds do for any table: every
round divides what is left by up to the number of parts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators.sizing import broadcast_if_small
from corpusflow.session import checkpointed

#: Characters of the first round and of each after it: parts are counted for as many hexadecimal digits.
FIRST, MORE = 3, 2
MAX_ROUNDS = 200

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@F.arrow_udf(T.StringType())
def _float_key(values: pa.Array) -> pa.Array:
    """Bits of doubles, turned so that they sort as the numbers do; NaN last, both zeros equal."""
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.where(np.isnan(x), np.nan, x) + 0.0
    bits = x.view(np.uint64)
    turned = np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))
    texts = [f"{b:016X}" for b in turned.tolist()]
    return pa.array(texts, pa.string(), mask=values.is_null().to_numpy(zero_copy_only=False))


def sort_key(df: DataFrame, column: str) -> Column:
    """A column as a string of hexadecimal digits with the same order; null stays null."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.TimestampType):
        kind, c = T.LongType(), F.unix_micros(c)
    if isinstance(kind, T.DateType):
        kind, c = T.LongType(), F.unix_date(c)
    if isinstance(kind, _WHOLE):
        # The lowest number becomes 0.
        return F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _float_key(c.cast("double"))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.hex(c)
    raise TypeError(f"no sort key for {kind.simpleString()}")


def joined_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Several columns, none of them null, as one key: a character below all digits ends each part."""
    return F.concat_ws("!", *[sort_key(df, c) for c in columns])


def _shared(a: Column, b: Column) -> Column:
    """How many characters two different strings have in common at their start."""
    places = F.sequence(F.lit(1), F.greatest(F.length(a), F.length(b)))
    same = F.transform(places, lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1)))
    return F.array_position(same, False).cast("int") - 1


def kth_keys(keys: DataFrame, wanted: DataFrame, by: Sequence[str] = (), key: str = "key", k: str = "k") -> DataFrame:
    """(by, k, key, below): for each row of ``wanted`` (by, k) the k-th smallest key of its group, from 1, and how many
    keys of the group are smaller than it. A ``k`` below 1 or above the size of its group gives no row.

    ``keys`` is read once per round, so write an expensive one down. Null keys do not count; a null group is
    a group.
    """
    spark, by = keys.sparkSession, list(by)
    names = [f"_g{i}" for i in range(len(by))]
    slim = keys.where(F.col(key).isNotNull()).select(*[F.col(b).alias(n) for b, n in zip(by, names)], F.col(key).alias("_key"))
    asked = wanted.select(*[F.col(b).alias(n) for b, n in zip(by, names)], F.col(k).cast("long").alias("_k")).distinct()
    state = checkpointed(asked.where(F.col("_k") >= 1).select(
        *names, "_k", F.lit("").alias("_prefix"), F.lit(0).cast("long").alias("_below"),
    ))
    found, width = None, FIRST
    for _ in range(MAX_ROUNDS):
        if state.isEmpty():
            break
        # One row per group and open prefix; several wanted keys may share one.
        open_ = broadcast_if_small(state.select(*[F.col(n).alias(f"{n}_") for n in names], F.col("_prefix")).distinct())
        match = F.startswith(F.col("_key"), F.col("_prefix"))
        for n in names:
            match = match & F.col(n).eqNullSafe(F.col(f"{n}_"))
        part = F.substr(F.col("_key"), F.lit(1), F.length("_prefix") + width)
        counted = slim.join(open_, match).groupBy(*names, "_prefix", part.alias("_part")).agg(
            F.count("*").alias("_n"), F.min("_key").alias("_low"), F.max("_key").alias("_high"),
        )
        upto = Window.partitionBy(*names, "_prefix").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
        placed = counted.withColumn("_upto", F.sum("_n").over(upto)).select(
            *[F.col(n).alias(f"{n}_") for n in names], F.col("_prefix").alias("_prefix_"), "_n", "_low", "_high", "_upto",
        )
        same = F.col("_prefix") == F.col("_prefix_")
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"{n}_"))
        rank = F.col("_k") - F.col("_below")
        same = same & (rank > F.col("_upto") - F.col("_n")) & (rank <= F.col("_upto"))
        chosen = checkpointed(state.join(placed, same).select(
            *names, "_k", (F.col("_below") + F.col("_upto") - F.col("_n")).alias("_below"), "_low", "_high",
        ))
        done = chosen.where(F.col("_low") == F.col("_high")).select(*names, "_k", F.col("_low").alias("_key"), "_below")
        found = done if found is None else found.unionByName(done)
        state = chosen.where(F.col("_low") != F.col("_high")).select(
            *names, "_k", F.substr(F.col("_low"), F.lit(1), _shared(F.col("_low"), F.col("_high"))).alias("_prefix"), "_below",
        )
        width = MORE
    else:
        raise RuntimeError(f"keys not told apart in {MAX_ROUNDS} rounds")
    if found is None:
        kinds = T.StructType([*[T.StructField(n, asked.schema[n].dataType) for n in names], T.StructField("_k", T.LongType()),
                              T.StructField("_key", T.StringType()), T.StructField("_below", T.LongType())])
        found = spark.createDataFrame([], kinds)
    return found.select(*[F.col(n).alias(b) for n, b in zip(names, by)], F.col("_k").alias(k), F.col("_key").alias(key), F.col("_below").alias("below"))


def _value_of(df: DataFrame, column: str, found: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """The values that belong to keys of ``kth_keys``."""
    keyed = df.where(F.col(column).isNotNull()).select(*by, F.col(column).alias(out), sort_key(df, column).alias("_key_"))
    short = broadcast_if_small(found.select(*[F.col(b).alias(f"_by_{i}") for i, b in enumerate(by)], F.col("key").alias("_key_")).distinct())
    same = keyed["_key_"] == short["_key_"]
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{i}"))
    return keyed.join(short, same).groupBy(*by, keyed["_key_"].alias("key")).agg(F.min(out).alias(out))


def medians(df: DataFrame, column: str, by: Sequence[str] = (), out: str = "median") -> DataFrame:
    """(by, median): the middle value of each group that has one, the mean of both where there are two. Null values do not count."""
    by = list(by)
    filled = df.where(F.col(column).isNotNull())
    sizes = checkpointed(filled.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > 0))
    middle = F.array_distinct(F.array(F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")))
    wanted = sizes.select(*by, F.explode(middle).alias("k"))
    keys = checkpointed(filled.select(*by, sort_key(df, column).alias("key")))
    found = checkpointed(kth_keys(keys, wanted, by))
    values = _value_of(df, column, found, by, "_value")
    both = found.select(*[F.col(b).alias(f"_f_{i}") for i, b in enumerate(by)], F.col("key").alias("_fkey"))
    same = F.col("key") == F.col("_fkey")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_f_{i}"))
    return values.join(both, same).groupBy(*by).agg(F.avg("_value").alias(out)).where(F.col(out).isNotNull())
