"""Named queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.index import global_index
from corpusflow.session import checkpointed
from corpusflow.sources.readers import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under a name; ``sql`` computes the same rows in plain SQL."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def in_order(df: DataFrame, out: str = "position") -> DataFrame:
    """A sorted table with the position of each row, so that its order can be compared."""
    numbered = checkpointed(df.withColumn("_at", F.monotonically_increasing_id()))
    return global_index(numbered, ["_at"], out=out).drop("_at")


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose rows need much work: a small file is spread over the cores."""
    return spread(table(spark, folder, name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
