"""Rows with null weights, chunks and shares are neither lost nor counted wrongly."""

import pyarrow as pa
import pytest

from corpusflow.operators import index, mixture


def test_null_weight_counts_zero(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (3, 5)], "id int, n int")
    got = {r["id"]: r["s"] for r in index.prefix_sums(df, ["id"], weight="n", out="s").collect()}
    assert got == {1: 0, 2: 2, 3: 2}


def test_null_chunk_keeps_its_files(spark):
    files = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "chunk string, f int")
    got = index.shard_files_floor(files, 1, "chunk", ["f"]).collect()
    assert sorted(r["f"] for r in got) == [1, 2, 3]


def test_mix_gives_exactly_n(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(8)], "id int, source string")
    weights = spark.createDataFrame([("a", 1.0), ("b", None), ("gone", 5.0)], "source string, weight double")
    assert mixture.mix(docs, weights, 10, 1, ["id"]).count() == 10
    with pytest.raises(ValueError):
        mixture.mix(docs, weights.where("source = 'gone'"), 10, 1, ["id"])


def test_interleave_keeps_rows_without_a_share(spark):
    rows = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0)], "source string, place long")
    shares = spark.createDataFrame([("a", 0.5), ("b", 0.0)], "source string, share double")
    got = {r["source"]: r["position"] for r in mixture.interleave(rows, shares).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_rows_with_null_counts_stay(spark):
    df = spark.createDataFrame([(1, 2), (2, None)], "id int, n int")
    assert index.prefix_sums(df, ["id"], weight="n", out="s").count() == 2


def test_written_tables_cross_in_short_batches(spark):
    """Long texts reach a worker a few at a time, whatever the session allows, and its setting stays."""
    from pyspark.sql import functions as F

    from corpusflow import session

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    held = F.arrow_udf(lambda texts: pa.array([texts.nbytes] * len(texts), pa.int64()), "bigint")
    texts = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
    sizes = [r["n"] for r in session.checkpointed(texts.select(held(F.col("t")).alias("n"))).collect()]
    assert len(sizes) == 40 and max(sizes) < 10_000_000
    assert spark.conf.get(key) == before
