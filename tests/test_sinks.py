"""Files named by rank, and a manifest of one line of any length."""

import os

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import mixture
from corpusflow.sources import sinks


def test_files_are_named_by_rank(spark, tmp_path):
    df = spark.range(1000).withColumn("text", F.concat(F.lit("t"), "id"))
    path = str(tmp_path / "out")
    sinks.write_parquet_by_rank(df, path, 4)
    names = sorted(n for n in os.listdir(f"{path}/data") if not n.startswith("."))
    assert names == [f"{i:05d}.parquet" for i in range(4)]
    assert sorted(r["id"] for r in spark.read.parquet(f"{path}/data").collect()) == list(range(1000))
    assert max(spark.read.parquet(f"{path}/data/{n}").count() for n in names) <= 300
    with pytest.raises(FileExistsError):
        sinks.write_parquet_by_rank(df, path, 2)
    sinks.write_parquet_by_rank(df.limit(0), path, 2, mode="overwrite")
    assert spark.read.schema(df.schema).parquet(f"{path}/data").count() == 0
    assert [n for n in os.listdir(path) if not n.startswith(".")] == ["data"]


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    bad = spark.range(100).select(F.when(F.col("id") == 70, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.write_parquet_by_rank(bad, path, 3)
    assert [n for n in os.listdir(path) if not n.startswith(".")] == [] if os.path.exists(path) else True


def test_a_manifest_of_one_line(spark, tmp_path):
    """A million entries: the same words as those of the list of lines, in one file of one line."""
    n = 1_000_000
    weights = spark.range(n).select("id", (F.col("id") % 977 / 100.0).alias("weight"), F.concat(F.lit("/data/"), "id").alias("path"))
    sinks.write_manifest_line(weights.repartition(7), ["id"], str(tmp_path / "out"))
    text = (tmp_path / "out" / "manifest.txt").read_text()
    assert "\n" not in text and not text.endswith(" ")
    words = text.split(" ")
    assert len(words) == 2 * n
    lines = mixture.manifest_lines(weights.where(f"id < 1000 or id >= {n - 5}"), ["id"]).orderBy("line").collect()
    assert words[:2000] + words[-10:] == [r["text"][2:] for r in lines]
    sinks.write_manifest_line(weights.limit(0), ["id"], str(tmp_path / "none"))
    assert (tmp_path / "none" / "manifest.txt").read_text() == ""


def test_a_large_rank_is_several_files(spark, tmp_path, monkeypatch):
    """However few ranks there are, no task has more rows than the bound allows."""
    monkeypatch.setattr(sinks, "FILE_BYTES", 4000, raising=False)
    df = spark.range(0, 1000, 1, 3).withColumn("text", F.repeat(F.lit("x"), 56))
    path = str(tmp_path / "out")
    sinks.write_parquet_by_rank(df, path, 4)
    names = sorted(n for n in os.listdir(f"{path}/data") if not n.startswith("."))
    assert names == [f"{i:03d}_{rank:05d}.parquet" for i in range(5) for rank in range(4)]
    assert sorted(r["id"] for r in spark.read.parquet(f"{path}/data").collect()) == list(range(1000))
    assert max(spark.read.parquet(f"{path}/data/{n}").count() for n in names) <= 60
