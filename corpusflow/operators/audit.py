"""Audits of shards, files and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.selection import medians


def first_file_per_folder(
    files: DataFrame, folder: str = "folder", path: str = "path", suffix: str = ".json"
) -> DataFrame:
    """The first file with the suffix in each folder; folders without one drop out."""
    return (
        files.where(F.endswith(F.col(path), F.lit(suffix)))
        .groupBy(folder)
        .agg(F.min(path).alias(path))
    )


def folders_without_file(
    files: DataFrame, folder: str = "folder", path: str = "path", suffix: str = ".json"
) -> DataFrame:
    """Folders in which no file has the suffix."""
    found = F.max(F.endswith(F.col(path), F.lit(suffix)))
    return files.groupBy(folder).agg(found.alias("_found")).where(~F.col("_found")).select(folder)


def filter_files_by_pattern(files: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """Files whose whole path matches."""
    return files.where(F.col(path).rlike(f"^(?:{pattern})$"))


def missing_shards(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(actual.select(*keys).distinct(), list(keys), "left_anti")


def shard_audit(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str] = ("source", "shard"),
    size: str = "bytes",
    small: float = 0.5,
) -> DataFrame:
    """Size and status of every expected shard.

    ``Empty`` where nothing is there, ``small`` below ``small`` times the median of all shards
    that are there, else ``ok``. The exact median is selected by counting, in no single task.
    """
    present = actual.where(F.col(size) > 0)
    middle = medians(present, size).first()
    status = (
        F.when(F.col(size).isNull(), F.lit("Empty"))
        .when(F.col(size) < F.lit(middle["median"] * small if middle else None), F.lit("small"))
        .otherwise(F.lit("ok"))
    )
    return expected.join(present.select(*keys, size), list(keys), "left").withColumn("status", status)


def extract_first(
    lines: DataFrame, pattern: str, text: str, order: Sequence[str], keys: Sequence[str] = (), group: int = 1
) -> DataFrame:
    """Group ``group`` of the first line (of each key) in which ``pattern`` is found."""
    matched = lines.where(F.col(text).rlike(pattern))
    value = F.regexp_extract(F.col(text), pattern, group)
    return matched.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias("value"))
