"""Sources: JSON lines, Parquet and CSV files, and catalogues of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusflow.operators.rows import union_sources
from corpusflow.operators.sizing import fits


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """JSON lines with a declared schema, so that files are read once."""
    return spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths))


def read_parquet_glob(
    spark: SparkSession, base: str, glob: str = "*.parquet", text_key: str | None = None
) -> DataFrame:
    """All Parquet files below a folder whose names match; the text column becomes ``text``.

    A dataset may be one file or a folder of part files: all files of a folder whose name matches belong to it.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    folders = _matching_folders(spark, base, glob)
    if not folders:
        return rename_text(reader.option("pathGlobFilter", glob).parquet(base), text_key)
    # Names only; files in the matching folders are named there.
    inside = F.lit(False)
    for folder in folders:
        inside = inside | F.startswith("path", F.lit(f"{folder}/"))
    alone = list_files(spark, base, glob).where(~inside).select("path")
    return rename_text(reader.parquet(*folders, *(row["path"] for row in alone.collect())), text_key)


def _matching_folders(spark: SparkSession, base: str, glob: str) -> list[str]:
    """Folders below ``base`` whose names match and that do not lie in one that does; hidden ones are left out."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(base)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    wanted, found = hadoop.GlobFilter(glob), []
    below = [entry.getPath() for entry in fs.globStatus(top) or () if entry.isDirectory()]
    while below:
        for entry in fs.listStatus(below.pop()):
            path = entry.getPath()
            if not entry.isDirectory() or path.getName().startswith((".", "_")):
                continue
            if wanted.accept(path):
                found.append(path.toString())
            else:
                below.append(path)
    return sorted(found)


def read_dataset(spark: SparkSession, path: str, split: str | None = None, text_key: str | None = None) -> DataFrame:
    """A dataset folder, or one split of it in a folder of that name."""
    return rename_text(spark.read.parquet(f"{path.rstrip('/')}/{split}" if split else path), text_key)


def read_subset(spark: SparkSession, base: str, subset: str, column: str = "lang") -> DataFrame:
    """One folder ``column=subset`` of a partitioned dataset; the others are not listed as input."""
    return spark.read.parquet(base).where(F.col(column) == F.lit(subset))


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file with a header line; blank cells are null."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=True)


def rename_text(df: DataFrame, text_key: str | None) -> DataFrame:
    """The text column under the name ``text``."""
    return df if text_key in (None, "text") else df.withColumnRenamed(text_key, "text")


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than cores cut finer, before heavy work on each row.

    A large input has far more partitions than that and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def list_files(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """(path, folder, bytes, modified) of the files below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(base)
    )
    return files.select(
        "path",
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


@dataclass(frozen=True)
class Source:
    """Where a source lies and which column holds its text."""

    name: str
    path: str
    text_column: str
    subset: str | None = None
    format: str = "parquet"


def sharded_sources(prefix: str, n: int, name: str, text_column: str) -> list[Source]:
    """The JSON-lines shards ``prefix-00000-of-0000n.jsonl`` as one source each."""
    return [
        Source(f"{name}_{i}", f"{prefix}-{i:05d}-of-{n:05d}.jsonl", text_column, format="json")
        for i in range(n)
    ]


def folder_sources(
    spark: SparkSession, base: str, text_column: str, glob: str = "*.parquet", max_folders: int = 10_000
) -> list[Source]:
    """One source per folder directly above the files of a dataset, by name."""
    folders = list_files(spark, base, glob).select("folder").distinct()
    if not fits(folders, max_folders):
        raise ValueError(f"more than {max_folders} folders")
    names = sorted(row["folder"] for row in folders.collect())
    return [Source(name, base, text_column, subset=name) for name in names]


def source_catalog(spark: SparkSession, families: Sequence[Sequence[Source]], output: str) -> DataFrame:
    """(name, path, subset, output, text_column) of all families, one after the other."""
    rows = [
        (s.name, s.path, s.subset, f"{output.rstrip('/')}/{s.name}", s.text_column)
        for family in families
        for s in family
    ]
    schema = "name string, path string, subset string, output string, text_column string"
    return spark.createDataFrame(rows, schema)


def read_sources(spark: SparkSession, sources: Sequence[Source]) -> DataFrame:
    """(source, text) of all sources, whatever their text columns are called."""
    parts = []
    for s in sources:
        path = f"{s.path.rstrip('/')}/{s.subset}" if s.subset else s.path
        reader = spark.read.format(s.format)
        if s.format == "json":
            reader = reader.schema(f"`{s.text_column}` string")
        parts.append(
            reader.load(path).select(F.lit(s.name).alias("source"), F.col(s.text_column).alias("text"))
        )
    return union_sources(parts)
