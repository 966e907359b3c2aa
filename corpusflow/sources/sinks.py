"""Sinks: JSON lines, Parquet, text files and manifests."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.mixture import format_weight
from corpusflow.operators.sizing import approx_bytes


def write_jsonl(
    df: DataFrame, path: str, shard: str | None = None, order: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """JSON lines, below one folder per shard if there is a shard column.

    Rows are laid out by range of shard and order, so a shard has few files, and a large shard is
    written by several tasks.
    """
    if shard is None:
        df.write.mode(mode).json(path)
        return
    if not order:
        raise ValueError("give order columns, by which a large shard can be cut")
    laid_out = df.repartitionByRange(shard, *order).sortWithinPartitions(shard, *order)
    laid_out.write.mode(mode).partitionBy(shard).json(path)


#: Bytes copied at a time.
COPIED = 1 << 20


class _Folder:
    """A folder in whatever store Spark writes to: only names are handled here, and bytes only as streams."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.spark = spark._jvm, spark
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path.getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def parts(self, folder: str) -> list:
        """Files that tasks have written, by number of the task."""
        found = [s.getPath() for s in self.fs.listStatus(self.at(folder)) if s.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda f: f.getName())

    def make_room(self, name: str, mode: str) -> None:
        if self.fs.exists(self.at(name)):
            if mode != "overwrite":
                raise FileExistsError(f"{self.at(name)} exists")
            self.fs.delete(self.at(name), True)


#: Rough bytes of rows that one task writes.
FILE_BYTES = 128 * 1024 * 1024


def write_parquet_by_rank(
    df: DataFrame, path: str, n: int, mode: str = "errorifexists", max_bytes: int | None = None
) -> None:
    """``data/00000.parquet`` and so on, ``n`` ranks of about equal size, whatever the input partitions were.

    A rank of more than ``max_bytes`` (rough, as rows; None: FILE_BYTES) is written by several tasks, as
    ``data/000_00000.parquet``, ``data/001_00000.parquet`` and so on; all ranks have as many files. Rows are read once
    for their sizes before, so write them down if they are dear to make.

    Tasks write and commit below a folder of this call, a retried task like any other; then files are renamed, so that no
    name appears before all are whole. A rank without rows has no file.
    """
    folder, staged = _Folder(df.sparkSession, path), f"_staged-{uuid.uuid4().hex}"
    folder.make_room("data", mode)
    size = df.agg(F.sum(approx_bytes(df)).alias("bytes")).first()["bytes"] or 0
    files = max(1, -(-size // (n * (max_bytes or FILE_BYTES))))
    try:
        df.repartition(n * files).write.parquet(str(folder.at(staged)))
        folder.fs.mkdirs(folder.at("data"))
        for file in folder.parts(staged):
            number, rank = divmod(int(file.getName().split("-")[1]), n)
            name = f"{rank:05d}.parquet" if files == 1 else f"{number:03d}_{rank:05d}.parquet"
            if not folder.fs.rename(file, folder.at(f"data/{name}")):
                raise OSError(f"cannot rename {file}")
    finally:
        folder.fs.delete(folder.at(staged), True)


def write_manifest_line(weights: DataFrame, order: Sequence[str], path: str, name: str = "manifest.txt", mode: str = "errorifexists") -> None:
    """One line ``w path w path …`` of any length in one file.

    Entries are sorted by range over the tasks and written as parts; the parts are streamed into the file one after the
    other, so that neither a task nor the driver holds the line.
    """
    folder, staged = _Folder(weights.sparkSession, path), f"_staged-{uuid.uuid4().hex}"
    folder.make_room(name, mode)
    entry = F.concat_ws(" ", format_weight("weight"), F.col("path"))
    try:
        weights.orderBy(*order).select(entry.alias("value")).write.option("lineSep", " ").text(str(folder.at(staged)))
        parts = [p for p in folder.parts(staged) if folder.fs.getFileStatus(p).getLen()]
        out = folder.fs.create(folder.at(f"{staged}/line"))
        try:
            for i, part in enumerate(parts):
                # The blank behind the last entry stays out.
                size = folder.fs.getFileStatus(part).getLen() - (i == len(parts) - 1)
                stream = folder.fs.open(part)
                try:
                    bounded = folder.jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)
                    folder.jvm.org.apache.hadoop.io.IOUtils.copyBytes(bounded, out, COPIED, False)
                finally:
                    stream.close()
        finally:
            out.close()
        if not folder.fs.rename(folder.at(f"{staged}/line"), folder.at(name)):
            raise OSError(f"cannot write {folder.at(name)}")
    finally:
        folder.fs.delete(folder.at(staged), True)


def write_kept_and_removed(df: DataFrame, path: str, keep: str = "keep", mode: str = "errorifexists") -> None:
    """Kept rows below ``keep=true`` and removed rows below ``keep=false``, in one pass."""
    df.write.mode(mode).partitionBy(keep).json(path)


def write_nested_generations(
    df: DataFrame, path: str, solutions: str, order: Sequence[str], mode: str = "errorifexists"
) -> None:
    """One JSON array of solutions per line, problems in order."""
    lines = df.orderBy(*order).select(F.to_json(F.col(solutions)).alias("value"))
    lines.write.mode(mode).text(path)


def write_text_per_row(df: DataFrame, path: str, index: str, text: str, mode: str = "errorifexists") -> None:
    """One folder with one text file per index; for samples that people read."""
    df.select(index, F.col(text).alias("value")).write.mode(mode).partitionBy(index).text(path)


def write_manifest(manifest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Manifest lines in order, or the one-line manifest."""
    if "line" in manifest.columns:
        manifest = manifest.orderBy("line").select("text")
    manifest.toDF("value").write.mode(mode).text(path)
