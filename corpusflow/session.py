"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch between Spark and Python. Both sides hold whole batches, and texts may be long.
BATCH_BYTES = 8 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster.

    ``spark.checkpoint.dir`` decides. Where it is unset, a folder already given to the context is
    used, and only a local master falls back to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusflow-"))
        current = sc.getCheckpointDir()
    return current


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside exchange Arrow batches of at most BATCH_BYTES, or less where the session says so."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    digits = before.rstrip("b")
    if digits.isdigit() and int(digits) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there (survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    with short_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/corpusflow/{name}-{uuid.uuid4().hex}"
