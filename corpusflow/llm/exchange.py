"""Exchange of packed records: numpy rows travel between tasks as a few bytes blocks, not as table rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Buckets per shuffle partition; a task holds one bucket at a time, so set as many shuffle partitions
#: that a partition's records fit in memory.
BUCKETS = 2
#: Records that a task gathers before it packs them.
HELD = 1 << 20

PACKED = "bucket int, data binary"


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block(rows: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """One row per bucket with its records."""
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(rows) else np.zeros(0, np.int64)
    data = [rows[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(rows)))]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[starts].astype(np.int32)), pa.array(data, pa.binary())], ["bucket", "data"]
    )


def gathered(parts: Iterator[np.ndarray], pack: Callable[[np.ndarray], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``pack`` of about HELD records at a time."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= HELD:
            yield pack(np.concatenate(held))
            held, size = [], 0
    if size:
        yield pack(np.concatenate(held))


def by_bucket(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[np.ndarray]:
    """All records of one bucket after another, from batches sorted by bucket."""
    current, held = None, []
    for batch in batches:
        for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != current and held:
                yield np.concatenate(held)
                held = []
            current = bucket
            held.append(np.frombuffer(data.as_buffer(), dtype=kind))
    if held:
        yield np.concatenate(held)


def dealt(packed: DataFrame, parts: int) -> DataFrame:
    """Packed rows with the blocks of a bucket together."""
    return packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
