"""Run the row-wise operators on files as they arrive.

Score filters, stripping, decontamination and the column functions keep no state, so they take a
streaming DataFrame as it is; each file is processed once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def process_arrived(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    progress: str,
    file_format: str = "parquet",
    files_per_batch: int = 10_000,
) -> None:
    """Read what has arrived since the last call, transform it and append it to ``out``.

    ``progress`` is the shared folder that remembers the files already done.
    """
    stream = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    query = (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
