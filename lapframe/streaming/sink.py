"""Real-time tables as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.session import delete_path
from lapframe.streaming.dedup import insert_if_absent


def start_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
):
    """Append a stream to a Parquet table, stamping ``created_at`` on arrival.

    ``mode='refresh'`` removes the table and its checkpoint first, i.e. drops and recreates it.
    """
    if mode == "refresh":
        for old in (path, checkpoint):
            delete_path(df.sparkSession, old)
    writer = (
        df.withColumn("created_at", F.current_timestamp())
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def write_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("id",),
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
):
    """Insert micro-batches into a table with unique ``keys``; duplicates are skipped.

    The source's ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger`` sets the batch size; the rest is
    written with the last batch.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        insert_if_absent(
            batch.withColumn("created_at", F.current_timestamp()), path, keys, partition_by
        )

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(save).trigger(**(trigger or {"availableNow": True})).start()
