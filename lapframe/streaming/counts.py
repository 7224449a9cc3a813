"""Running message counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.session import path_exists


def running_counts(df: DataFrame, keys: Sequence[str] = ("kind", "driver_number")) -> DataFrame:
    """Messages per kind and driver, on a stream or a table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"))


def write_running_counts(counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Run a streaming count in update mode, writing the counts each micro-batch changed.

    Each batch has its own folder that a repeated run overwrites; read with
    :func:`latest_counts`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(save).trigger(**(trigger or {"availableNow": True})).start()


def latest_counts(
    counts: DataFrame, path: str, keys: Sequence[str] = ("kind", "driver_number")
) -> DataFrame:
    """The newest count per key among the batches written so far."""
    spark = counts.sparkSession
    if not path_exists(spark, path):
        return spark.createDataFrame([], counts.schema)
    return (
        spark.read.parquet(path).groupBy(*keys)
        .agg(F.max_by("messages", "batch_id").alias("messages"))
    )
