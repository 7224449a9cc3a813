"""What a load did, per session and endpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_report(
    sessions: DataFrame,
    endpoint: str,
    existing: DataFrame,
    batch: DataFrame,
    errors: DataFrame | None = None,
) -> DataFrame:
    """One row per requested session: status, reason and number of records.

    A session already in ``existing`` is skipped (``data_exists``), one without batch rows too
    (``no_data``); one listed in ``errors`` (session_key, reason) failed; the rest succeeded.
    """
    present = existing.select("meeting_key", "session_key").distinct().withColumn(
        "__present", F.lit(True)
    )
    counts = batch.groupBy("session_key").agg(F.count(F.lit(1)).alias("__n"))
    out = (
        sessions.select("meeting_key", "session_key").distinct()
        .join(present, ["meeting_key", "session_key"], "left")
        .join(counts, "session_key", "left")
    )
    if errors is not None:
        failed = errors.groupBy("session_key").agg(F.max("reason").alias("__error"))
        out = out.join(failed, "session_key", "left")
    else:
        out = out.withColumn("__error", F.lit(None).cast("string"))
    exists, failed, empty = (
        F.col("__present").isNotNull(),
        F.col("__error").isNotNull(),
        F.col("__n").isNull(),
    )
    return out.select(
        F.lit(endpoint).alias("endpoint"),
        "meeting_key",
        "session_key",
        F.when(exists, "skipped").when(failed, "error").when(empty, "skipped").otherwise("success")
        .alias("status"),
        F.when(exists, "data_exists").when(failed, F.col("__error")).when(empty, "no_data")
        .alias("reason"),
        F.when(exists | failed | empty, F.lit(0)).otherwise(F.col("__n")).cast("long")
        .alias("records"),
    )
