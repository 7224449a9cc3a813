"""Write, audit, publish."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lapframe.quality.checks import Check, run_checks
from lapframe.session import delete_path
from lapframe.sinks.layout import write_table


class CheckFailed(Exception):
    """Raised when staged data does not pass its checks; nothing was published."""


def stage_and_publish(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    checks: Sequence[Check] = (),
    refs: dict[str, DataFrame] | None = None,
    partition_by: Sequence[str] = ("session_key",),
    sort_by: Sequence[str] = (),
    mode: str = "partitions",
) -> None:
    """Write ``df`` to a staging folder, check it there, then publish it to ``path``.

    ``mode``: ``partitions`` replaces the partitions present in the batch, ``overwrite`` the whole
    table, ``append`` adds. The staging folder sits next to the table and is always removed.
    """
    staging = f"{path.rstrip('/')}__staging-{uuid.uuid4().hex}"  # one per run
    try:
        write_table(df, staging, partition_by, sort_by)
        staged = spark.read.schema(df.schema).parquet(staging)
        if checks:
            report = run_checks(staged, checks, refs or {})
            failed = report.filter("NOT passed").collect()  # one row per check
            if failed:
                names = ", ".join(f"{r['check']}({r['column']}): {r['n_failed']}" for r in failed)
                raise CheckFailed(names)
        dynamic = mode == "partitions" and bool(partition_by)
        write_table(
            staged,
            path,
            partition_by,
            sort_by,
            mode="append" if mode == "append" else "overwrite",
            dynamic=dynamic,
        )
    finally:
        delete_path(spark, staging)
