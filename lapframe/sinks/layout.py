"""Table layout on disk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("session_key",),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
    look_up_by: Sequence[str] = (),
) -> None:
    """Write Parquet partitioned by ``partition_by`` and sorted by ``sort_by`` inside each file.

    Columns of ``look_up_by`` get Bloom filters, for finding single values by which the table is not
    sorted: a row group whose filter lacks the value is not read, and inside a group the column index
    leads to the pages that can hold it.

    Rows are rebalanced on the partition columns: small partitions become few files and a partition
    with much of the data is split over many tasks, each writing its own file. Sorting gives the
    row-group statistics that let a filter on the sort columns skip data.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    if partition_by or sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode(mode)
    for column in look_up_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
