"""Keyed upsert with audit stamps, as a join and as a partition rewrite."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe.functions.expr import nulls_high
from lapframe.session import delete_path, path_exists
from lapframe.sinks.layout import write_table
from lapframe.streaming.dedup import touched_partitions

_STAMPS = ("created_at", "updated_at")
LOAD_ID = "load_id"


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    last_by: Sequence[str] = (),
    now: Column | None = None,
    new_columns: str = "error",
    load_id: str | None = None,
) -> DataFrame:
    """The target after ``MERGE`` of the source on ``keys``.

    Matched rows take every non-key column that the source has, except ``created_at``, keep the others
    and get a new ``updated_at``; unmatched source rows are inserted with both stamps; other rows are
    unchanged.
    A NULL in a key never matches. ``on_duplicate``: ``error`` fails the job when several source
    rows meet one target row (unmatched duplicates are all inserted); ``last`` keeps the last
    source row per key by ``last_by``. ``new_columns``: columns that only the source has are an
    ``error``, or ``add``ed to the target, NULL in its other rows.

    ``load_id`` makes a load repeatable whatever its keys: inserted rows carry it in a column of that
    name, and rows that this very load has inserted before are put aside first, so they are inserted
    anew instead of doubled.
    """
    keys = list(keys)
    if new_columns not in ("error", "add"):
        raise ValueError(f"new_columns must be 'error' or 'add', not {new_columns!r}")
    if load_id is not None:
        source = source.drop(LOAD_ID)
        if LOAD_ID not in target.columns:
            target = target.withColumn(LOAD_ID, F.lit(None).cast("string"))
        target = target.filter(~F.col(LOAD_ID).eqNullSafe(F.lit(load_id)))
    extra = [f for f in source.schema.fields if f.name not in target.columns]
    if extra and new_columns == "error":
        raise ValueError(f"columns missing in target: {[f.name for f in extra]}")
    target = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra}) if extra else target
    for side, df in (("target", target), ("source", source)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ValueError(f"missing merge keys in {side}: {missing}")
    if on_duplicate not in ("error", "last"):
        raise ValueError(f"on_duplicate must be 'error' or 'last', not {on_duplicate!r}")
    if on_duplicate == "last" and not last_by:
        raise ValueError("on_duplicate='last' needs last_by")
    now = F.current_timestamp() if now is None else now
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    # rows with a NULL key cannot match: they bypass the join, however many there are
    loose_source, loose_target = source.filter(~complete), target.filter(~complete)
    batch, base = source.filter(complete), target.filter(complete)
    if on_duplicate == "last":
        window = Window.partitionBy(*keys).orderBy(*[nulls_high(c, True) for c in last_by])
        batch = (
            batch.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1")
            .drop("__rank")
        )
        copies = F.lit(1).cast("long")
    else:
        # a window on the keys needs the same exchange as the join
        copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))

    source_columns = set(source.columns)
    left = base.withColumn("__in_target", F.lit(True)).alias("t")
    right = batch.withColumn("__in_source", F.lit(True)).withColumn("__copies", copies)
    joined = left.join(
        right.alias("s"), reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]),
        "full_outer",
    )
    hit, new = F.col("s.__in_source"), F.col("t.__in_target").isNull()

    def merged(name: str) -> Column:
        kind = target.schema[name].dataType
        if name in keys:
            return F.coalesce(F.col(f"t.{name}"), F.col(f"s.{name}")).alias(name)
        if name == "created_at":
            return F.when(new, now).otherwise(F.col(f"t.{name}")).cast(kind).alias(name)
        if name == "updated_at":
            return F.when(hit, now).otherwise(F.col(f"t.{name}")).cast(kind).alias(name)
        if name == LOAD_ID and load_id is not None:
            return F.when(new, F.lit(load_id)).otherwise(F.col(f"t.{name}")).alias(name)
        if name not in source_columns:
            return F.col(f"t.{name}").cast(kind).alias(name)
        return F.when(hit, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).cast(kind).alias(name)

    clash = hit & ~new & (F.col("s.__copies") > 1)
    guard = F.when(
        clash, F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    ).otherwise(F.lit(True))
    result = joined.filter(guard).select(*[merged(c) for c in target.columns])

    def inserted(name: str) -> Column:
        kind = target.schema[name].dataType
        if name in _STAMPS:
            return now.cast(kind).alias(name)
        if name == LOAD_ID and load_id is not None:
            return F.lit(load_id).alias(name)
        value = F.col(name) if name in source_columns else F.lit(None)
        return value.cast(kind).alias(name)

    return result.unionByName(loose_target).unionByName(
        loose_source.select(*[inserted(c) for c in target.columns])
    )


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: str = "session_key",
    sort_by: Sequence[str] = (),
    **options,
) -> None:
    """Upsert into a Parquet table, rewriting only the partitions the batch touches.

    The merged partitions are written next to the table first and copied in with a dynamic
    partition overwrite, so no plan reads the files it replaces. A run that stops half way can be
    repeated with the same ``load_id`` (see :func:`merge_upsert`); without one, rows with a NULL key
    would come again in partitions already published. A first load goes through the same merge: it is
    stamped and its duplicates are treated alike. ``partition_by`` must be one of the keys: then a row
    never changes partition. Read a table whose columns have grown with the option ``mergeSchema``.
    """
    if partition_by not in keys:
        raise ValueError(f"{partition_by} must be one of the merge keys")
    if not path_exists(spark, path):
        stamped = source.schema
        for stamp in _STAMPS:
            if stamp not in source.columns:
                stamped = stamped.add(stamp, T.TimestampType())
        if options.get("load_id") is not None and LOAD_ID not in source.columns:
            stamped = stamped.add(LOAD_ID, T.StringType())
        empty = spark.createDataFrame([], stamped)
        write_table(merge_upsert(empty, source, keys, **options), path, [partition_by], sort_by)
        return
    # only tables whose columns may grow are read for the columns of all their files
    grows = options.get("load_id") is not None or options.get("new_columns") == "add"
    target = spark.read.option("mergeSchema", str(grows).lower()).parquet(path)
    part = target.filter(touched_partitions(source, [partition_by]))
    staging = f"{path.rstrip('/')}__merge-{uuid.uuid4().hex}"  # one per run
    try:
        merged = merge_upsert(part, source, keys, **options)
        write_table(merged, staging, [partition_by], sort_by)
        spark.read.schema(merged.schema).parquet(staging).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(partition_by).parquet(path)
    finally:
        delete_path(spark, staging)
