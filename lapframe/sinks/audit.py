"""Audit columns and schema evolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe.schemas import AUDIT


def with_audit(df: DataFrame, run_date: dt.date | str, now: Column | None = None) -> DataFrame:
    """Stamp a batch: ``processed_date`` from the run date, ``created_at`` and ``updated_at`` now."""
    now = F.current_timestamp() if now is None else now
    day = F.lit(str(run_date)).cast("date")
    return df.withColumns({"processed_date": day, "created_at": now, "updated_at": now})


def add_missing_columns(
    df: DataFrame, spec: T.StructType = AUDIT, now: Column | None = None
) -> DataFrame:
    """Add the columns of ``spec`` that ``df`` lacks.

    A new timestamp column is filled with the current time, a new date with the current day, any other
    with NULL. Columns already present stay as they are, NULLs included.
    """
    now = F.current_timestamp() if now is None else now
    present = {c.lower() for c in df.columns}
    new = {}
    for field in spec.fields:
        if field.name.lower() in present:
            continue
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            new[field.name] = now.cast(field.dataType)
        else:
            new[field.name] = F.lit(None).cast(field.dataType)
    return df.withColumns(new) if new else df
