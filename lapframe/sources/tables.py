"""Raw tables as Parquet datasets with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lapframe.schemas import AUDIT, RAW


def load_sources(
    spark: SparkSession, base: str, names: Iterable[str] | None = None, audit: bool = False
) -> dict[str, DataFrame]:
    """Read ``base/<table>`` for each declared table with its schema (no inference)."""
    out = {}
    for name in names or RAW:
        schema = T.StructType(RAW[name].fields + (AUDIT.fields if audit else []))
        out[name] = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{name}")
    return out


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Expose tables or models to SQL; a view is as lazy as its DataFrame."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
