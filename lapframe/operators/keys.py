"""Key handling shared by the operators: null-safe matching and hot-key splitting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A group below this size is left to one task; window operators spill, so it need not fit memory.
# The session setting of that name overrides it.
HOT_ROWS = 2_000_000
HOT_ROWS_CONF = "spark.lapframe.hotKeyRows"
# No more hot keys than this are ever brought to the driver or broadcast.
MAX_HOT_KEYS = 1_000

HOT = "__hot"
PART = "__part"


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs, usable as a hash or merge join condition."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


@dataclass(frozen=True)
class HotKeys:
    """Keys with very many rows, at most ``MAX_HOT_KEYS`` of them; ``many``: there are more."""

    found: list[Row]
    schema: T.StructType
    many: bool = False


def find_hot_keys(df: DataFrame, keys: Sequence[str], threshold: int | None = None, weight: str | None = None) -> HotKeys | None:
    """Keys with at least ``threshold`` rows (or sum of ``weight``); None if there is none.

    Counting is a partial hash aggregate over the key columns alone.
    """
    if threshold is None:
        threshold = int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    hot = df.groupBy(*keys).agg(size.alias("__n")).filter(F.col("__n") >= threshold).select(*keys)
    found = hot.limit(MAX_HOT_KEYS + 1).collect()
    return HotKeys(found[:MAX_HOT_KEYS], hot.schema, len(found) > MAX_HOT_KEYS) if found else None


def _part(part: Column | Sequence[Column]) -> Column:
    """Order of the parts: a NULL comes last; rows whose first part is NULL are cut by the next one."""
    fields, before = [], F.lit(True)
    for i, p in enumerate([part] if isinstance(part, Column) else part):
        fields += [F.when(before, p.isNull()).alias(f"late{i}"), F.when(before, p).alias(f"at{i}")]
        before = before & p.isNull()
    return F.struct(*fields)


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    part: Column | Sequence[Column],
    threshold: int | None = None,
    sizes: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame | None:
    """Add ``__part`` on rows of keys with at least ``threshold`` rows, else NULL.

    ``part`` is a non-decreasing function of the first order column, or one per order column: rows whose
    first order value is NULL form the last part of their key, as NULL sorts as the greatest value, and
    are cut further by the next function. Returns None when no key is hot, so that callers keep the plain
    one-window plan. Keys are counted in ``sizes`` when given (a table with at least as many rows per key
    that is cheaper to scan than a derived ``df``), or were found before (``hot``). With more than
    ``MAX_HOT_KEYS`` of them every key is split, which is exact as well.
    """
    spark = df.sparkSession
    hot = hot or find_hot_keys(df if sizes is None else sizes, keys, threshold)
    if hot is None:
        return None
    place = _part(part)
    if hot.many:
        return df.withColumn(PART, place)
    names = hot.schema.fieldNames()
    small = spark.createDataFrame(hot.found, hot.schema).toDF(*[f"__k_{k}" for k in names])
    small = F.broadcast(small.withColumn(HOT, F.lit(True)))  # <= MAX_HOT_KEYS rows
    return (
        df.join(small, same_keys(df, small, [(k, f"__k_{k}") for k in names]), "left")
        .withColumn(PART, F.when(F.col(HOT), place))
        .select(*df.columns, PART)
    )


def attach_parts(split: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join per-(keys, part) values computed for the hot keys back to their rows."""
    renamed = offsets.withColumnsRenamed({k: f"__o_{k}" for k in [*keys, PART]})
    on = same_keys(split, renamed, [(k, f"__o_{k}") for k in [*keys, PART]])
    return split.join(renamed, on, "left").drop(*[f"__o_{k}" for k in [*keys, PART]])
