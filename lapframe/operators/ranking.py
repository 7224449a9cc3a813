"""Top-one, row numbers and dense ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapframe.functions.expr import nulls_high
from lapframe.operators.keys import (
    PART,
    HotKeys,
    attach_parts,
    same_keys,
    split_hot_keys,
)


def _top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark turns "row_number = 1" into a group limit that runs before the exchange, so each map
    # task sends at most one row per key and a hot key never reaches one task whole.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tie_breakers: Sequence[Column | str] = ()
) -> DataFrame:
    """The row with the greatest ``ts`` per key; a NULL time counts as greatest."""
    return _top_one(df, keys, [nulls_high(ts, descending=True), *_order(tie_breakers)])


def first_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tie_breakers: Sequence[Column | str] = ()
) -> DataFrame:
    """The row with the smallest ``ts`` per key; a NULL time counts as greatest."""
    return _top_one(df, keys, [nulls_high(ts), *_order(tie_breakers)])


def _order(columns: Sequence[Column | str]) -> list[Column]:
    return [nulls_high(c) if isinstance(c, str) else c for c in columns]


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    part: Column | Sequence[Column] | None = None,
    threshold: int | None = None,
    sizes: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``row_number()`` per key, ascending, that also works when one key is very large.

    ``part`` must be a non-decreasing function of the first order column, for example the time cut
    to the minute, or one per order column: rows without a time are then cut by the next. Rows of hot keys are numbered inside (key, part) and shifted by the number of
    rows in earlier parts, so no task gets a whole hot key; other keys use one window as usual.
    ``sizes`` says where to count rows per key, by default in ``df``; ``hot`` gives the large keys.
    """
    ordering = _order(order)
    split = (
        None if part is None else split_hot_keys(df, keys, part, threshold, sizes, hot)
    )
    if split is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    counts = split.filter(F.col(PART).isNotNull()).groupBy(*keys, PART).agg(
        F.count(F.lit(1)).alias("__n")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    # one row per (hot key, part): its size follows the number of parts, not of rows
    offsets = counts.withColumn("__before", F.sum("__n").over(earlier)).drop("__n")
    inner = F.row_number().over(Window.partitionBy(*keys, PART).orderBy(*ordering))
    return (
        attach_parts(split, offsets, keys)
        .withColumn(name, (inner + F.coalesce("__before", F.lit(0))).cast("int"))
        .drop("__before", PART)
    )


def dense_levels(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``dense_rank()`` of every distinct ``value`` per key.

    The rank depends only on the distinct values of a key: the window sees one row per distinct value
    however many rows share it.
    """
    return (
        df.select(*keys, value).distinct()
        .withColumn(name, F.dense_rank().over(Window.partitionBy(*keys).orderBy(nulls_high(value))))
    )


def join_levels(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach the rank of :func:`dense_levels` to rows with the same ``columns``, NULLs included."""
    renamed = levels.withColumnsRenamed({c: f"__d_{c}" for c in columns})
    on = same_keys(df, renamed, [(c, f"__d_{c}") for c in columns])
    return df.join(renamed, on).drop(*[f"__d_{c}" for c in columns])


def dense_rank_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """``dense_rank()`` of ``value`` ascending per key."""
    return join_levels(df, dense_levels(df, keys, value, name), [*keys, value])
