"""Values carried along an ordered group: forward fill and previous value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapframe.functions.expr import nulls_high
from lapframe.operators.keys import PART, attach_parts, split_hot_keys


def _sort_key(order: Sequence[str]) -> Column:
    """A struct that compares like ``ORDER BY ... NULLS LAST``."""
    fields = []
    for i, name in enumerate(order):
        fields += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*fields)


def fill_forward(
    df: DataFrame,
    columns: Mapping[str, str],
    keys: Sequence[str],
    order: Sequence[str],
    part: Column | Sequence[Column] | None = None,
    threshold: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add, per ``output: input``, the last non-null input at or before each row of its key.

    ``part`` (non-decreasing in the first order column, or one per order column) splits hot keys: the last value of each part
    is found by a partial aggregate, carried over the parts, and used where a part has none yet.
    ``sizes`` is a cheaper table to find hot keys in.
    """
    ordering = [nulls_high(c) for c in order]
    split = None if part is None else split_hot_keys(df, keys, part, threshold, sizes)
    if split is None:
        window = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(
            Window.unboundedPreceding, 0
        )
        return df.withColumns(
            {out: F.last(col, ignorenulls=True).over(window) for out, col in columns.items()}
        )
    sort_key = _sort_key(order)
    ends = split.filter(F.col(PART).isNotNull()).groupBy(*keys, PART).agg(
        *[
            F.max_by(F.col(col), F.when(F.col(col).isNotNull(), sort_key)).alias(f"__e_{out}")
            for out, col in columns.items()
        ]
    )
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys,
        PART,
        *[F.last(f"__e_{out}", ignorenulls=True).over(earlier).alias(f"__c_{out}") for out in columns],
    )
    window = Window.partitionBy(*keys, PART).orderBy(*ordering).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        attach_parts(split, carried, keys)
        .withColumns(
            {
                out: F.coalesce(F.last(col, ignorenulls=True).over(window), F.col(f"__c_{out}"))
                for out, col in columns.items()
            }
        )
        .drop(PART, *[f"__c_{out}" for out in columns])
    )


def previous_value(
    df: DataFrame,
    column: str,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    part: Column | Sequence[Column] | None = None,
    threshold: int | None = None,
) -> DataFrame:
    """``lag(column)`` per key, with hot keys split like in :func:`fill_forward`.

    ``column`` is wrapped in a one-field struct on the way, so a NULL value is told apart from the
    absence of an earlier row.
    """
    ordering = [nulls_high(c) for c in order]
    split = None if part is None else split_hot_keys(df, keys, part, threshold)
    if split is None:
        window = Window.partitionBy(*keys).orderBy(*ordering)
        return df.withColumn(name, F.lag(column).over(window))
    ends = split.filter(F.col(PART).isNotNull()).groupBy(*keys, PART).agg(
        F.max_by(F.struct(F.col(column).alias("v")), _sort_key(order)).alias("__end")
    )
    carried = ends.select(
        *keys,
        PART,
        F.lag("__end").over(Window.partitionBy(*keys).orderBy(PART)).alias("__carried"),
    )
    window = Window.partitionBy(*keys, PART).orderBy(*ordering)
    inner = F.lag(F.struct(F.col(column).alias("v"))).over(window)
    return (
        attach_parts(split, carried, keys)
        .withColumn(name, F.coalesce(inner, F.col("__carried"))["v"])
        .drop(PART, "__carried")
    )
