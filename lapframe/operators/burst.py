"""Bursts: readings with another kept reading close by in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.operators.keys import same_keys


def sustained_burst(
    df: DataFrame, condition: Column, ts: str, gap_ms: int = 500, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows meeting ``condition`` whose previous or next such row is less than ``gap_ms`` away.

    Without ``keys`` the whole table is one timeline. A window over it would need one task; here
    time is cut into cells of ``gap_ms``. Two rows in one cell are always close enough, so a cell
    counts as a whole: it holds two rows, or its single row is near the last row of the cell before or
    the first of the cell after. Cells are built by hash aggregates and rows are picked by a semi join.
    """
    kept = df.filter(condition & F.col(ts).isNotNull())
    ms = F.unix_millis(F.col(ts))
    width = F.lit(gap_ms)
    cell = ((ms - F.pmod(ms, width)) / width).cast("long")
    placed = kept.withColumn("__cell", cell)
    cells = (
        placed.select(*keys, "__cell", ms.alias("__ms"))
        .groupBy(*keys, "__cell")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("__ms").alias("lo"), F.max("__ms").alias("hi")
        )
    )
    # each cell also tells its neighbours where its first and last rows are
    views = cells.select(
        *keys,
        F.inline(
            F.array(
                _view(F.col("__cell"), n=F.col("n"), lo=F.col("lo"), hi=F.col("hi")),
                _view(F.col("__cell") + 1, before=F.col("hi")),
                _view(F.col("__cell") - 1, after=F.col("lo")),
            )
        ),
    )
    close = (
        views.groupBy(*keys, "cell")
        .agg(*[F.max(c).alias(c) for c in ("n", "lo", "hi", "before", "after")])
        .filter(
            (F.col("n") >= 2)
            | (F.col("lo") - F.col("before") < width)
            | (F.col("after") - F.col("hi") < width)
        )
        .filter(F.col("n").isNotNull())
        .select(*[F.col(k).alias(f"__r_{k}") for k in keys], "cell")
    )
    on = placed["__cell"] == close["cell"]
    if keys:
        on = on & same_keys(placed, close, [(k, f"__r_{k}") for k in keys])
    return placed.join(close, on, "left_semi").drop("__cell")


def _view(cell: Column, **values: Column) -> Column:
    null = F.lit(None).cast("long")
    names = ("n", "lo", "hi", "before", "after")
    return F.struct(cell.alias("cell"), *[values.get(n, null).alias(n) for n in names])
