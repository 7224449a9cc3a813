"""Data-quality checks: each returns failing rows, many are counted in one scan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.operators.burst import sustained_burst


@dataclass(frozen=True)
class Check:
    """A named test of a table.

    ``bad`` is set for checks that look at one row at a time; ``find`` for those that need a
    group, another table or neighbouring rows: it maps (rows, referenced tables) to failing rows.
    """

    name: str
    column: str
    bad: Callable[[], Column] | None = None
    find: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame] | None = None
    where: str | None = None

    def scope(self) -> Column:
        return F.lit(True) if self.where is None else F.expr(self.where)

    def failures(self, df: DataFrame, refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
        rows = df if self.where is None else df.filter(self.where)
        return rows.filter(self.bad()) if self.bad else self.find(rows, refs or {})


def not_null(column: str, where: str | None = None) -> Check:
    return Check("not_null", column, bad=lambda: F.col(column).isNull(), where=where)


def accepted_values(
    column: str, values: Sequence, where: str | None = None, name: str = "accepted_values"
) -> Check:
    """Values outside the list fail; NULL never does."""
    allowed = [v for v in values if v is not None]
    return Check(name, column, bad=lambda: ~F.col(column).isin(allowed), where=where)


def range_check(
    column: str, lo, hi, where: str | None = None, name: str = "range_check"
) -> Check:
    """Values below ``lo`` or above ``hi`` fail; NULL never does."""
    return Check(name, column, bad=lambda: ~F.col(column).between(lo, hi), where=where)


def range_violation_count(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """The number of values out of range, as one row."""
    return range_check(column, lo, hi).failures(df).agg(F.count(F.lit(1)).alias("n_failed"))


def unique(column: str | Sequence[str], where: str | None = None) -> Check:
    """Keys that occur more than once fail, one row per key; NULL keys are left out."""
    cols = [column] if isinstance(column, str) else list(column)

    def find(rows: DataFrame, refs: Mapping[str, DataFrame]) -> DataFrame:
        return (
            rows.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter("n_records > 1")
        )

    return Check("unique", ",".join(cols), find=find, where=where)


def relationships(column: str, parent: str, field: str, where: str | None = None) -> Check:
    """Non-null values that do not occur in ``parent.field`` fail."""

    def find(rows: DataFrame, refs: Mapping[str, DataFrame]) -> DataFrame:
        known = refs[parent].select(F.col(field).alias("__known")).distinct()
        child = rows.filter(F.col(column).isNotNull())
        return child.join(known, F.col(column) == F.col("__known"), "left_anti")

    return Check("relationships", column, find=find, where=where)


def sustained(
    name: str, condition: Callable[[], Column], ts: str, gap_ms: int = 500, keys: Sequence[str] = ()
) -> Check:
    """Rows meeting ``condition`` with another such row less than ``gap_ms`` away fail."""
    return Check(
        name, ts, find=lambda rows, refs: sustained_burst(rows, condition(), ts, gap_ms, keys)
    )


def _counts(i: int, check: Check, n_checked: Column, n_failed: Column) -> Column:
    return F.struct(
        F.lit(i).alias("i"),
        F.lit(check.name).alias("check"),
        F.lit(check.column).alias("column"),
        n_checked.alias("n_checked"),
        n_failed.alias("n_failed"),
    )


def run_checks(
    df: DataFrame,
    checks: Sequence[Check],
    refs: Mapping[str, DataFrame] | None = None,
    table: str = "",
) -> DataFrame:
    """One row per check: table, check, column, n_checked, n_failed, passed.

    All row-at-a-time checks, and the numbers of rows that the others look at, share one scan and one
    partial aggregate.
    """
    refs = refs or {}
    totals, rows = [], []
    for i, check in enumerate(checks):
        scope = check.scope()
        failed = F.count_if(scope & check.bad()) if check.bad else F.lit(0).cast("long")
        totals += [F.count_if(scope).alias(f"c{i}"), failed.alias(f"f{i}")]
        rows.append(_counts(i, check, F.col(f"c{i}"), F.col(f"f{i}")))
    parts = [df.agg(*totals).select(F.inline(F.array(*rows)))]
    for i, check in enumerate(checks):
        if not check.bad:  # what it checks is counted above; only its failures need a plan of their own
            found = check.failures(df, refs).agg(F.count(F.lit(1)).alias("n"))
            parts.append(found.select(F.inline(F.array(_counts(i, check, F.lit(0).cast("long"), F.col("n"))))))
    counts = reduce(DataFrame.unionByName, parts)
    out = (
        counts.groupBy("i", "check", "column")
        .agg(F.sum("n_checked").alias("n_checked"), F.sum("n_failed").alias("n_failed"))
        .drop("i")
    )
    return out.select(
        F.lit(table).alias("table"), "*", (F.col("n_failed") == 0).alias("passed")
    )
