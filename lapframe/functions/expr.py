"""Column helpers that pin down the dialect the models are written in.

All of them are built-in expressions and stay inside code generation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapframe.schemas import POINTS


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def nulls_high(column: Column | str, descending: bool = False) -> Column:
    """Sort order in which NULL is the greatest value: last ascending, first descending."""
    column = _c(column)
    return column.desc_nulls_first() if descending else column.asc_nulls_last()


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (0.9 s to 1.1 s is 1, not 0)."""
    return F.unix_seconds(_c(end)) - F.unix_seconds(_c(start))


def millis_between(start: Column | str, end: Column | str) -> Column:
    """Millisecond boundaries crossed from ``start`` to ``end``."""
    return F.unix_millis(_c(end)) - F.unix_millis(_c(start))


def add_whole_seconds(ts: Column | str, seconds: Column | str) -> Column:
    """``ts`` plus ``seconds`` rounded half away from zero to a whole number of seconds."""
    whole = F.round(_c(seconds)).cast("long")
    return F.timestamp_micros(F.unix_micros(_c(ts)) + whole * F.lit(1_000_000))


def numeric_gap(gap: Column | str) -> Column:
    """A gap in seconds; lapped texts (any text with an ``L``) and non-numbers become NULL."""
    gap = _c(gap)
    return F.when(~gap.contains("L"), gap.try_cast("double"))


def case_lookup(column: Column | str, mapping: Mapping, default) -> Column:
    """CASE column WHEN key THEN value ... ELSE default END."""
    column = _c(column)
    out = None
    for key, value in mapping.items():
        hit = column == F.lit(key)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def points_for(position: Column | str, table: Mapping[int, int] = POINTS) -> Column:
    return case_lookup(position, table, 0)


def bracket_label(*parts: Column | str, outer: Column | str) -> Column:
    """``a - b (outer)``; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(" - "))
        pieces.append(_c(part))
    return F.concat(*pieces, F.lit(" ("), _c(outer), F.lit(")"))


def session_label(year: Column | str, country: Column | str, name: Column | str) -> Column:
    sep = F.lit(" - ")
    return F.concat(_c(year).cast("int").cast("string"), sep, _c(country), sep, _c(name))
