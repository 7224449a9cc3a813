"""Joins of events to intervals, and aggregates over intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe.functions.expr import seconds_between
from lapframe.operators.keys import HotKeys, find_hot_keys
from lapframe.operators.ranking import numbered

_BUCKET = "__bucket"
_LEVEL = "__level"
_CELL = "__cell"
# A span uses the first bucket width at which it covers no more buckets than this.
_SPAN_BUCKETS = 8


def _position(df: DataFrame, column: str) -> Column:
    """A column as a whole number: seconds for times, the floor for numbers."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(F.col(column))
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_seconds(F.col(column).cast(T.TimestampType()))
    return F.floor(F.col(column)).cast("long")


def _bucket(position: Column, width: int | None) -> Column:
    if width is None:  # the key alone
        return F.lit(0).cast("long")
    return ((position - F.pmod(position, F.lit(width))) / F.lit(width)).cast("long")


def _span_cells(
    spans: DataFrame, lo: str, hi: str, widths: Sequence[int | None], outer: bool
) -> DataFrame:
    """Spans once per bucket they cover, at the first width that gives few buckets."""
    first, last = _position(spans, lo), _position(spans, hi)
    level = F.lit(len(widths) - 1)
    for i in range(len(widths) - 2, -1, -1):
        fits = _bucket(last, widths[i]) - _bucket(first, widths[i]) < _SPAN_BUCKETS
        level = F.when(fits, F.lit(i)).otherwise(level)
    leveled = spans.withColumn(_LEVEL, level)
    covered = F.lit(None).cast("array<bigint>")
    for i, width in enumerate(widths):
        covered = F.when(
            F.col(_LEVEL) == i, F.sequence(_bucket(first, width), _bucket(last, width))
        ).otherwise(covered)
    covered = F.when(F.col(lo) <= F.col(hi), covered)
    generate = F.posexplode_outer if outer else F.posexplode
    return leveled.select("*", generate(covered).alias(_CELL, _BUCKET))


def _point_cells(points: DataFrame, at: str, widths: Sequence[int | None]) -> DataFrame:
    """Points once per width."""
    where = _position(points, at)
    marked = points.filter(F.col(at).isNotNull())
    if len(widths) == 1:
        return marked.withColumns({_LEVEL: F.lit(0), _BUCKET: _bucket(where, widths[0])})
    cells = F.array(
        *[
            F.struct(F.lit(i).alias(_LEVEL), _bucket(where, width).alias(_BUCKET))
            for i, width in enumerate(widths)
        ]
    )
    return marked.select(*points.columns, F.inline(cells))


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    at: str,
    lo: str,
    hi: str,
    widths: Sequence[int | None] = (600,),
) -> DataFrame:
    """Inner join of points to spans of the same key with ``lo <= at <= hi``.

    Both sides get a bucket of ``at`` as an extra hash key, so a large key is spread over its
    buckets and only pairs that share one are compared. A point has one bucket per width and a span
    one width, hence no pair is found twice. ``widths`` (ascending, in seconds or in units of the
    column) are tried in order; the last one takes every longer span, so the result is complete for
    any width and only the cost depends on it. A last width of None matches on the key alone: then no
    span is ever listed in more than a few buckets, however wrong its bounds.
    """
    return (
        _point_cells(points, at, widths)
        .join(_span_cells(spans, lo, hi, widths, outer=False), [*keys, _LEVEL, _BUCKET])
        .filter(F.col(at).between(F.col(lo), F.col(hi)))
        .drop(_LEVEL, _BUCKET, _CELL)
    )


def interval_matches(
    spans: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    at: str,
    lo: str,
    hi: str,
    widths: Sequence[int | None] = (600,),
) -> DataFrame:
    """Pairs of :func:`interval_join` for grouping by span, with every span kept.

    A span also yields one row without a point if its first bucket has no match. Aggregates that skip
    NULLs are not changed by it, and a group-by of the span's columns thus gives the result of a left
    join followed by a group-by.
    """
    cells = _span_cells(spans, lo, hi, widths, outer=True)
    names = [*keys, _LEVEL, _BUCKET]
    right = _point_cells(points, at, widths).withColumnsRenamed({k: f"__p_{k}" for k in names})
    on = F.col(at).between(F.col(lo), F.col(hi))
    for k in names:
        on = (F.col(k) == F.col(f"__p_{k}")) & on
    return (
        cells.join(right, on, "left")
        .filter(F.col(at).isNotNull() | (F.coalesce(_CELL, F.lit(0)) == 0))
        .drop(*[f"__p_{k}" for k in names], _LEVEL, _BUCKET, _CELL)
    )


def nearest_event_in_interval(
    events: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    span_key: str,
    at: str = "date",
    lo: str = "date_start",
    hi: str = "date_end",
    tie_breakers: Sequence[str] = (),
    widths: Sequence[int | None] = (600,),
    threshold: int | None = None,
) -> DataFrame:
    """Events inside each span with their distance and rank from its start and from its end.

    Adds ``start_time_diff``, ``end_time_diff`` (whole seconds) and ``start_position_rank``,
    ``end_position_rank`` per (keys, span_key). Both ranks share one exchange; groups of large keys are numbered by parts of
    the distance.
    """
    hot = _large_groups(events, spans, keys, span_key, at, lo, hi, widths, threshold)
    pairs = interval_join(events, spans, keys, at, lo, hi, widths).withColumns(
        {
            "start_time_diff": F.abs(seconds_between(at, lo)),
            "end_time_diff": F.abs(seconds_between(at, hi)),
        }
    )
    for side in ("start", "end"):
        distance = f"{side}_time_diff"
        part = F.floor(F.col(distance) / 16) if hot else None
        pairs = numbered(pairs, [*keys, span_key], [distance, *tie_breakers], f"{side}_position_rank", part=part, hot=hot)
    return pairs


def pair_counts(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], group: Sequence[str], at: str, lo: str, hi: str,
    widths: Sequence[int | None],
) -> DataFrame:
    """Pairs per (keys, group) that share a bucket, as ``__n``: points times spans of each bucket, summed up.

    No pair is built. The count is what :func:`interval_join` compares, so at least what it returns.
    """
    cell = [*keys, _LEVEL, _BUCKET]
    here = _point_cells(points.select(*keys, at), at, widths).groupBy(*cell).agg(F.count(F.lit(1)).alias("__p"))
    over = _span_cells(spans.select(*keys, *group, lo, hi), lo, hi, widths, outer=False).groupBy(*cell, *group)
    return over.agg(F.count(F.lit(1)).alias("__s")).join(here, cell).groupBy(*keys, *group).agg(F.sum(F.col("__p") * F.col("__s")).alias("__n"))


def _large_groups(
    events: DataFrame, spans: DataFrame, keys: Sequence[str], span_key: str, at: str, lo: str, hi: str,
    widths: Sequence[int | None], threshold: int | None,
) -> HotKeys | None:
    """Groups (keys, span_key) with many pairs, those without a span_key too.

    First events per key times spans per group, a bound that needs two counts; only keys beyond it are
    counted bucket by bucket.
    """
    group = [*keys, span_key]
    per_key = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("__p"))
    per_group = spans.groupBy(*group).agg(F.count(F.lit(1)).alias("__s"))
    most = per_group.join(per_key, list(keys)).select(*group, (F.col("__p") * F.col("__s")).alias("__n"))
    suspect = find_hot_keys(most, keys, threshold, "__n")
    if suspect is None:
        return None
    if not suspect.many:
        few = F.broadcast(events.sparkSession.createDataFrame(suspect.found, suspect.schema))  # <= MAX_HOT_KEYS rows
        events, spans = (df.join(few, list(keys), "left_semi") for df in (events, spans))
    return find_hot_keys(pair_counts(events, spans, keys, [span_key], at, lo, hi, widths), group, threshold, "__n")


# Nodes of the time tree are 2**level seconds long; level -1 holds points exactly on a second.
_TOP = 22
# Up to this level nodes are made from seconds; longer ones are made from the nodes of this level.
_MIDDLE = 7


def range_aggregate(
    spans: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    at: str,
    lo: str,
    hi: str,
    measures: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Aggregate the points with ``lo <= at <= hi`` for every distinct span (a left join).

    ``measures`` maps an output name to (point column, ``sum`` | ``count`` | ``min`` | ``max``).
    Spans without points keep NULLs (0 for counts). ``lo`` and ``hi`` must be whole seconds.

    Listing the matching pairs would grow with spans times points per key. Instead points are summed
    up per second and then per 2, 4, 8 ... seconds, and a span is cut into the few such nodes
    that tile it, about one per doubling of its length. The tree's size follows the length of the
    timeline, not the number of points, and the join has one row per node on the tree side. Adaptive
    execution broadcasts the tree once it has turned out small enough.
    """
    merge = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    leaf = {**merge, "count": F.count}
    node = [*keys, _LEVEL, _BUCKET]

    exact = F.pmod(F.unix_micros(F.col(at)), F.lit(1_000_000)) == 0
    inputs = sorted({column for column, _ in measures.values()})
    leaves = (
        points.filter(F.col(at).isNotNull())
        .select(*keys, F.unix_seconds(F.col(at)).alias("__second"), exact.alias("__exact"), *inputs)
        .groupBy(*keys, "__second", "__exact")
        .agg(*[leaf[how](column).alias(out) for out, (column, how) in measures.items()])
    )

    def nodes(parts: DataFrame, levels: Column) -> DataFrame:
        placed = parts.withColumn(_LEVEL, F.explode(levels)).withColumn(_BUCKET, _down(F.col("__second"), F.col(_LEVEL)))
        return placed.groupBy(*node).agg(*[merge[how](out).alias(out) for out, (_, how) in measures.items()])

    lowest = F.when(F.col("__exact"), -1).otherwise(0)
    # both ends of the tree read the seconds through one exchange; the upper one starts from few nodes
    middle = leaves.groupBy(*keys, F.shiftleft(_down(F.col("__second"), F.lit(_MIDDLE)), _MIDDLE).alias("__second")).agg(
        *[merge[how](out).alias(out) for out, (_, how) in measures.items()]
    )
    tree = nodes(leaves, F.sequence(lowest, F.lit(_MIDDLE))).unionByName(nodes(middle, F.sequence(F.lit(_MIDDLE + 1), F.lit(_TOP))))

    a, b = F.col("__a"), F.col("__b")
    # no node is longer than the span; a span that cannot hold any point gets no level at all
    longest = F.least(F.floor(F.log2(F.greatest(b - a, F.lit(1)))).cast("int"), F.lit(_TOP))
    pieces = (
        spans.withColumns({"__a": _whole_second(lo), "__b": _whole_second(hi)})
        .withColumn(
            _LEVEL, F.explode_outer(F.when(a <= b, F.sequence(F.lit(-1), longest)))
        )
        .withColumn(_BUCKET, F.explode_outer(_tiles(a, b, F.col(_LEVEL))))
    )
    totals = {
        out: F.coalesce(F.sum(out), F.lit(0)) if how == "count" else merge[how](out)
        for out, (_, how) in measures.items()
    }
    return (
        pieces.join(tree, node, "left")
        .groupBy(*spans.columns)
        .agg(*[total.alias(out) for out, total in totals.items()])
    )


def _whole_second(column: str) -> Column:
    micros = F.unix_micros(F.col(column))
    return F.when(
        F.pmod(micros, F.lit(1_000_000)) == 0, F.unix_seconds(F.col(column))
    ).when(micros.isNotNull(), F.raise_error(F.lit(f"{column} must be whole seconds")).cast("long"))


def _down(second: Column, level: Column) -> Column:
    """Number of the node of ``level`` that holds a second."""
    return F.call_function("shiftright", second, F.greatest(level, F.lit(0)))


def _tiles(a: Column, b: Column, level: Column) -> Column:
    """Node numbers at ``level`` in the tiling of the seconds [a, b) plus the instant b.

    Whole nodes of a level run from ``start`` to ``stop``; all but an odd one at either end are
    covered by nodes of the next level.
    """
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(level, F.lit(0)))
    start, stop = _down(a + step - 1, level), _down(b, level)
    none = F.lit(None).cast("long")
    left = F.when(F.pmod(start, F.lit(2)) == 1, start).otherwise(none)
    right = F.when(F.pmod(stop, F.lit(2)) == 1, stop - 1).otherwise(none)
    return (
        F.when(level == -1, F.array(b))
        .when(start >= stop, F.array().cast("array<bigint>"))
        .when(level == _TOP, F.sequence(start, stop - 1))
        .otherwise(F.array_compact(F.array(left, right)))
    )
