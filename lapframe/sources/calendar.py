"""Which sessions to load, and in which time slices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def meetings_by_start(meetings: DataFrame) -> DataFrame:
    return meetings.orderBy(F.col("date_start").asc_nulls_last(), "meeting_key")


def session_dates(sessions: DataFrame) -> DataFrame:
    """Distinct calendar dates on which a session starts, in order."""
    return sessions.select(F.to_date("date_start").alias("session_date")).distinct().orderBy(
        "session_date"
    )


def filter_session_days(
    df: DataFrame, sessions: DataFrame, date: str, by_session: bool = False
) -> DataFrame:
    """Rows of ``df`` whose ``date`` is a session date (of the row's own session on request)."""
    days = sessions.select(
        *(["session_key"] if by_session else []), F.to_date("date_start").alias("__day")
    ).distinct()
    marked = df.withColumn("__day", F.to_date(F.col(date)))
    keys = ["__day", "session_key"] if by_session else ["__day"]
    return marked.join(days, keys, "left_semi").drop("__day")


def latest_meeting(meetings: DataFrame) -> DataFrame:
    """The meeting with the latest start (one row)."""
    return meetings.orderBy(F.col("date_start").desc_nulls_last(), F.desc("meeting_key")).limit(1)


def time_slices(sessions: DataFrame, minutes: int = 5) -> DataFrame:
    """Consecutive slices of each session's time span; the last one ends with the session."""
    step = F.make_dt_interval(mins=F.lit(minutes))
    starts = F.sequence("date_start", "date_end", step)
    return (
        sessions.filter(F.col("date_start") < F.col("date_end"))
        .select("session_key", "date_end", F.posexplode(starts).alias("slice", "slice_start"))
        .filter(F.col("slice_start") < F.col("date_end"))
        .select(
            "session_key",
            "slice",
            "slice_start",
            F.least(F.col("slice_start") + step, F.col("date_end")).alias("slice_end"),
        )
    )


def slice_rows(df: DataFrame, sessions: DataFrame, date: str = "date", minutes: int = 5) -> DataFrame:
    """Rows of each time slice, with inclusive bounds.

    A row exactly on an inner bound belongs to both slices, as it would be extracted twice. Slices
    are regular, so the slice numbers follow from the time by arithmetic; the only join is with the
    sessions.
    """
    width = F.lit(minutes * 60 * 1_000_000)
    bounds = sessions.filter(F.col("date_start") < F.col("date_end")).select(
        "session_key", F.col("date_start").alias("__from"), F.col("date_end").alias("__to")
    )
    offset = F.unix_micros(F.col(date)) - F.unix_micros("__from")
    number = ((offset - F.pmod(offset, width)) / width).cast("int")
    on_bound = (F.pmod(offset, width) == 0) & (offset > 0)
    at_end = F.col(date) == F.col("__to")
    slices = (
        F.when(on_bound & at_end, F.array(number - 1))
        .when(on_bound, F.array(number - 1, number))
        .otherwise(F.array(number))
    )
    return (
        df.join(bounds, "session_key")
        .filter(F.col(date).between(F.col("__from"), F.col("__to")))
        .withColumn("slice", F.explode(slices))
        .drop("__from", "__to")
    )
