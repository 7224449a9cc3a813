"""The domain's raw tables derived from the generic test tables.

Every column is plain integer, dyadic floating point or time arithmetic, so that two SQL engines
give the same values bit for bit. The same formulas are written in SQL in ``oracle.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.operators import numbered
from lapframe.session import use_utc, zoned_timestamps

K2 = ["session_key", "driver_number"]


class Projection:
    """Raw tables of one data folder; each is built on first use."""

    TABLES = (
        "meetings", "sessions", "drivers", "laps", "car_data", "intervals", "position", "pit",
        "stints", "weather",
    )

    def __init__(self, spark: SparkSession, sf_dir: str):
        use_utc(spark)
        self.spark = spark
        self.base = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return zoned_timestamps(self.spark.read.parquet(f"{self.base}/{name}.parquet"))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.TABLES:
            raise KeyError(name)
        return getattr(self, name)

    def __contains__(self, name: str) -> bool:
        return name in self.TABLES

    @staticmethod
    def shape_events(events: DataFrame) -> DataFrame:
        """Events with session and driver; a session is three days of the month."""
        return events.select(
            "event_id",
            "ts",
            "event_type",
            "value",
            F.expr("CAST((day(ts) - 1) DIV 3 + 1 AS INT)").alias("session_key"),
            F.col("user_id").cast("int").alias("driver_number"),
        )

    @cached_property
    def ev(self) -> DataFrame:
        return self.shape_events(self.table("events"))

    @cached_property
    def ev_numbered(self) -> DataFrame:
        """Events with their running number per session and driver."""
        return numbered(
            self.ev, K2, ["ts", "event_id"], "rn", part=F.date_trunc("minute", F.col("ts"))
        )

    @property
    def later(self):
        """Event time moved by up to ten minutes."""
        return F.timestamp_micros(F.unix_micros("ts") + (F.col("event_id") % 600) * 1_000_000)

    @property
    def meeting(self):
        return (F.col("session_key") + 1000).alias("meeting_key")

    @cached_property
    def _venues(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )

    @cached_property
    def sessions(self) -> DataFrame:
        kind = F.when(F.col("n_nationkey") % 2 == 0, "Race").otherwise("Qualifying")
        start = F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + (
            F.col("n_nationkey") - 1
        ).cast("long") * (3 * 86400)
        return self._venues.select(
            F.col("n_nationkey").alias("session_key"),
            (F.col("n_nationkey") + 1000).alias("meeting_key"),
            F.col("r_name").alias("country_name"),
            F.col("n_name").alias("circuit_short_name"),
            kind.alias("session_name"),
            kind.alias("session_type"),
            F.lit(2024).alias("year"),
            F.timestamp_seconds(start).alias("date_start"),
            F.timestamp_seconds(start + 3 * 86400).alias("date_end"),
        )

    @cached_property
    def meetings(self) -> DataFrame:
        start = F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + (
            F.col("n_nationkey") - 1
        ).cast("long") * (3 * 86400)
        return self._venues.select(
            (F.col("n_nationkey") + 1000).alias("meeting_key"),
            F.col("n_nationkey").alias("circuit_key"),
            F.col("n_name").alias("circuit_short_name"),
            F.col("r_name").alias("country_name"),
            F.col("n_name").alias("meeting_name"),
            F.upper("n_name").alias("meeting_official_name"),
            F.timestamp_seconds(start).alias("date_start"),
            F.lit(2024).alias("year"),
        )

    @cached_property
    def drivers(self) -> DataFrame:
        name = F.col("c_name")
        pairs = self.ev.select(*K2).distinct()
        who = self.table("customer").withColumn("c_custkey", F.col("c_custkey").cast("int"))
        return pairs.join(who, F.col("driver_number") == F.col("c_custkey")).select(
            *K2,
            name.alias("broadcast_name"),
            F.substring(name, 1, 8).alias("first_name"),
            F.expr("substr(c_name, 10)").alias("last_name"),
            name.alias("full_name"),
            F.upper(F.substring(name, 1, 3)).alias("name_acronym"),
            F.col("c_mktsegment").alias("team_name"),
            F.concat(F.lit("C"), F.col("driver_number").cast("string")).alias("team_colour"),
            F.col("c_nationkey").cast("string").alias("country_code"),
        )

    @cached_property
    def laps(self) -> DataFrame:
        return self.ev_numbered.select(
            F.col("ts").alias("date_start"),
            "driver_number",
            self.meeting,
            "session_key",
            F.col("rn").alias("lap_number"),
            F.col("value").alias("duration_sector_1"),
            (F.col("value") / 2).alias("duration_sector_2"),
            (F.col("value") / 4).alias("duration_sector_3"),
            (F.col("value") * 100).alias("lap_duration"),
            (F.col("event_id") % 9 == 0).alias("is_pit_out_lap"),
        )

    @cached_property
    def position(self) -> DataFrame:
        return self.ev.filter(F.col("event_type").isin("click", "view")).select(
            self.meeting,
            *K2,
            (F.col("event_id") % 20 + 1).cast("int").alias("position"),
            self.later.alias("date"),
        )

    @cached_property
    def intervals(self) -> DataFrame:
        e = F.col("event_id")

        def text(a: int, b: int):
            return F.concat((e % a).cast("string"), F.lit("."), (e % b).cast("string"))

        leader = F.when(e % 10 == 0, "None").when(e % 10 == 1, "+1 LAP").otherwise(text(90, 7))
        ahead = F.when(e % 8 == 0, "None").when(e % 8 == 1, "+2 LAPS").otherwise(text(9, 5))
        return self.ev.filter(F.col("event_type").isin("purchase", "signup")).select(
            self.later.alias("date"),
            "driver_number",
            "session_key",
            self.meeting,
            leader.alias("gap_to_leader"),
            ahead.alias("interval"),
        )

    @cached_property
    def pit(self) -> DataFrame:
        return self.ev_numbered.filter("event_type = 'signup'").select(
            F.col("ts").alias("date"),
            "driver_number",
            self.meeting,
            F.col("rn").alias("lap_number"),
            F.col("value").alias("pit_duration"),
            "session_key",
        )

    @cached_property
    def weather(self) -> DataFrame:
        cents = F.round(F.col("value") * 100).cast("long").cast("double")
        e = F.col("event_id")
        return self.ev.filter("event_type = 'error'").select(
            "session_key",
            F.col("ts").alias("date"),
            (F.lit(10.0) + cents / 2048).alias("air_temperature"),
            (F.lit(15.0) + cents / 1024).alias("track_temperature"),
            (e % 100).cast("double").alias("humidity"),
            F.when(e % 701 == 0, 1.0).otherwise(0.0).alias("rainfall"),
            (e % 12).cast("double").alias("wind_speed"),
        )

    @staticmethod
    def car_of(ev: DataFrame, *extra: str) -> DataFrame:
        e = F.col("event_id")

        def number(value, name: str):
            return value.cast("int").alias(name)

        return ev.select(
            (F.col("session_key") + 1000).alias("meeting_key"),
            *K2,
            F.col("ts").alias("date"),
            number(e * 37 % 16000, "rpm"),
            number(e * 13 % 420, "speed"),
            number(e * 7 % 115, "throttle"),
            number(e * 11 % 115, "brake"),
            number(e % 16, "drs"),
            number(e % 9, "n_gear"),
            *extra,
        )

    @cached_property
    def car_data(self) -> DataFrame:
        return self.car_of(self.ev)

    @cached_property
    def stints(self) -> DataFrame:
        group = F.expr("CAST((rn - 1) DIV 3 AS INT)")
        g = F.col("grp")
        compound = F.when(g % 7 == 0, "SOFT").when(g % 7 == 1, "MEDIUM").when(g % 7 == 2, "HARD")
        compound = compound.when(g % 7 == 3, "INTERMEDIATE").when(g % 7 == 4, "WET")
        compound = compound.when(g % 7 == 6, "UNKNOWN")
        return (
            self.ev_numbered.withColumn("grp", group)
            .groupBy(*K2, "grp")
            .agg(F.min("rn").alias("lap_start"), F.max("rn").alias("lap_end"))
            .select(
                "session_key",
                self.meeting,
                "driver_number",
                (g + 1).alias("stint_number"),
                compound.alias("compound"),
                "lap_start",
                "lap_end",
                (g * 5 % 30).alias("tyre_age_at_start"),
            )
        )

    @cached_property
    def race_control(self) -> DataFrame:
        """Messages, a third of them about no driver."""
        e = F.col("event_id")
        return self.ev.select(
            F.col("event_type").alias("category"),
            F.col("ts").alias("date"),
            F.when(e % 3 != 0, F.col("driver_number")).alias("driver_number"),
            F.when(e % 4 == 0, "YELLOW").when(e % 4 == 1, "GREEN").alias("flag"),
            F.concat(F.lit("message "), (e % 50).cast("string")).alias("message"),
            (e % 60).cast("int").alias("lap_number"),
            (F.col("session_key") + 1000).cast("string").alias("meeting_key"),
            F.lit("Track").alias("scope"),
            F.lit(None).cast("string").alias("sector"),
            "session_key",
        )

    @cached_property
    def team_radio(self) -> DataFrame:
        return self.ev.filter("event_type = 'view'").select(
            self.meeting,
            *K2,
            F.col("ts").alias("date"),
            F.concat(F.lit("radio/"), F.col("event_id").cast("string")).alias("recording_url"),
        )

    @cached_property
    def location(self) -> DataFrame:
        e = F.col("event_id")
        return self.ev.filter("event_type <> 'error'").select(
            "event_id",
            ((e % 4000) / 4).cast("float").alias("x"),
            ((e % 900) / 2 - 100).cast("float").alias("y"),
            (e % 7).cast("float").alias("z"),
            *K2,
            self.meeting,
            self.later.alias("date"),
        )
