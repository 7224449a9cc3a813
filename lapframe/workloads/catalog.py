"""All queries: name -> function of (spark, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lapframe import quality, sinks, sources, streaming
from lapframe.plans import Warehouse
from lapframe.quality.suite import BRAKE, RPM, VALID_DRS, pedal_overlap
from lapframe.schemas import COMPOUNDS, REQUIRED_FIELDS, merge_keys
from lapframe.session import naive_timestamps, scratch_dir, zoned_timestamps
from lapframe.streaming.counts import latest_counts
from lapframe.workloads import oracle
from lapframe.workloads.projection import Projection

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Projection], DataFrame]) -> Callable[[Projection], DataFrame]:
    """Register a query; times leave as naive UTC so that any client reads the same values."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return naive_timestamps(fn(Projection(spark, sf_dir)))

    QUERIES[fn.__name__] = run
    return fn


# ---- models ----
_ROUNDED = {
    "race_summary": ["average_speed"],
    "race_summary_dedup": ["average_speed"],
    "compound_performance": ["circuit_compound_avg_stint", "avg_tire_age_start"],
}


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(Warehouse(Projection(spark, sf_dir)), name)
        # means of means depend on the order of summation in their last bits
        df = df.withColumns({c: F.round(c, 6) for c in _ROUNDED.get(name, [])})
        if name == "session_filters":
            df = df.withColumn(
                "available_driver_names", F.array_join("available_driver_names", ";")
            )
        return naive_timestamps(df)

    return run


for _name in Warehouse.MODELS:
    QUERIES[_name] = _model(_name)


# ---- quality ----
@query
def dq_not_null(p: Projection) -> DataFrame:
    return quality.not_null("gap_to_leader").failures(Warehouse(p).stg_intervals)


@query
def dq_unique(p: Projection) -> DataFrame:
    return quality.unique("driver_number").failures(Warehouse(p).stg_drivers)


@query
def dq_relationships(p: Projection) -> DataFrame:
    team = {"team": p.drivers.filter("team_name = 'MACHINERY'")}
    return quality.relationships("driver_number", "team", "driver_number").failures(
        p.car_data, team
    )


@query
def dq_accepted_values(p: Projection) -> DataFrame:
    """Compounds for a wet track, by the list of the dry ones."""
    return quality.accepted_values("compound", COMPOUNDS[:3]).failures(p.stints)


@query
def dq_range(p: Projection) -> DataFrame:
    return RPM.failures(p.car_data)


@query
def dq_range_count(p: Projection) -> DataFrame:
    return quality.range_violation_count(p.car_data, BRAKE.column, 0, 100)


@query
def dq_valid_codes(p: Projection) -> DataFrame:
    return VALID_DRS.failures(p.car_data)


@query
def dq_sustained_burst(p: Projection) -> DataFrame:
    return pedal_overlap(brake=50, throttle=50, gap_ms=60_000).failures(p.car_data)


@query
def dq_report(p: Projection) -> DataFrame:
    return quality.run_suite({t: p[t] for t in quality.SUITE})


# ---- load path ----
def _stamp(day: str):
    return F.lit(day).cast("timestamp")


@query
def merge_upsert(p: Projection) -> DataFrame:
    old, new = _stamp("2024-02-01"), _stamp("2024-02-02")
    columns = [*merge_keys("car_data"), "speed", "rpm"]
    base = p.car_of(p.ev.filter("event_type <> 'signup'")).select(
        *columns, old.alias("created_at"), old.alias("updated_at")
    )
    batch = p.car_of(p.ev.filter("event_type <> 'click'")).select(*columns)
    batch = batch.withColumn("speed", F.col("speed") + 1)
    return sinks.merge_upsert(base, batch, merge_keys("car_data"), now=new)


def _table_then_batch(p: Projection, path: str) -> DataFrame:
    """A first load of a table, then a batch that changes some partitions of it."""
    columns = [*merge_keys("car_data"), "speed", "rpm"]
    base = p.car_of(p.ev.filter("event_type <> 'signup' AND session_key < 9")).select(*columns)
    batch = p.car_of(p.ev.filter("event_type <> 'click' AND session_key > 4")).select(*columns)
    batch = batch.withColumns({"speed": F.col("speed") + 1, "marked": F.lit(True)})
    keys = merge_keys("car_data")
    sinks.upsert_table(p.spark, path, base, keys, now=_stamp("2024-02-01"))
    sinks.upsert_table(p.spark, path, batch, keys, now=_stamp("2024-02-02"), new_columns="add")
    schema = _schema(p.spark, "meeting_key int, driver_number int, date timestamp, speed int, rpm int, "
                     "created_at timestamp, updated_at timestamp, marked boolean, session_key int")
    return p.spark.read.schema(schema).parquet(path)


@query
def upsert_table(p: Projection) -> DataFrame:
    return _table_then_batch(p, scratch_dir(p.spark, "upserted"))


@query
def upsert_race_control(p: Projection) -> DataFrame:
    """Messages about no driver match nothing; one load is stopped half way and another comes twice."""
    path, keys = scratch_dir(p.spark, "race-control"), merge_keys("race_control")
    first = p.race_control.filter("category <> 'signup'")
    second = p.race_control.filter("category <> 'click'").withColumn("flag", F.lit("RED"))
    stamps = [("load 1", first, "2024-02-01"), ("load 2", second.filter("session_key <= 5"), "2024-02-02")]
    stamps += [("load 2", second, "2024-02-02"), ("load 2", second, "2024-02-02"), ("load 1", first.limit(0), "2024-02-01")]
    for load_id, batch, day in stamps:
        sinks.upsert_table(p.spark, path, batch, keys, now=_stamp(day), load_id=load_id)
    schema = [*p.race_control.schema.fields, *_schema(p.spark, "created_at timestamp, updated_at timestamp, load_id string").fields]
    return p.spark.read.schema(T.StructType(schema)).parquet(path)


def _landed(df: DataFrame, upper: bool = False) -> DataFrame:
    """Records landed as files of JSON lines, times as text; keys in upper case on request. NULL fields are left out."""
    texts = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for c, kind in df.dtypes if kind == "timestamp"}
    rows = df.withColumns(texts)
    rows = rows.toDF(*[c.upper() for c in rows.columns]) if upper else rows
    return _files(rows.select(F.to_json(F.struct(*rows.columns)).alias("value")))


def _files(lines: DataFrame) -> DataFrame:
    path = scratch_dir(lines.sparkSession, "landed")
    lines.write.text(path)
    return lines.sparkSession.read.text(path)


def _loaded(p: Projection) -> str:
    """Two loads of landed lines: the second meets sessions that exist, and two of its tables fail."""
    base, day = scratch_dir(p.spark, "loaded"), "2024-02-0"
    car = p.car_of(p.ev, "event_id").withColumn("date", F.when(F.col("event_id") % 11 != 0, F.col("date"))).drop("event_id")
    broken = _files(p.ev.filter("event_id % 97 = 0").select(F.substring(F.to_json(F.struct("event_id", "value")), 1, 9).alias("value")))
    sinks.load_batch(p.spark, base, {"pit": _landed(p.pit.filter("session_key <= 3"), upper=True)}, p.sessions, day + "1", "load 1", now=_stamp(day + "1"))
    landed = {
        "pit": _landed(p.pit, upper=True).unionByName(broken),
        "weather": _landed(p.weather),  # its records lack a merge key
        "position": _landed(p.position),  # its check fails
        "intervals": _landed(p.intervals.withColumn("gap_to_leader", F.nullif("gap_to_leader", F.lit("None")))),
        "race_control": _landed(p.race_control),
        "team_radio": _landed(p.team_radio.filter("session_key <> 4").dropDuplicates(["session_key"])),
        "car_data": _landed(car),
    }
    checks = {"position": [quality.range_check("position", 1, 15)], "pit": [quality.not_null("date")]}
    sinks.load_batch(p.spark, base, landed, p.sessions, day + "2", "load 2", checks, now=_stamp(day + "2"))
    # the second time changes nothing, for messages about no driver neither
    again = {"race_control": landed["race_control"]}
    sinks.load_batch(p.spark, base, again, p.sessions, day + "2", "load 2", checks, now=_stamp(day + "2"))
    return base


@query
def load_batch(p: Projection) -> DataFrame:
    return sinks.read_ledger(p.spark, _loaded(p), "load 2")


@query
def load_published(p: Projection) -> DataFrame:
    """The published tables per session, read with their declared schemas, and the rejects."""
    base = _loaded(p)
    tables = sources.load_sources(p.spark, base, ["pit", "intervals", "race_control", "team_radio", "car_data"], audit=True)
    per_table = [
        df.groupBy("session_key").agg(
            F.count(F.lit(1)).alias("records"),
            F.count("driver_number").alias("with_driver"),
            F.countDistinct("processed_date").alias("days"),
            F.min("created_at").alias("created_at"),
        ).withColumn("name", F.lit(name))
        for name, df in tables.items()
    ]
    rejects = sinks.read_rejects(p.spark, base, "load 2").groupBy(F.concat_ws(": ", "endpoint", "reason").alias("name")).agg(F.count(F.lit(1)).alias("records"))
    return reduce(DataFrame.unionByName, per_table).unionByName(rejects, allowMissingColumns=True)


@query
def only_new(p: Projection) -> DataFrame:
    return sources.only_new(
        p.car_data, p.pit.filter("pit_duration > 350"), ["meeting_key", "session_key"]
    ).select(*p.car_data.columns)


@query
def schema_evolution(p: Projection) -> DataFrame:
    return sinks.add_missing_columns(p.pit, now=_stamp("2024-02-02"))


@query
def required_fields(p: Projection) -> DataFrame:
    records = p.ev.select(
        "event_id",
        (F.col("session_key") + 1000).alias("meeting_key"),
        "session_key",
        F.when(F.col("event_type") != "error", F.col("driver_number")).alias("driver_number"),
        F.when(~(F.col("value") < 5), F.col("ts")).alias("date"),
    )
    valid, rejected = sources.require_fields(records, REQUIRED_FIELDS["car_data"])
    return valid.select("event_id", F.lit(True).alias("valid")).unionByName(
        rejected.select("event_id", F.lit(False).alias("valid"))
    )


@query
def coerce_strings(p: Projection) -> DataFrame:
    gaps = p.ev.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_id") % 90).alias("gap_to_leader"),
    )
    return sources.coerce_to_string(gaps, ["gap_to_leader", "interval"])


@query
def calendar_filter(p: Projection) -> DataFrame:
    return sources.filter_session_days(p.car_data, p.sessions, "date")


@query
def session_dates(p: Projection) -> DataFrame:
    return sources.session_dates(p.sessions)


@query
def time_slices(p: Projection) -> DataFrame:
    return sources.time_slices(p.sessions)


@query
def slice_rows(p: Projection) -> DataFrame:
    return sources.slice_rows(p.car_data, p.sessions).select(*p.car_data.columns, "slice")


@query
def latest_meeting(p: Projection) -> DataFrame:
    return sources.latest_meeting(p.meetings)


@query
def load_report(p: Projection) -> DataFrame:
    return sinks.load_report(p.sessions, "pit", p.pit.filter("pit_duration > 350"), p.pit)


@query
def infer_schema(p: Projection) -> DataFrame:
    records = p.table("events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_date"),
        "user_id",
        "event_type",
        "value",
    )
    sample = records.first().asDict()  # one record, as the rule asks for
    schema = sources.infer_schema(sample)
    lines = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
    return sources.records.parse_records(lines, schema)


@query
def read_records(p: Projection) -> DataFrame:
    """Lines holding one object, or a list of a few, written and read back."""
    record = F.struct(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"),
        "event_type",
        "value",
    )
    events = p.table("events")
    single = events.filter("event_type = 'click'").select(F.to_json(record).alias("value"))
    lists = (
        events.filter("event_type <> 'click'")
        .groupBy(F.expr("event_id DIV 4"))  # at most four records
        .agg(F.collect_list(record).alias("records"))
        .select(F.to_json("records").alias("value"))
    )
    path = scratch_dir(p.spark, "records")
    single.unionByName(lists).write.text(path)
    schema = "event_id bigint, date timestamp, event_type string, value double"
    return sources.read_records(p.spark, path, _schema(p.spark, schema))


@query
def rejected_records(p: Projection) -> DataFrame:
    """Every seventh line is cut off."""
    events = p.table("events")
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    lines = events.select(F.when(F.col("event_id") % 7 == 0, F.substring(line, 1, 10)).otherwise(line).alias("value"))
    return sources.rejected_records(lines)


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


@query
def staged_publish(p: Projection) -> DataFrame:
    path = scratch_dir(p.spark, "published")
    sinks.stage_and_publish(
        p.spark, p.position, path, quality.SUITE["position"], sort_by=["driver_number", "date"]
    )
    return p.spark.read.schema(p.position.schema).parquet(path)


@query
def table_layout(p: Projection) -> DataFrame:
    path = scratch_dir(p.spark, "laps")
    sinks.write_table(p.laps, path, ["session_key"], ["driver_number", "lap_number"])
    return p.spark.read.schema(p.laps.schema).parquet(path)


@query
def point_lookup(p: Projection) -> DataFrame:
    """One driver of a table that is laid out by session and time."""
    path = scratch_dir(p.spark, "by-time")
    sinks.write_table(p.car_data, path, ["session_key"], ["date"], look_up_by=["driver_number"])
    return p.spark.read.schema(p.car_data.schema).parquet(path).filter("driver_number = 55")


# ---- live path ----
def _car_payload(p: Projection, ev: DataFrame) -> DataFrame:
    return streaming.format_records(p.car_of(ev, "event_id"), "car", F.col("event_id"))


@query
def format_records(p: Projection) -> DataFrame:
    gaps = streaming.format_records(p.intervals, "intervals")
    return gaps.drop("id").withColumns(
        {c: F.col(c).cast("double") for c in ("gap_to_leader", "time_interval")}
    )


@query
def encode_decode(p: Projection) -> DataFrame:
    return streaming.decode_envelope(
        streaming.encode_envelope(_car_payload(p, p.ev), "car"), "car"
    )


@query
def route_types(p: Projection) -> DataFrame:
    messages = reduce(
        DataFrame.unionByName,
        [
            streaming.encode_envelope(streaming.format_records(df, kind), kind)
            for kind, df in (
                ("car", p.car_data), ("position", p.position), ("intervals", p.intervals)
            )
        ],
    )
    routed = streaming.route_by_fields(streaming.payload_map(messages))
    return streaming.running_counts(
        routed.withColumn("driver_number", F.col("payload")["driver_number"].cast("int"))
    )


@query
def replay_slice(p: Projection) -> DataFrame:
    return streaming.replay_slice(p.car_data, 4, 5, "2024-01-10T06:00:00", minutes=24 * 60)


def _busy(ev: DataFrame) -> DataFrame:
    """Messages of three drivers with coarse times, so that most fall into the second before."""
    return ev.select(
        "event_id", (F.col("driver_number") % 3).alias("driver_number"), F.date_trunc("hour", F.col("ts")).alias("date")
    )


@query
def throttle_batch(p: Projection) -> DataFrame:
    ev = _busy(p.ev)
    return streaming.throttle_batch(
        ev, order=["date", "event_id"], part=F.date_trunc("minute", F.col("date"))
    )


def _event_stream(p: Projection) -> DataFrame:
    """The events table as a stream of its files."""
    stored = p.spark.read.parquet(f"{p.base}/events.parquet").schema
    stream = p.spark.readStream.schema(stored).option("maxFilesPerTrigger", 1000)
    # written as a pattern, the path may be one file or a folder of part files
    return p.shape_events(zoned_timestamps(stream.parquet(f"{p.base}/event[s].parquet")))


# Rows per file of a stream's micro-batch, which has as many files as it takes.
FILE_ROWS = 250_000


def _in_turn(path: str, kind: str, parts: list[DataFrame], start: Callable[[], StreamingQuery]) -> None:
    """Each part is one micro-batch, in turn, of any number of files: the stream goes on when they have landed."""
    for part in parts:
        part.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).format(kind).save(path)
        start().awaitTermination()


def _slices(rows: DataFrame, slices: int = 4) -> list[DataFrame]:
    """Rows in the order of sessions, which is that of time."""
    return [rows.filter(F.expr(f"(session_key - 1) * {slices} DIV 10") == i) for i in range(slices)]


def _sliced_stream(p: Projection, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """The events as several micro-batches, which come in the order of time."""
    path = scratch_dir(p.spark, "slices")
    _in_turn(path, "parquet", _slices(p.ev), lambda: start(p.spark.readStream.schema(p.ev.schema).parquet(path)))


def _twice(stream: DataFrame) -> DataFrame:
    """Messages with a high value arrive a second time."""
    return stream.withColumn("again", F.explode(F.when(F.col("value") > 100, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("again")


@query
def stream_dedup(p: Projection) -> DataFrame:
    """Every message with a high value arrives twice; however the files come, no record is lost."""
    events, again = _event_stream(p), _event_stream(p).filter("value > 100")
    messages = streaming.encode_envelope(_car_payload(p, events.unionByName(again)), "car")
    payload = streaming.decode_envelope(messages, "car")
    out, mark = scratch_dir(p.spark, "dedup"), scratch_dir(p.spark, "dedup-checkpoint")
    streaming.write_unique(payload, out, mark, buckets=4).awaitTermination()
    return streaming.read_batches(payload, out)


@query
def stream_dedup_batches(p: Projection) -> DataFrame:
    """The same over micro-batches, of which each repeats the messages of earlier ones."""
    path = scratch_dir(p.spark, "repeated")
    out, mark = scratch_dir(p.spark, "dedup"), scratch_dir(p.spark, "dedup-checkpoint")

    def start() -> StreamingQuery:
        payload = _car_payload(p, p.spark.readStream.schema(p.ev.schema).parquet(path))
        return streaming.write_unique(payload, out, mark, buckets=4, merge_every=2)

    parts = [p.ev.filter(F.col("session_key") <= upto) for upto in (3, 6, 10)]  # all sessions so far
    _in_turn(path, "parquet", parts, start)
    return streaming.read_batches(_car_payload(p, p.ev), out)


@query
def stream_throttle(p: Projection) -> DataFrame:
    ev = _busy(_event_stream(p))
    out, state = scratch_dir(p.spark, "throttle"), scratch_dir(p.spark, "throttle-state")
    mark = scratch_dir(p.spark, "throttle-checkpoint")
    streaming.write_throttled(ev, out, state, mark, tie_breaker="event_id", buckets=4).awaitTermination()
    return p.spark.read.option("basePath", out).parquet(f"{out}/batch_id=*").select(*ev.columns)


@query
def stream_throttle_state(p: Projection) -> DataFrame:
    """The same through keyed state, over several micro-batches."""
    out, mark = scratch_dir(p.spark, "throttle"), scratch_dir(p.spark, "throttle-checkpoint")
    _sliced_stream(p, lambda ev: streaming.start_sink(streaming.throttle_per_second(_busy(ev), tie_breaker="event_id"), out, mark))
    return p.spark.read.schema(_busy(p.ev).schema).parquet(out)


@query
def stream_counts(p: Projection) -> DataFrame:
    counts = streaming.running_counts(
        _event_stream(p).withColumnRenamed("event_type", "kind")
    )
    out, mark = scratch_dir(p.spark, "counts"), scratch_dir(p.spark, "counts-checkpoint")
    streaming.write_running_counts(counts, out, mark).awaitTermination()
    return latest_counts(counts, out)


@query
def stream_sink(p: Projection) -> DataFrame:
    """Micro-batches into a table whose ``id`` is unique, some messages arriving twice."""
    events, again = _event_stream(p), _event_stream(p).filter("value > 100")
    payload = _car_payload(p, events.unionByName(again))
    out, mark = scratch_dir(p.spark, "sink"), scratch_dir(p.spark, "sink-checkpoint")
    streaming.write_batches(payload, out, mark, partition_by=["session_key"]).awaitTermination()
    return p.spark.read.schema(payload.schema).parquet(out)


@query
def stream_load_metrics(p: Projection) -> DataFrame:
    """Over several micro-batches; counts are observed, not taken by reading again."""
    out, seen = scratch_dir(p.spark, "metered"), scratch_dir(p.spark, "metrics")
    mark = scratch_dir(p.spark, "metered-checkpoint")
    kinds = ["click", "view", "purchase", "signup", "error"]

    def start(events: DataFrame) -> StreamingQuery:
        rows = _twice(events).select(F.col("event_type").alias("kind"), F.col("event_id").alias("id"), "value")
        return streaming.metered_sink(rows, out, seen, mark, kinds=kinds, buckets=4)

    _sliced_stream(p, start)
    return streaming.load_metrics(p.spark, seen)


def _messages(p: Projection) -> DataFrame:
    """Messages of all four kinds with their session; ids tell the kind."""
    e = F.col("event_id")
    rows = p.ev.withColumns({
        "meeting_key": F.col("session_key") + 1000, "date": F.col("ts"), "position": (e % 20 + 1).cast("int"),
        "gap_to_leader": F.when(e % 10 == 1, "+1 LAP").otherwise((e % 90).cast("string")), "interval": (e % 9).cast("string"),
    })
    parts = {
        "car": p.car_of(p.ev, "event_id"),
        "position": rows.filter("event_type IN ('click', 'view')"),
        "intervals": rows.filter("event_type IN ('purchase', 'signup')"),
        "location": p.location,
    }
    out = []
    for kind, rows in parts.items():
        payload = streaming.format_records(rows, kind, F.concat(F.lit(kind + " "), "event_id"))
        out.append(streaming.encode_envelope(payload, kind).select("value"))
    session = F.get_json_object("value", "$.payload.session_key").cast("int")
    return reduce(DataFrame.unionByName, out).withColumn("session_key", session)


def _live(p: Projection, messages: DataFrame, files: int, **options) -> str:
    """Messages as text files, in ``files`` micro-batches, through the live path."""
    kept, feed, base, mark = (scratch_dir(p.spark, name) for name in ("live-kept", "live-feed", "live", "live-checkpoint"))
    messages.write.option("maxRecordsPerFile", FILE_ROWS).parquet(kept)
    messages = p.spark.read.schema("value string, session_key int").parquet(kept).select("session_key", "value")
    parts = [part.select("value") for part in _slices(messages, files)]
    _in_turn(feed, "text", parts, lambda: streaming.write_live(streaming.read_stream(p.spark, feed), base, mark, buckets=4, **options))
    return base


def _per_kind(p: Projection, base: str) -> DataFrame:
    """The live tables of all kinds as one, with the number that is particular to each."""
    own = {"car": "speed", "position": "position", "intervals": "gap_to_leader", "location": "x"}
    tables = [
        streaming.read_live(p.spark, base, kind).select(
            F.lit(kind).alias("kind"), "id", "driver_number", "date", "session_key", "meeting_key", F.col(column).cast("double").alias("value")
        )
        for kind, column in own.items()
    ]
    return reduce(DataFrame.unionByName, tables)


def _bad_messages(p: Projection) -> DataFrame:
    """Messages that are cut off, lack their payload, a field, or have fields of the wrong type."""
    e = F.col("event_id")
    message = F.format_string(
        '{"payload": {"id": "%s", "position": %s, "driver_number": %s, "date": "2024-01-01 00:00:00", "session_key": 1, "meeting_key": %s}}',
        e.cast("string"), F.when(e % 5 == 1, '"first"').otherwise("1"), F.when(e % 5 == 2, "4.5").otherwise("7"),
        F.when(e % 5 == 3, "3000000000").otherwise("1001"),
    )
    text = F.when(e % 7 == 1, F.substring(message, 1, 20)).when(e % 7 == 2, F.lit('{"schema": {}}'))
    text = text.when(e % 7 == 3, F.lit('{"payload": {"id": "a", "driver_number": 1}}')).otherwise(message)
    return p.ev.filter("event_type = 'signup'").select("session_key", text.alias("value"))


@query
def live_pipeline(p: Projection) -> DataFrame:
    """Four kinds of messages through one stream of four micro-batches; some arrive twice, some are bad."""
    messages = _messages(p)
    again = messages.filter(F.col("value").contains("0 00:")).withColumn("session_key", F.lit(10))
    return _per_kind(p, _live(p, reduce(DataFrame.unionByName, [messages, again, _bad_messages(p)]), 4)).filter("driver_number <> 7 OR session_key <> 1 OR date > '2024-01-01 00:00:00'")


@query
def live_rejects(p: Projection) -> DataFrame:
    base = _live(p, _bad_messages(p), 2)
    return streaming.read_live_rejects(p.spark, base)


@query
def live_throttle(p: Projection) -> DataFrame:
    """One throttle per driver over all kinds, in the order of time, kind and id."""
    busy = p.ev.withColumns({"driver_number": F.col("driver_number") % 3, "ts": F.date_trunc("hour", F.col("ts"))})
    slow = Projection(p.spark, p.base)
    slow.__dict__["ev"] = busy  # the same messages from three drivers with coarse times
    return _per_kind(p, _live(p, _messages(slow), 3, throttle=True)).select("kind", "id", "driver_number", "date")


@query
def rejected_fields(p: Projection) -> DataFrame:
    """Why messages of one kind are left out, field by field."""
    return streaming.rejected_messages(_bad_messages(p), "position")


@query
def rejected_numbers(p: Projection) -> DataFrame:
    """Numbers of raw records that are none."""
    e = F.col("event_id")
    raw = p.ev.select(
        "event_id", "driver_number", F.when(e % 13 == 0, "fast").when(e % 17 == 0, F.lit(None)).otherwise((e % 300).cast("string")).alias("speed"),
        F.when(e % 19 == 0, "1e99").otherwise((e % 9).cast("string")).alias("rpm"),
    )
    return streaming.rejected_numbers(raw, "car")


def oracle_sql() -> dict[str, str]:
    return {name: oracle.sql(name) for name in QUERIES if name in oracle.CTE}
