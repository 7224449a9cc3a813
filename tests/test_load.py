import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe import sinks, sources
from lapframe.quality import not_null, range_check
from lapframe.schemas import AUDIT, RAW, merge_keys
from lapframe.streaming.dedup import touched_partitions


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def at(day):
    return F.lit(day).cast("timestamp")


OLD, NEW = "2024-01-01", "2024-01-02"


# ---- sources ----
def test_records_from_objects_and_lists(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, date timestamp")
    lines = ['{"k": 1, "date": "2024-01-01T00:00:00.5+00:00"}', '[{"k": 2}, 7, "x", {"k": 3}]', "[]"]
    (tmp_path / "a.json").write_text("\n".join(lines))
    assert rows(sources.read_records(spark, str(tmp_path / "a.json"), schema), "k") == [(1,), (2,), (3,)]
    (tmp_path / "b.json").write_text(json.dumps([{"k": 4}, {"k": 5}], indent=2))
    (tmp_path / "c.json").write_text(json.dumps({"k": 6}, indent=2))
    got = sources.read_records(spark, str(tmp_path / "[bc].json"), schema, whole_files=True)
    assert rows(got, "k") == [(4,), (5,), (6,)]


def test_schema_from_a_sample():
    sample = {"lap_date": "2024-01-01", "made_at": "x", "n": 1, "x": 1.5, "name": "a", "date_start": "t",
              "seg": [1, 2], "flag": True, "extra": {"a": 1}, "none": None}
    got = sources.infer_schema(sample, T.StructType().add("none", T.IntegerType()))
    assert {f.name: f.dataType.simpleString() for f in got} == {
        "lap_date": "timestamp", "made_at": "timestamp", "n": "double", "x": "double",
        "name": "string", "date_start": "string", "seg": "array<double>", "flag": "boolean",
        "none": "int",
    }


def test_column_case(frame):
    assert sources.normalize_columns(frame([(1, 2)], "A int, bC int")).columns == ["a", "bc"]
    assert sources.normalize_columns(frame([(1,)], "a int"), "upper").columns == ["A"]


def test_text_columns(frame):
    df = sources.coerce_to_string(frame([(1.5,), (None,)], "gap double"), ["gap", "interval"])
    assert rows(df) == [("1.5", ""), ("None", "")]


def test_required_fields(frame):
    df = frame([(1, 2), (1, None), (None, None)], "a int, b int")
    valid, rejected = sources.require_fields(df, ["a", "b"])
    assert (valid.count(), rejected.count()) == (1, 2)
    valid, rejected = sources.require_fields(df, ["a", "missing"])
    assert (valid.count(), rejected.count()) == (0, 3)


def test_only_new_and_calendar(frame):
    sessions = frame([(1, "2024-01-03 10:00:00", "2024-01-03 10:12:00"),
                      (2, "2024-01-05 10:00:00", "2024-01-05 10:10:00"),
                      (3, "2024-01-05 10:00:00", None)],
                     "session_key int, date_start timestamp, date_end timestamp")
    df = frame([(1, "2024-01-03 23:00:00"), (2, "2024-01-03 01:00:00"), (2, "2024-01-04 01:00:00")],
               "session_key int, date timestamp")
    assert rows(sources.only_new(df, sessions.filter("session_key = 1"), ["session_key"]), "session_key") == [(2,), (2,)]
    assert sources.filter_session_days(df, sessions, "date").count() == 2
    assert sources.filter_session_days(df, sessions, "date", by_session=True).count() == 1
    assert [str(r[0]) for r in sources.session_dates(sessions).collect()] == ["2024-01-03", "2024-01-05"]
    slices = sources.time_slices(sessions)
    ends = rows(slices, "session_key", "slice", F.date_format("slice_end", "HH:mm"))
    assert ends == [(1, 0, "10:05"), (1, 1, "10:10"), (1, 2, "10:12"), (2, 0, "10:05"), (2, 1, "10:10")]


def test_rows_on_a_slice_bound_come_twice(frame):
    sessions = frame([(1, "2024-01-03 10:00:00", "2024-01-03 10:12:00"),
                      (2, "2024-01-03 10:00:00", "2024-01-03 10:10:00")],
                     "session_key int, date_start timestamp, date_end timestamp")
    times = ["09:59:59", "10:00:00", "10:04:59", "10:05:00", "10:10:00", "10:12:00", "10:12:01"]
    df = frame([(k, f"2024-01-03 {t}") for k in (1, 2) for t in times], "session_key int, date timestamp")
    by_join = df.withColumnRenamed("session_key", "sk").join(
        sources.time_slices(sessions),
        (F.col("sk") == F.col("session_key")) & F.col("date").between(F.col("slice_start"), F.col("slice_end")),
    )
    expected = rows(by_join, "session_key", "date", "slice")
    assert rows(sources.slice_rows(df, sessions), "session_key", "date", "slice") == expected
    assert len(expected) == 7 + 5


def test_latest_meeting(frame):
    df = frame([(1, "2024-01-01 00:00:00"), (2, None), (3, "2024-02-01 00:00:00")],
               "meeting_key int, date_start timestamp")
    assert rows(sources.latest_meeting(df), "meeting_key") == [(3,)]
    assert [r[0] for r in sources.meetings_by_start(df).select("meeting_key").collect()] == [1, 3, 2]


# ---- sinks ----
def test_merge_keys_default():
    assert merge_keys("weather") == ["meeting_key", "session_key"]
    assert merge_keys("laps")[0] == "date_start"


def test_audit_columns(frame):
    stamped = sinks.with_audit(frame([(1,)], "a int"), "2024-03-01", now=at(NEW))
    assert str(stamped.first()["processed_date"]) == "2024-03-01"
    grown = sinks.add_missing_columns(frame([(1, None)], "a int, created_at timestamp"), AUDIT, now=at(NEW))
    row = grown.first()
    assert (row["created_at"], str(row["processed_date"])) == (None, "2024-01-02")
    assert grown.columns == ["a", "created_at", "processed_date", "updated_at"]


def _target(frame):
    df = frame([(1, 10, 5, "a"), (1, 11, 6, "b"), (None, 12, 7, "c")], "s int, d int, v int, note string")
    return df.withColumns({"created_at": at(OLD), "updated_at": at(OLD)})


def stamps(df):
    day = F.date_format
    return rows(df, "s", "d", "v", "note", day("created_at", "d"), day("updated_at", "d"))


def test_malformed_records_are_rejected(frame):
    lines = frame([('{"k": ',), ('[{"k":2}, {"k": ]',), ('{"k": 3}',), ('[{"k": 4}, 5]',), ('',), ('{"k": "x"}',)], "value string")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    assert rows(sources.records.parse_records(lines, schema)) == [(3,), (4,), (None,)]
    assert rows(sources.rejected_records(lines), "record") == [('[{"k":2}, {"k": ]',), ('{"k": ',)]


def test_upsert_updates_inserts_and_keeps(frame):
    source = frame([(1, 10, 50), (1, 13, 8), (None, 12, 70)], "s int, d int, v int")
    got = sinks.merge_upsert(_target(frame), source, ["s", "d"], now=at(NEW))
    assert stamps(got) == sorted([
        (1, 10, 50, "a", "1", "2"),    # updated; created_at and a column the batch lacks are kept
        (1, 11, 6, "b", "1", "1"),     # untouched
        (1, 13, 8, None, "2", "2"),    # inserted
        (None, 12, 7, "c", "1", "1"),  # a NULL key never matches ...
        (None, 12, 70, None, "2", "2"),  # ... so its row is inserted again
    ], key=repr)


def test_upsert_twice_is_upsert_once(frame):
    source = frame([(1, 10, 50), (1, 13, 8)], "s int, d int, v int")
    once = sinks.merge_upsert(_target(frame), source, ["s", "d"], now=at(NEW))
    twice = sinks.merge_upsert(once, source, ["s", "d"], now=at(NEW))
    assert stamps(once) == stamps(twice)


def test_upsert_duplicates(frame):
    source = frame([(1, 10, 50), (1, 10, 51), (9, 9, 1), (9, 9, 2)], "s int, d int, v int")
    with pytest.raises(Exception, match="several source rows"):
        sinks.merge_upsert(_target(frame), source, ["s", "d"], now=at(NEW)).collect()
    unmatched = sinks.merge_upsert(_target(frame), source.filter("s = 9"), ["s", "d"], now=at(NEW))
    assert unmatched.filter("s = 9").count() == 2
    last = sinks.merge_upsert(_target(frame), source, ["s", "d"], "last", ["v"], now=at(NEW))
    assert rows(last.filter("s = 1 and d = 10 or s = 9"), "v") == [(2,), (51,)]
    with pytest.raises(ValueError, match="missing merge keys in source"):
        sinks.merge_upsert(_target(frame), source, ["s", "note"])


def test_upsert_table_rewrites_touched_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    ddl = "session_key int, driver_number int, v int"
    base = frame([(1, 1, 1), (1, 2, 1), (2, 1, 1)], ddl).withColumns({"created_at": at(OLD), "updated_at": at(OLD)})
    sinks.upsert_table(spark, path, base, ["session_key", "driver_number"])
    before = {f for f in (tmp_path / "t" / "session_key=2").iterdir()}
    for _ in range(2):
        sinks.upsert_table(spark, path, frame([(1, 2, 7), (3, 1, 7)], ddl), ["session_key", "driver_number"], now=at(NEW))
    got = spark.read.parquet(path)
    assert rows(got, "session_key", "driver_number", "v") == [(1, 1, 1), (1, 2, 7), (2, 1, 1), (3, 1, 7)]
    assert {f for f in (tmp_path / "t" / "session_key=2").iterdir()} == before
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_upsert_reads_touched_partitions_only(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    ddl = "session_key int, driver_number int, v int"
    keys = ["session_key", "driver_number"]
    sinks.upsert_table(spark, path, frame([(1, 1, 1), (2, 1, 1), (2, 1, 2)], ddl), keys, on_duplicate="last", last_by=["v"], now=at(OLD))
    got = spark.read.parquet(path)
    # a first load is merged like any other
    assert rows(got, "session_key", "v") == [(1, 1), (2, 2)]
    assert got.filter(F.col("created_at") == at(OLD)).count() == 2
    touched = got.filter(touched_partitions(frame([(1, 2, 7), (None, 1, 1)], ddl), ["session_key"]))
    plan = touched._jdf.queryExecution().toString()
    assert "PartitionFilters: [((session_key" in plan or "PartitionFilters: [(session_key" in plan
    assert {f.rsplit("/", 2)[1] for f in touched.inputFiles()} <= {"session_key=1", "session_key=2"}
    assert rows(touched, "session_key") == [(1,)]


def test_columns_of_the_batch_alone(spark, frame, tmp_path):
    source = frame([(1, 10, 50, True), (2, 1, 1, False)], "s int, d int, v int, seen boolean")
    with pytest.raises(ValueError, match=r"columns missing in target: \['seen'\]"):
        sinks.merge_upsert(_target(frame), source, ["s", "d"])
    got = sinks.merge_upsert(_target(frame), source, ["s", "d"], now=at(NEW), new_columns="add")
    assert rows(got, "s", "d", "v", "seen") == [(1, 10, 50, True), (1, 11, 6, None), (2, 1, 1, False), (None, 12, 7, None)]
    path, keys = str(tmp_path / "t"), ["session_key", "d"]
    sinks.upsert_table(spark, path, frame([(1, 1, 1), (2, 1, 1)], "session_key int, d int, v int"), keys)
    sinks.upsert_table(spark, path, frame([(1, 1, 2, "x")], "session_key int, d int, v int, w string"), keys, new_columns="add")
    grown = spark.read.option("mergeSchema", "true").parquet(path)
    assert rows(grown, "session_key", "v", "w") == [(1, 2, "x"), (2, 1, None)]


def test_rows_without_a_whole_key_come_once_per_load(spark, frame, tmp_path):
    path, keys, ddl = str(tmp_path / "t"), ["session_key", "d"], "session_key int, d int, v int"
    first = frame([(1, None, 1), (1, 7, 1), (2, None, 1), (2, None, 1)], ddl)
    second = frame([(1, None, 2), (1, 7, 2), (2, None, 2), (3, 8, 2), (3, 8, 3)], ddl)
    sinks.upsert_table(spark, path, first, keys, now=at(OLD), load_id="a")
    # stopped half way, then run whole, then run again
    for part in (second.filter("session_key = 1"), second, second):
        sinks.upsert_table(spark, path, part, keys, now=at(NEW), load_id="b")
    want = [(1, 7, 2, "a"), (1, None, 1, "a"), (1, None, 2, "b"), (2, None, 1, "a"), (2, None, 1, "a"), (2, None, 2, "b"), (3, 8, 2, "b"), (3, 8, 3, "b")]
    got = spark.read.parquet(path)
    assert rows(got, "session_key", "d", "v", "load_id") == sorted(want, key=repr)
    assert rows(got.filter("d = 7"), F.date_format("created_at", "d"), F.date_format("updated_at", "d")) == [("1", "2")]


def _lines(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def test_one_table_fails_and_the_others_are_published(spark, frame, tmp_path):
    base, sessions = str(tmp_path / "raw"), frame([(9, k) for k in (1, 2, 3)], "meeting_key int, session_key int")
    pit = {"DATE": "2024-01-01T00:00:00", "DRIVER_NUMBER": 4, "MEETING_KEY": 9, "LAP_NUMBER": 1, "PIT_DURATION": 2.5}
    landed = {
        "pit": _lines(spark, "not json", [{**pit, "SESSION_KEY": 1}, 5, {**pit, "SESSION_KEY": 2}], {**pit, "SESSION_KEY": 8}),
        "weather": _lines(spark, {"session_key": 1, "date": "2024-01-01T00:00:00"}),
        "car_data": _lines(spark, {"meeting_key": 9, "session_key": 1, "driver_number": None, "date": "2024-01-01T00:00:00"}, {"session_key": 1}),
        "position": _lines(spark, {"meeting_key": 9, "session_key": 1, "driver_number": 4, "date": "2024-01-01T00:00:00", "position": 99}),
        "starting_grid": _lines(spark, {"meeting_key": 9, "session_key": 3, "slot": "first", "since_date": "2024-01-01"}),
    }
    checks = {"position": [range_check("position", 1, 20)]}
    report = sinks.load_batch(spark, base, landed, sessions, "2024-01-02", "one", checks, now=at(NEW))
    want = {
        ("pit", 1, "success", None, 1), ("pit", 2, "success", None, 1), ("pit", 3, "skipped", "no_data", 0),
        *{("weather", k, "error", "ValueError: merge keys missing in weather: ['meeting_key']", 0) for k in (1, 2, 3)},
        *{("car_data", k, "skipped", "no_data", 0) for k in (1, 2, 3)},
        *{("position", k, "error", "CheckFailed: range_check(position): 1", 0) for k in (1, 2, 3)},
        ("starting_grid", 3, "success", None, 1), *{("starting_grid", k, "skipped", "no_data", 0) for k in (1, 2)},
    }
    assert set(rows(report, "endpoint", "session_key", "status", "reason", "records")) == want
    # session 8 was not asked for; names are lower-case, rows are stamped
    got = spark.read.parquet(f"{base}/pit")
    assert rows(got, "session_key", "pit_duration", F.date_format("processed_date", "d"), F.date_format("created_at", "d")) == [(1, 2.5, "2", "2"), (2, 2.5, "2", "2")]
    assert rows(sinks.read_rejects(spark, base, "one"), "endpoint", "reason") == [
        ("car_data", "required field missing"), ("car_data", "required field missing"), ("pit", "malformed JSON")]
    assert not (tmp_path / "raw" / "position").exists() and not list((tmp_path / "raw" / "_staging").iterdir())
    # the same load again changes nothing; another load skips what is there
    again = sinks.load_batch(spark, base, {"pit": landed["pit"]}, sessions, "2024-01-02", "one", now=at(NEW))
    assert set(rows(again.filter("endpoint = 'pit'"), "session_key", "status")) == {(1, "success"), (2, "success"), (3, "skipped")}
    later = sinks.load_batch(spark, base, {"pit": landed["pit"]}, sessions, "2024-01-03", "two", now=at(NEW))
    assert set(rows(later, "session_key", "reason")) == {(1, "data_exists"), (2, "data_exists"), (3, "no_data")}
    assert spark.read.parquet(f"{base}/pit").count() == 2
    assert sinks.read_ledger(spark, base).count() == 15 + 3


def test_publish_only_checked_data(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    good = frame([(1, 5), (2, 6)], "session_key int, v int")
    sinks.stage_and_publish(spark, good, path, [not_null("v")])
    bad = frame([(1, None), (1, 99)], "session_key int, v int")
    with pytest.raises(sinks.CheckFailed, match=r"not_null\(v\): 1, range_check\(v\): 1"):
        sinks.stage_and_publish(spark, bad, path, [not_null("v"), range_check("v", 0, 10)])
    assert [f.name for f in tmp_path.iterdir()] == ["t"]
    sinks.stage_and_publish(spark, frame([(2, 8)], "session_key int, v int"), path)
    assert rows(spark.read.parquet(path), "session_key", "v") == [(1, 5), (2, 8)]
    sinks.stage_and_publish(spark, good, path, mode="overwrite")
    assert rows(spark.read.parquet(path), "session_key", "v") == [(1, 5), (2, 6)]


def test_load_report(frame):
    sessions = frame([(9, k) for k in (1, 2, 3, 4)], "meeting_key int, session_key int")
    existing = frame([(9, 1)], "meeting_key int, session_key int")
    batch = frame([(1,), (2,), (2,), (4,)], "session_key int")
    errors = frame([(4, "timeout")], "session_key int, reason string")
    got = sinks.load_report(sessions, "laps", existing, batch, errors)
    assert rows(got, "session_key", "status", "reason", "records") == [
        (1, "skipped", "data_exists", 0), (2, "success", None, 2), (3, "skipped", "no_data", 0),
        (4, "error", "timeout", 0),
    ]


def test_declared_schemas_use_wide_numbers():
    kinds = {f.dataType.simpleString() for s in RAW.values() for f in s.fields}
    assert "float" not in kinds


def _rows_read(df):
    """Rows that the scan of an executed plan gave out."""
    df.collect()
    scans, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName().startswith("Scan parquet"):
            scans.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(scans)


def test_a_look_up_skips_row_groups(spark, tmp_path):
    # four files, each with every seventh number, in no order and without a dictionary
    df = spark.range(40_000, numPartitions=4).select((F.pmod(F.xxhash64("id"), F.lit(100_000)) * 7).cast("int").alias("driver_number"), "id")
    wanted = df.first()["driver_number"]
    spark.conf.set("parquet.enable.dictionary", "false")
    try:
        for name, by in (("plain", []), ("filtered", ["driver_number"])):
            sinks.write_table(df, str(tmp_path / name), [], ["id"], look_up_by=by)
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    for name, read in (("plain", 40_000), ("filtered", 0)):
        table = spark.read.parquet(str(tmp_path / name))
        assert table.filter(F.col("driver_number") == wanted).count() == df.filter(F.col("driver_number") == wanted).count() > 0
        # a number that no file has, though it lies between the least and the greatest of each
        assert _rows_read(table.filter(f"driver_number = {7 * 50_000 + 3}")) == read
