import json
import os

import pytest
from pyspark.sql import functions as F

from lapframe import streaming
from lapframe.schemas import STREAM, STREAM_TOPICS
from lapframe.streaming.counts import latest_counts


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture
def feed(spark, tmp_path):
    """A stream over JSON files, one micro-batch per list of rows."""

    def make(batches, ddl):
        folder = tmp_path / f"feed{len(list(tmp_path.glob('feed*')))}"
        folder.mkdir()
        for i, batch in enumerate(batches):
            file = folder / f"{i}.json"
            file.write_text("\n".join(json.dumps(r) for r in batch))
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
        return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).json(str(folder))

    return make


def _message(i, second, driver=1):
    return {"id": f"m{i:02d}", "driver_number": driver, "date": f"2024-01-01T00:00:{second:04.1f}Z"}


FEED = "id string, driver_number int, date timestamp"
# seconds 1, 1, 2 | 2, 1, 1 | 3 for driver 1; driver 2 interleaved with the same second
BATCHES = [
    [_message(1, 1), _message(2, 1.5), _message(3, 2), _message(4, 1, 2), _message(5, 1.9, 2)],
    [_message(6, 2.5), _message(9, 1, 2)],
    [_message(7, 1)],
    [_message(8, 1.2), _message(10, 3)],
]
# second 2 of m06 is the last passed one; m07 goes back to second 1 and passes again
PASSED = [("m01",), ("m03",), ("m04",), ("m07",), ("m10",)]


def test_throttle_state_over_micro_batches(spark, feed, tmp_path):
    stream = streaming.throttle_per_second(feed(BATCHES, FEED))
    streaming.start_sink(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "o"))
    assert rows(out, "id") == PASSED
    assert out.filter("created_at is null").count() == 0


def test_throttle_sink_over_micro_batches(spark, feed, tmp_path, monkeypatch):
    spark.conf.set("spark.lapframe.hotKeyRows", "2")
    try:
        streaming.write_throttled(
            feed(BATCHES, FEED), str(tmp_path / "o"), str(tmp_path / "s"), str(tmp_path / "c")
        ).awaitTermination()
    finally:
        spark.conf.unset("spark.lapframe.hotKeyRows")
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id") == PASSED


@pytest.mark.parametrize("threshold", [1, 1000])
def test_throttle_batch_is_change_detection(frame, threshold):
    df = frame([(i, 1, f"2024-01-01 00:00:0{s}") for i, s in enumerate([1, 1, 2, 1])],
               "id int, driver_number int, date timestamp")
    got = streaming.throttle_batch(df, order=["id"], part=F.floor(F.col("id") / 2), threshold=threshold)
    assert rows(got, "id") == [(0,), (2,), (3,)]


def test_dedup_with_a_watermark(spark, feed, tmp_path):
    again = [[_message(1, 1), _message(2, 2)], [_message(1, 1), _message(3, 3)]]
    stream = streaming.dedup_stream(feed(again, FEED), "id", "date", "1 minute")
    streaming.start_sink(stream, str(tmp_path / "o"), str(tmp_path / "c"), mode="refresh").awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id") == [("m01",), ("m02",), ("m03",)]


def test_batches_insert_a_key_once(spark, feed, tmp_path):
    again = [[_message(1, 1), _message(1, 1)], [_message(1, 1), _message(3, 3)], [_message(3, 3, 2)]]
    out = str(tmp_path / "o")
    streaming.write_batches(feed(again, FEED), out, str(tmp_path / "c"), partition_by=["driver_number"]).awaitTermination()
    got = spark.read.parquet(out)
    # a key is unique within its partition, so the rows do not depend on how they are batched
    assert rows(got, "driver_number", "id") == [(1, "m01"), (1, "m03"), (2, "m03")]
    at_once = str(tmp_path / "at-once")
    streaming.write_batches(feed([sum(again, [])], FEED), at_once, str(tmp_path / "c2"), partition_by=["driver_number"]).awaitTermination()
    assert rows(spark.read.parquet(at_once), "driver_number", "id") == rows(got, "driver_number", "id")
    # a batch that runs again finds its rows in place
    again = spark.createDataFrame([("m01", 1)], "id string, driver_number int")
    streaming.insert_if_absent(again, out, ["id"], ["driver_number"])
    assert spark.read.parquet(out).count() == 3


def test_running_counts(spark, feed, tmp_path):
    counts = streaming.running_counts(feed(BATCHES, FEED), ["driver_number"])
    out = str(tmp_path / "o")
    streaming.write_running_counts(counts, out, str(tmp_path / "c")).awaitTermination()
    assert rows(latest_counts(counts, out, ["driver_number"])) == [(1, 7), (2, 3)]


def test_load_metrics(spark, feed, tmp_path):
    again = [[_message(1, 1), _message(1, 1)], [_message(1, 1), _message(3, 3)]]
    stream = feed(again, FEED).select(F.lit("car").alias("kind"), "id")
    streaming.metered_sink(stream, str(tmp_path / "o"), str(tmp_path / "m"), str(tmp_path / "c")).awaitTermination()
    assert rows(streaming.load_metrics(spark, str(tmp_path / "m"))) == [("car", "success", None, 4, 2)]
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id") == [("m01",), ("m03",)]


def test_format_gaps_and_defaults(frame):
    raw = frame([("+1 LAP", "1.5"), (None, "+2 LAPS"), ("3", None)], "gap_to_leader string, interval string")
    got = streaming.format_records(raw, "intervals")
    assert rows(got, "gap_to_leader", "time_interval", "driver_number") == [
        (3.0, None, 0), (None, 1.5, 0), (None, None, 0)]
    assert got.columns == STREAM["intervals"].fieldNames()
    assert got.select("id").distinct().count() == 3
    car = streaming.format_records(frame([(5, "2024-01-01 10:00:00.9")], "speed int, date timestamp"), "car")
    assert rows(car, "speed", "rpm", "date") == [(5, 0, "2024-01-01 10:00:00")]


def test_bad_numbers_and_messages_are_rejected(frame):
    raw = frame([("44.0", "1"), ("44", "abc"), ("44", None), ("7", "300")], "driver_number string, speed string")
    assert rows(streaming.format_records(raw, "car"), "driver_number", "speed") == [(44, 0), (7, 300)]
    assert raw.filter(streaming.unparseable(raw, "car")).count() == 2
    messages = frame([("not json",), ('{"schema": {}}',), ('{"payload": {"driver_number": 4}}',)], "value string")
    assert rows(streaming.decode_envelope(messages, "car"), "driver_number") == [(4,)]
    assert rows(streaming.rejected_messages(messages), "reason") == [("malformed JSON",), ("no payload",)]


def test_throttle_takes_records_without_an_id(frame):
    rows_in = [(None, 1, 5), ("b", 1, 5), ("a", 1, 6)]
    pdf = frame(rows_in, "id string, driver_number int, s int").toPandas()
    from lapframe.streaming.throttle import _ranks

    assert _ranks(pdf["id"]).tolist() == [3.0, 2.0, 1.0]


def test_envelope_layout_and_round_trip(frame):
    for kind, schema in STREAM.items():
        raw = frame([(44, 9, None)], "driver_number int, session_key int, date timestamp")
        payload = streaming.format_records(raw, kind, F.lit("a"))
        message = streaming.encode_envelope(payload, kind).first()
        value, key = json.loads(message["value"]), json.loads(message["key"])
        assert message["topic"] == STREAM_TOPICS[kind]
        assert key["payload"] == {"driver_number": 44}
        assert list(value["payload"]) == schema.fieldNames()
        fields = value["schema"]["fields"]
        assert [f["field"] for f in fields] == schema.fieldNames()
        assert {f["field"] for f in fields if not f["optional"]} == {
            "id", "driver_number", "session_key", "meeting_key"}
        back = streaming.decode_envelope(streaming.encode_envelope(payload, kind), kind)
        assert rows(back) == rows(payload)


def test_routing_takes_the_first_complete_kind(frame):
    base = '"id": "a", "driver_number": 1, "date": null, "session_key": 1, "meeting_key": 1'
    df = frame([("{%s}" % f'"payload": {{{base}{more}}}',) for more in (
        ', "position": 3', ', "gap_to_leader": null, "time_interval": 2.0', ', "x": 1, "y": 2', "")],
        "value string")
    got = streaming.route_by_fields(streaming.payload_map(df)).select("kind").collect()
    assert [r[0] for r in got] == ["position", "intervals", None, None]


def test_replay_bounds_are_strict(frame):
    times = ["00.200", "00.201", "05:00.199", "05:00.200"]
    df = frame([(1, 55, f"2024-01-01 00:{t if ':' in t else '00:' + t}") for t in times],
               "session_key int, driver_number int, date timestamp")
    got = streaming.replay_slice(df, 1, start="2024-01-01T00:00:00")
    assert rows(got, F.date_format("date", "mm:ss.SSS")) == [("00:00.201",), ("05:00.199",)]


def test_text_stream_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"payload": {"id": "z", "position": 4}}\n')
    stream = streaming.decode_envelope(streaming.read_stream(spark, str(tmp_path / "in")), "position")
    streaming.start_sink(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o")), "id", "position") == [("z", 4)]


def test_a_micro_batch_of_the_queries_has_as_many_files_as_it_takes(spark, tmp_path, monkeypatch):
    from lapframe.workloads import catalog

    monkeypatch.setattr(catalog, "FILE_ROWS", 10)
    feed, out, mark = (str(tmp_path / name) for name in ("feed", "out", "mark"))
    rows = [spark.range(30 * i, 30 * i + 30, numPartitions=1) for i in range(2)]

    def start():
        stream = spark.readStream.schema("id bigint").parquet(feed)
        return stream.writeStream.option("checkpointLocation", mark).trigger(availableNow=True).foreachBatch(
            lambda batch, n: batch.write.parquet(f"{out}/batch_id={n}")
        ).start()

    catalog._in_turn(feed, "parquet", rows, start)
    assert len(list((tmp_path / "feed").glob("*.parquet"))) == 6
    got = spark.read.parquet(out).groupBy("batch_id").count().collect()
    assert sorted(map(tuple, got)) == [(0, 30), (1, 30)]
