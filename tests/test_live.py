"""The live path as one stream, its keys on disk, and rejects with reasons."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe import streaming
from lapframe.schemas import STREAM
from lapframe.streaming.keytable import KeyTable
from lapframe.streaming.live import METRICS, parse_any
from lapframe.streaming.throttle import _merged, pass_seconds, throttle_state


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def message(kind, i, second=0, driver=1, **more):
    own = {"location": {"x": 1.5, "y": 2, "z": 0}, "position": {"position": 3}, "intervals": {"gap_to_leader": None, "time_interval": 0.5},
           "car": dict.fromkeys(("brake", "drs", "n_gear", "rpm", "speed", "throttle"), 7)}[kind]
    base = {"id": f"{kind}{i}", "driver_number": driver, "date": f"2024-01-01 00:00:{second:02d}", "session_key": 1, "meeting_key": 2}
    return json.dumps({"schema": {}, "payload": {**base, **own, **more}})


@pytest.fixture
def texts(spark, tmp_path):
    """A stream of messages, one micro-batch per list of lines."""

    def make(batches):
        folder = tmp_path / f"feed{len(list(tmp_path.glob('feed*')))}"
        folder.mkdir()
        for i, batch in enumerate(batches):
            (folder / f"{i:03d}.txt").write_text("\n".join(batch))
            os.utime(folder / f"{i:03d}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
        return streaming.read_stream(spark, str(folder), maxFilesPerTrigger="1")

    return make


KINDS = ("location", "position", "car", "intervals")


def test_tables_do_not_depend_on_the_batches(spark, texts, tmp_path):
    lines = [message(KINDS[i % 4], i // 4) for i in range(40)]
    lines += lines[:7] + ["{", '{"schema": 1}', '{"payload": {"id": "x"}}', message("car", 99, speed="fast"), message("position", 98, position=1.5)]
    seen = {}
    for name, batches in (("one", [lines]), ("many", [lines[i : i + 5] for i in range(0, len(lines), 5)])):
        base = str(tmp_path / name)
        streaming.write_live(texts(batches), base, str(tmp_path / f"c{name}"), buckets=2, merge_every=4).awaitTermination()
        seen[name] = {kind: rows(streaming.read_live(spark, base, kind)) for kind in KINDS}
        reasons = rows(streaming.read_live_rejects(spark, base), "reason")
        assert reasons == [("malformed JSON",), ("no kind",), ("no payload",), ("position: int wanted, found DECIMAL(2,1)",), ("speed: int wanted, found STRING",)]
        counts = rows(streaming.load_metrics(spark, f"{base}/{METRICS}"), "kind", "records_processed", "records_inserted")
        assert counts == [("car", 12, 10), ("intervals", 11, 10), ("location", 12, 10), ("position", 12, 10)]
    assert seen["one"] == seen["many"]
    assert len(seen["one"]["location"]) == 10
    (first,) = [r for r in streaming.read_live(spark, str(tmp_path / "one"), "intervals").collect() if r.id == "intervals0"]
    assert (first.gap_to_leader, first.time_interval) == (None, 0.5)


def test_a_batch_that_runs_again_changes_nothing(spark, frame, tmp_path):
    path, batch = str(tmp_path / "t"), frame([("a", 1), ("b", 2), ("a", 3), (None, 4), (None, 5)], "id string, v int")
    table = streaming.dedup.key_table(path, batch.schema, ["id"], buckets=3)
    counts = {"n": F.count(F.lit(1))}
    assert streaming.dedup.insert_batch(batch, 0, path, table, counts) == ({"n": 5}, {"n": 3})
    later = frame([("b", 9), ("c", 9)], "id string, v int")
    for _ in range(2):
        assert streaming.dedup.insert_batch(later, 1, path, table, counts) == ({"n": 2}, {"n": 1})
    assert streaming.dedup.insert_batch(later.limit(0), 2, path, table, counts) == ({"n": 0}, {"n": 0})
    assert rows(streaming.read_batches(batch, path), "id") == [("a",), ("b",), ("c",), (None,)]


def test_state_stays_flat_and_loses_nothing(spark, tmp_path):
    table = KeyTable(str(tmp_path / "k"), ("id",), T.StructType([T.StructField("id", T.LongType())]), buckets=2, merge_every=4)
    folders = []
    for n in range(14):
        batch = spark.range(n * 3, n * 3 + 5, 1, 1)  # two ids of the batch before come again
        fresh = table.absent(batch, n, table.touched(batch))
        assert fresh.count() == (5 if n == 0 else 3)
        table.write(fresh, n)
        folders.append(sum(len(list((tmp_path / "k" / kind).iterdir())) for kind in ("merged", "batches") if (tmp_path / "k" / kind).exists()))
    assert max(folders) <= 5
    assert rows(table.before(spark, 14)) == sorted([(i,) for i in range(44)], key=repr)
    # a batch that runs again sees what it saw before, though its own folder is there
    assert table.before(spark, 13).filter("id > 40").count() == 0


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = KeyTable(str(tmp_path / "k"), ("id",), T.StructType([T.StructField("id", T.LongType())]), buckets=8)
    table.write(spark.range(1000), 0)
    one = spark.range(5, 6)
    (bucket,) = table.touched(one)
    known = table.before(spark, 1, [bucket])
    files = known.inputFiles()
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"= {bucket})" in plan
    assert known.count() < 300 and files
    # the files carry Bloom filters for look-ups of single keys
    import pyarrow.parquet as pq

    found = [str(f) for f in (tmp_path / "k").rglob("*.parquet")]
    with open(found[0], "rb") as f:
        data = f.read()
    column = pq.ParquetFile(found[0]).metadata.row_group(0).column(0)
    assert len(data) > column.total_compressed_size + 1000  # the filter lies between the columns and the footer


def test_known_keys_are_not_broadcast(spark, tmp_path):
    table = KeyTable(str(tmp_path / "k"), ("id",), T.StructType([T.StructField("id", T.LongType())]), buckets=2)
    table.write(spark.range(1000), 0)
    batch = spark.range(990, 1010)
    fresh = table.absent(batch, 1, table.touched(batch))
    assert rows(fresh) == [(i,) for i in range(1000, 1010)]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_files_of_kept_messages_are_small(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from lapframe.workloads import catalog

    monkeypatch.setattr(catalog, "FILE_ROWS", 10)
    monkeypatch.setattr(catalog, "scratch_dir", lambda _, name: str(tmp_path / name))
    lines = [(message("car", i), 1) for i in range(25)]
    messages = spark.createDataFrame(lines, "value string, session_key int").coalesce(1)
    base = catalog._live(SimpleNamespace(spark=spark), messages, 1)
    assert rows(streaming.read_live(spark, base, "car"), "id") == sorted((f"car{i}",) for i in range(25))
    assert len(list((tmp_path / "live-kept").glob("*.parquet"))) == 3


def test_newest_value_of_a_key(spark, frame, tmp_path):
    ddl = "k int, second long"
    table = KeyTable(str(tmp_path / "k"), ("k",), T.StructType.fromDDL(ddl), buckets=2, merge_every=2)
    for n, batch in enumerate([[(1, 5), (2, 5), (None, 1)], [(1, 4)], [(2, 6)], [(None, 2)]]):
        table.before(spark, n)
        table.write(frame(batch, ddl), n)
    assert rows(table.before(spark, 4)) == [(1, 4), (2, 6), (None, 2)]


def test_throttle_over_kinds(spark, texts, tmp_path):
    batches = [
        [message("car", 1, 1), message("position", 1, 1), message("location", 1, 2), message("car", 2, 1, driver=2)],
        [message("intervals", 1, 2), message("car", 3, 3), message("car", 4, 1, driver=2)],
        [message("position", 2, 2)],
    ]
    base = str(tmp_path / "o")
    streaming.write_live(texts(batches), base, str(tmp_path / "c"), throttle=True, buckets=2).awaitTermination()
    got = sorted(r.id for kind in KINDS for r in streaming.read_live(spark, base, kind).collect())
    # second 1 passes once for driver 1 (the car message comes first), second 2 once, and again after second 3
    assert got == ["car1", "car2", "car3", "location1", "position2"]
    counts = rows(streaming.load_metrics(spark, f"{base}/{METRICS}"), "kind", "records_processed", "records_inserted")
    assert counts == [("car", 4, 3), ("intervals", 1, 0), ("location", 1, 1), ("position", 2, 1)]


def test_executors_hold_nothing_of_a_micro_batch(spark, texts, tmp_path, monkeypatch):
    from lapframe.streaming import live

    before, insert, held, plans = spark._jsc.getPersistentRDDs().size(), live.insert_batch, [], []

    def watched(batch, *rest):
        held.append(spark._jsc.getPersistentRDDs().size())
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        return insert(batch, *rest)

    monkeypatch.setattr(live, "insert_batch", watched)
    lines = [message(KINDS[i % 4], i, i % 7) for i in range(20)] + ["{"]
    for throttle, count in ((False, 20), (True, 7)):
        base = str(tmp_path / f"o{throttle}")
        streaming.write_live(texts([lines]), base, str(tmp_path / f"c{throttle}"), throttle=throttle, buckets=2).awaitTermination()
        assert sum(streaming.read_live(spark, base, kind).count() for kind in KINDS) == count
        assert rows(streaming.read_live_rejects(spark, base)) == [("{", "malformed JSON")]
        assert not os.path.exists(f"{base}/_work/0")
    assert len(plans) == 2 and max(held) <= before
    for plan in plans:  # the typed fields as stored, the seconds of a throttle found once
        assert "InMemoryTableScan" not in plan and "min_by" not in plan and "variant" not in plan, plan


def test_a_batch_of_bad_messages_passes_the_throttle(spark, texts, tmp_path):
    base = str(tmp_path / "o")
    stream = texts([["{"], [message("car", 1, 1)], ['{"schema": 1}']])
    streaming.write_live(stream, base, str(tmp_path / "c"), throttle=True, buckets=2).awaitTermination()
    assert rows(streaming.read_live(spark, base, "car"), "id") == [("car1",)]
    assert rows(streaming.read_live_rejects(spark, base), "reason") == [("malformed JSON",), ("no payload",)]
    assert rows(streaming.load_metrics(spark, f"{base}/{METRICS}"), "kind", "records_processed", "records_inserted") == [("car", 1, 1)]


def test_a_busy_key_is_reduced_before_it_is_shuffled(spark, tmp_path):
    batch = spark.range(200_000, numPartitions=4).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") % 10).alias("t"), "id")
    passed = pass_seconds(batch, throttle_state(str(tmp_path / "s"), "k", T.IntegerType(), buckets=2), 0, "k", "t", "id")
    assert rows(passed, "id") == [(i,) for i in range(10)]
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min_by" in plan


def test_throttle_state_holds_one_row_a_second():
    kept = None
    for start in range(0, 1000, 100):  # Arrow batches of a key, in any order
        part = pd.DataFrame({"id": [f"{(start * 7 + i) % 1000:04d}" for i in range(100)]})
        part["t"] = part["id"].astype(int) // 100
        part["__second"] = part["t"]
        kept = _merged(kept, part, "t", "id")
        assert len(kept) <= 10
    assert kept["id"].tolist() == [f"{s * 100:04d}" for s in range(10)]


def test_each_message_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(message("car", 1),)], "value string").write.parquet(path)
    df = spark.read.parquet(path)
    for got in (streaming.decode_envelope(df, "car"), parse_any(df).filter(F.size("reasons") == 0)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1, plan
        assert got.count() == 1


def test_wrong_fields_are_rejected_with_reasons(frame):
    lines = [
        message("position", 1), message("position", 2, position="3"), message("position", 3, position=None), message("position", 4, driver_number=True),
        message("position", 5, session_key=2**31, meeting_key=1.25), message("position", 6, id=17), '{"payload": []}', "", None, "{}",
    ]
    df = frame([(x,) for x in lines], "value string")
    assert rows(streaming.decode_envelope(df, "position"), "id") == [("17",), ("position1",), ("position3",)]
    want = [
        "driver_number: int wanted, found BOOLEAN", "malformed JSON", "malformed JSON", "meeting_key: int wanted, found DECIMAL(3,2)",
        "no payload", "no payload", "position: int wanted, found STRING", "session_key: int wanted, found BIGINT",
    ]
    assert [r[0] for r in rows(streaming.rejected_messages(df, "position"), "reason")] == want


def test_bad_numbers_of_raw_records(frame):
    raw = frame([("44", "1"), ("x", "abc"), (None, "7")], "driver_number string, speed string")
    assert rows(streaming.rejected_numbers(raw, "car")) == [("driver_number", "x"), ("speed", "abc")]
    assert streaming.rejected_numbers(raw.select(F.lit(1).alias("other")), "car").count() == 0
    assert set(STREAM) == set(KINDS)
