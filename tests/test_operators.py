import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapframe.functions import (
    add_whole_seconds,
    bracket_label,
    millis_between,
    numeric_gap,
    points_for,
    seconds_between,
)
from lapframe.operators import (
    dense_rank_by,
    fill_forward,
    first_per_key,
    interval_join,
    interval_matches,
    latest_per_key,
    nearest_event_in_interval,
    numbered,
    previous_value,
    range_aggregate,
    sustained_burst,
)
from lapframe.operators import intervals
from lapframe.operators.keys import split_hot_keys

DAY = 1_704_067_200  # 2024-01-01 UTC


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_second_boundaries_count_not_elapsed_seconds(spark):
    a = F.lit("2024-01-01 00:00:00.900").cast("timestamp")
    b = F.lit("2024-01-01 00:00:01.100").cast("timestamp")
    assert one(spark, seconds_between(a, b)) == 1
    assert one(spark, millis_between(a, b)) == 200


def test_fractional_duration_is_rounded(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert one(spark, F.unix_seconds(add_whole_seconds(start, F.lit(91.7)))) == DAY + 92
    assert one(spark, F.unix_seconds(add_whole_seconds(start, F.lit(91.5)))) == DAY + 92
    assert one(spark, add_whole_seconds(start, F.lit(None).cast("double"))) is None


def test_gap_texts(frame):
    df = frame([("+1 LAP",), ("+2 LAPS",), ("None",), ("",), ("12.5",), (None,)], "g string")
    assert [r[0] for r in df.select(numeric_gap("g")).collect()] == [None] * 4 + [12.5, None]


def test_points_and_labels(frame):
    df = frame([(1, "A"), (10, "B"), (11, None), (None, "C")], "p int, n string")
    assert [r[0] for r in df.select(points_for("p")).collect()] == [25, 1, 0, 0]
    assert df.select(bracket_label("n", outer="n")).collect()[2][0] is None


def test_null_time_is_latest_and_last(frame):
    df = frame(
        [("a", 3, None), ("a", 1, "2024-01-01 00:00:00"), ("b", 2, "2024-01-01 00:00:00"),
         ("b", 5, "2024-01-02 00:00:00")],
        "k string, p int, t timestamp",
    )
    assert rows(latest_per_key(df, ["k"], "t"), "k", "p") == [("a", 3), ("b", 5)]
    assert rows(first_per_key(df, ["k"], "t"), "k", "p") == [("a", 1), ("b", 2)]


def test_ties_follow_tie_breakers(frame):
    df = frame([("a", 7, 1), ("a", 4, 1), ("a", 9, 0)], "k string, p int, t int")
    assert rows(latest_per_key(df, ["k"], "t", ["p"]), "p") == [(4,)]


def test_top_one_is_limited_before_the_exchange(frame):
    df = latest_per_key(frame([("a", 1)], "k string, t int"), ["k"], "t")
    plan = df._jdf.queryExecution().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


@pytest.fixture
def ordered(spark):
    """Four keys, one of them with half of the rows, and gaps in the values."""
    rnd = random.Random(1)
    data = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
        t = rnd.randrange(200) if rnd.random() < 0.9 else None
        data.append((key, t, i, rnd.randrange(9) if rnd.random() < 0.3 else None))
    return spark.createDataFrame(data, "k string, t int, id int, v int").cache()


def part():
    return F.floor(F.col("t") / 7)


@pytest.mark.parametrize("threshold", [1, 200, 10_000])
def test_split_window_functions_match_plain_windows(ordered, threshold):
    order = ["t", "id"]
    window = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), "id")
    expected = rows(
        ordered.select(
            "id",
            F.row_number().over(window),
            F.last("v", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)),
            F.lag("v").over(window),
        )
    )
    df = numbered(ordered, ["k"], order, "rn", part(), threshold)
    df = fill_forward(df, {"f": "v"}, ["k"], order, part(), threshold)
    df = previous_value(df, "v", ["k"], order, "p", part(), threshold)
    assert rows(df, "id", "rn", "f", "p") == expected


def test_more_hot_keys_than_may_be_collected(ordered, monkeypatch):
    monkeypatch.setattr("lapframe.operators.keys.MAX_HOT_KEYS", 1)
    window = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), "id")
    expected = rows(ordered.select("id", F.row_number().over(window)))
    assert rows(numbered(ordered, ["k"], ["t", "id"], "rn", part(), 1), "id", "rn") == expected


def test_fill_forward_keeps_leading_gap(frame):
    df = frame([(i, v) for i, v in enumerate([None, 5, None, 7, None])], "lap int, v int")
    df = df.withColumn("k", F.lit(1))
    assert [v for _, v in rows(fill_forward(df, {"f": "v"}, ["k"], ["lap"]), "lap", "f")] == [
        None, 5, 5, 7, 7,
    ]


def test_dense_rank(ordered):
    window = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last())
    expected = rows(ordered.select("id", F.dense_rank().over(window)))
    assert rows(dense_rank_by(ordered, ["k"], "v", "r"), "id", "r") == expected


def _timeline(spark, seed, n_points, n_spans, whole):
    """Points and spans with shared keys; some spans are empty, inverted or very long."""
    rnd = random.Random(seed)
    unit = 1_000_000

    def instant(exact):
        micros = (DAY + rnd.randrange(4000)) * unit
        return micros if exact else micros + rnd.choice([0, 0, 1, 999_999, rnd.randrange(unit)])

    points = [(rnd.choice("ab"), i, instant(False), rnd.randrange(64) / 8) for i in range(n_points)]
    points += [("a", n_points, None, 1.0), ("a", n_points + 1, DAY * unit, None)]
    spans = []
    for i in range(n_spans):
        lo = instant(whole)
        length = rnd.choice([0, 1, 3, 60, 1000, 100_000, -5]) * unit
        spans.append((rnd.choice("abc"), i, lo, lo + length))
    spans.append(("a", n_spans, None, None))
    p = spark.createDataFrame(points, "k string, pid int, us bigint, x double")
    s = spark.createDataFrame(spans, "k string, sid int, lo_us bigint, hi_us bigint")
    return (
        p.withColumn("at", F.timestamp_micros("us")).drop("us"),
        s.withColumns({"lo": F.timestamp_micros("lo_us"), "hi": F.timestamp_micros("hi_us")})
        .drop("lo_us", "hi_us"),
    )


@pytest.mark.parametrize("widths", [(10,), (600,), (5, 60), (1, 30, 900)])
def test_interval_join_finds_every_pair_once(spark, widths):
    points, spans = _timeline(spark, 3, 150, 60, whole=False)
    expected = rows(
        points.join(spans, "k").filter(F.col("at").between(F.col("lo"), F.col("hi"))), "pid", "sid"
    )
    assert len(expected) > 100
    assert rows(interval_join(points, spans, ["k"], "at", "lo", "hi", widths), "pid", "sid") == expected
    kept = interval_matches(spans, points, ["k"], "at", "lo", "hi", widths)
    counted = rows(kept.groupBy("k", "sid").agg(F.count("pid").alias("n")), "sid", "n")
    pairs = [sid for _, sid in expected]
    assert counted == sorted(((i, pairs.count(i)) for i in range(61)), key=repr)


def test_interval_join_on_numbers(frame):
    laps = frame([(1, n) for n in range(1, 30)], "k int, lap int")
    stints = frame([(1, 1, 9), (1, 10, 10), (1, 11, 40)], "k int, lo int, hi int")
    got = interval_join(laps, stints, ["k"], "lap", "lo", "hi", [4])
    assert rows(got.groupBy("lo").count()) == [(1, 9), (10, 1), (11, 19)]


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_range_aggregate_matches_the_join(spark, broadcast):
    points, spans = _timeline(spark, 5, 400, 80, whole=True)
    inside = (F.col("at") >= F.col("lo")) & (F.col("at") <= F.col("hi"))
    right = points.withColumnRenamed("k", "pk")
    expected = rows(
        spans.join(right, (F.col("k") == F.col("pk")) & inside, "left").groupBy("k", "sid").agg(
            F.sum("x").alias("total"), F.count("x").alias("n"), F.min("x").alias("low"),
            F.max("x").alias("high"),
        )
    )
    measures = {"total": ("x", "sum"), "n": ("x", "count"), "low": ("x", "min"), "high": ("x", "max")}
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast)
    try:
        got = range_aggregate(spans, points, ["k"], "at", "lo", "hi", measures)
        assert rows(got, "k", "sid", "total", "n", "low", "high") == expected
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_time_tree_is_built_once_by_one_scan_of_the_points(spark, tmp_path):
    points, spans = _timeline(spark, 30, 50, 400_000, whole=True)
    points.write.parquet(str(tmp_path / "p"))
    got = range_aggregate(spans, spark.read.parquet(str(tmp_path / "p")), ["k"], "at", "lo", "hi", {"n": ("x", "count")})
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_range_aggregate_refuses_fractions(spark):
    points, spans = _timeline(spark, 5, 10, 40, whole=False)
    with pytest.raises(Exception, match="whole seconds"):
        range_aggregate(spans, points, ["k"], "at", "lo", "hi", {"n": ("x", "count")}).collect()


def test_nearest_event_ranks(frame):
    events = frame(
        [(1, 4, "2024-01-01 00:00:05"), (1, 3, "2024-01-01 00:00:50"), (1, 9, "2024-01-01 00:00:50")],
        "k int, position int, date timestamp",
    )
    laps = frame([(1, 1, "2024-01-01 00:00:00", "2024-01-01 00:01:00")],
                 "k int, lap int, date_start timestamp, date_end timestamp")
    got = nearest_event_in_interval(events, laps, ["k"], "lap", tie_breakers=["date", "position"])
    assert rows(got, "position", "start_time_diff", "end_time_diff", "start_position_rank",
                "end_position_rank") == [(3, 50, 10, 2, 1), (4, 5, 55, 1, 3), (9, 50, 10, 3, 2)]


@pytest.mark.parametrize("threshold", [1, 60, 10_000])
def test_nearest_event_ranks_of_large_groups(spark, threshold):
    rnd = random.Random(4)
    events = [(rnd.choice("aab"), i, DAY * 1000 + rnd.randrange(900_000)) for i in range(200)]
    spans = [(k, n, DAY + s, DAY + e) for k in "ab" for n, s, e in ((1, 0, 700), (2, 650, 800), (3, 5, 6))]
    e = spark.createDataFrame(events, "k string, id int, ms bigint").withColumn("date", F.timestamp_millis("ms"))
    s = spark.createDataFrame(spans, "k string, lap int, a bigint, b bigint").withColumns(
        {"date_start": F.timestamp_seconds("a"), "date_end": F.timestamp_seconds("b")})
    got = nearest_event_in_interval(e, s, ["k"], "lap", tie_breakers=["date", "id"], threshold=threshold)
    window = Window.partitionBy("k", "lap")
    expected = got.select(
        "id", "lap", F.row_number().over(window.orderBy("start_time_diff", "date", "id")),
        F.row_number().over(window.orderBy("end_time_diff", "date", "id")))
    assert rows(got, "id", "lap", "start_position_rank", "end_position_rank") == rows(expected)
    assert got.count() > 150


def test_laps_that_share_a_number_are_split(spark, monkeypatch):
    # 10 events and 50 laps over the whole time, all without a number: 500 pairs in one group
    e = spark.range(10).select(F.lit(1).alias("k"), F.col("id"), F.timestamp_seconds(F.col("id") * 30 + DAY).alias("date"))
    s = spark.range(50).select(
        F.lit(1).alias("k"), F.lit(None).cast("int").alias("lap"), F.timestamp_seconds(F.lit(DAY) - F.col("id")).alias("date_start"),
        F.timestamp_seconds(F.lit(DAY + 300)).alias("date_end"),
    )
    few = s.limit(2).withColumn("lap", F.lit(7))
    sizes = intervals.pair_counts(e, s.unionByName(few), ["k"], ["lap"], "date", "date_start", "date_end", (60, None))
    assert rows(sizes, "lap", "__n") == [(7, 20), (None, 500)]
    asked = []
    real = intervals.numbered
    monkeypatch.setattr(intervals, "numbered", lambda *a, **k: asked.append(k["hot"]) or real(*a, **k))
    got = nearest_event_in_interval(e, s.unionByName(few), ["k"], "lap", tie_breakers=["date", "id"], threshold=100)
    assert [[tuple(r) for r in hot.found] for hot in asked] == [[(1, None)]] * 2
    assert rows(got.filter("lap IS NULL"), "start_position_rank") == sorted([(i,) for i in range(1, 501)], key=repr)
    nearest_event_in_interval(e, few, ["k"], "lap", threshold=100)
    assert asked[2:] == [None, None]


def test_wrong_bounds_are_not_listed(spark):
    stints = spark.createDataFrame([(1, 1, 3), (1, 2, 2_000_000_000), (1, -2_000_000_000, 2), (1, 9, 4)], "k int, lo int, hi int")
    laps = spark.createDataFrame([(1, i) for i in range(1, 50)] + [(1, None)], "k int, lap int")
    cells = intervals._span_cells(stints, "lo", "hi", [4, None], outer=True)
    assert cells.count() == 1 + 1 + 1 + 1
    got = interval_join(laps, stints, ["k"], "lap", "lo", "hi", [4, None])
    assert rows(got.groupBy("lo").count()) == sorted([(1, 3), (2, 48), (-2_000_000_000, 2)], key=repr)
    kept = interval_matches(stints, laps, ["k"], "lap", "lo", "hi", [4, None]).groupBy("lo", "hi").agg(F.count("lap").alias("n"))
    assert rows(kept, "lo", "n") == sorted([(1, 3), (2, 48), (-2_000_000_000, 2), (9, 0)], key=repr)


@pytest.mark.parametrize("parts", [1, 2])
def test_rows_without_a_time_are_split_too(spark, parts):
    rnd = random.Random(6)
    data = [("a", None, i, rnd.choice([None, 1, 2])) for i in range(60)] + [("a", None, None, 5)] + [("a", t, 100 + t, t) for t in range(5)]
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    cut = [F.floor(F.col("t") / 2), F.floor(F.col("id") / 9)][:parts]
    split = split_hot_keys(df, ["k"], cut, 1)
    largest = max(n for _, n in rows(split.groupBy("__part").count()))
    assert largest == (61 if parts == 1 else 9)
    window = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    expected = rows(df.select("id", F.row_number().over(window), F.last("v", True).over(window.rowsBetween(Window.unboundedPreceding, 0)), F.lag("v").over(window)))
    out = numbered(df, ["k"], ["t", "id"], "rn", cut, 1)
    out = previous_value(fill_forward(out, {"f": "v"}, ["k"], ["t", "id"], cut, 1), "v", ["k"], ["t", "id"], "p", cut, 1)
    assert rows(out, "id", "rn", "f", "p") == expected


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_burst_matches_a_window_over_everything(spark, keys):
    rnd = random.Random(2)
    data = [(i, rnd.choice("ab"), DAY * 1000 + rnd.randrange(300_000), rnd.randrange(10)) for i in range(900)]
    df = spark.createDataFrame(data, "id int, k string, ms bigint, x int").withColumn(
        "t", F.timestamp_millis("ms")
    )
    df = df.unionByName(spark.createDataFrame([(901, "a", None, 9)], "id int, k string, ms bigint, x int")
                        .withColumn("t", F.timestamp_millis("ms")))
    window = Window.partitionBy(*keys).orderBy(F.col("t").asc_nulls_last())
    kept = df.filter("x > 2").withColumns(
        {"before": F.lag("ms").over(window), "after": F.lead("ms").over(window)}
    )
    expected = rows(kept.filter("ms - before < 200 or after - ms < 200"), "id")
    got = sustained_burst(df, F.col("x") > 2, "t", 200, keys)
    assert rows(got, "id") == expected
    assert 100 < len(expected) < 600
    assert got.columns == df.columns
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
