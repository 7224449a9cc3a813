from pyspark.sql import functions as F

from lapframe import quality
from lapframe.quality.suite import SUITE, VALID_DRS, pedal_overlap
from lapframe.schemas import RAW


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_number_of_declared_checks():
    names = [c.name for checks in SUITE.values() for c in checks]
    assert len(names) == 51
    assert {n: names.count(n) for n in set(names)} == {
        "not_null": 38, "unique": 1, "relationships": 2, "accepted_values": 1, "range_check": 4,
        "rpm_range": 1, "speed_range": 1, "throttle_range": 1, "valid_drs": 1,
        "brake_throttle_combination": 1,
    }


def test_range_bounds_are_inclusive_and_null_passes(frame):
    df = frame([(None,), (0,), (10,), (11,), (-1,)], "v int")
    assert rows(quality.range_check("v", 0, 10).failures(df)) == [(-1,), (11,)]
    assert rows(quality.range_violation_count(df, "v", 0, 10)) == [(2,)]
    assert rows(VALID_DRS.failures(df.withColumnRenamed("v", "drs"))) == [(-1,)]


def test_where_limits_the_rows_checked(frame):
    df = frame([(0, None), (1, None), (1, 5)], "d int, v int")
    check = quality.not_null("v", where="d != 0")
    assert rows(check.failures(df)) == [(1, None)]
    assert rows(quality.run_checks(df, [check], table="t")) == [("t", "not_null", "v", 2, 1, False)]


def test_unique_and_relationships(frame):
    df = frame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(quality.unique("k").failures(df)) == [(1, 2)]
    parent = frame([(1,), (1,), (None,)], "id int")
    check = quality.relationships("k", "p", "id")
    assert rows(check.failures(df, {"p": parent})) == [(2,)]
    report = quality.run_checks(df, [quality.unique("k"), check], {"p": parent}, "t")
    assert rows(report) == [("t", "relationships", "k", 5, 1, False), ("t", "unique", "k", 5, 1, False)]


def test_pedal_overlap(frame):
    df = frame([("2024-01-01 00:00:00.000", 106), ("2024-01-01 00:00:00.499", 106),
                ("2024-01-01 00:00:00.999", 106), ("2024-01-01 00:00:01.100", 50)],
               "date timestamp, brake int").select(
        "*", F.lit(110).alias("throttle"), F.lit(60).alias("speed"), F.lit(6000).alias("rpm"))
    # 499 ms apart counts, 500 ms does not, and a row outside the condition is no neighbour
    assert pedal_overlap().failures(df).count() == 2


def test_suite_on_empty_tables(spark):
    tables = {t: spark.createDataFrame([], RAW[t]) for t in SUITE}
    report = quality.run_suite(tables).collect()
    assert len(report) == 51
    assert all(r["passed"] and r["n_failed"] == 0 for r in report)


def test_row_checks_share_one_scan(frame):
    df = frame([(1, 2)], "a int, b int")
    report = quality.run_checks(df, [quality.not_null("a"), quality.not_null("b"), quality.range_check("b", 0, 1)])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1
