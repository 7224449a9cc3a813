"""A batch of landed records into the raw tables, table by table, with a ledger of what was done."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe.quality.checks import Check, run_checks
from lapframe.schemas import RAW, REQUIRED_FIELDS, TEXT_COLUMNS, merge_keys
from lapframe.session import delete_path, path_exists
from lapframe.sinks.audit import with_audit
from lapframe.sinks.layout import write_table
from lapframe.sinks.publish import CheckFailed
from lapframe.sinks.report import load_report
from lapframe.sinks.upsert import upsert_table
from lapframe.sources.records import (
    coerce_to_string,
    infer_schema,
    normalize_columns,
    only_new,
    parse_records,
    rejected_records,
    require_fields,
)

LEDGER, REJECTS = "_ledger", "_rejects"
_REJECTED = "record string, reason string"


def landed_schema(values: DataFrame, table: str) -> T.StructType:
    """The declared columns of ``table`` in the spelling of the first landed record, and what else it has.

    Only that record is read. A table that is not declared gets all its types from it.
    """
    line = values.filter(F.ltrim("value").rlike(r"^(\{|\[\s*\{)") & F.try_parse_json("value").isNotNull()).first()
    found = json.loads(line["value"]) if line else {}
    sample = found[0] if isinstance(found, list) else found
    schema = infer_schema({k.lower(): v for k, v in sample.items()}, RAW.get(table))
    spelled = {k.lower(): k for k in sample}
    upper = bool(sample) and all(k == k.upper() for k in sample)
    return T.StructType([T.StructField(spelled.get(f.name, f.name.upper() if upper else f.name), f.dataType) for f in schema.fields])


def prepared(values: DataFrame, table: str, run_date: dt.date | str, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Landed lines as (rows ready to be merged, rejects): parsed, lower-case, texts coerced, required
    fields present, stamped."""
    rows = normalize_columns(parse_records(values, landed_schema(values, table)))
    if table in TEXT_COLUMNS:
        rows = coerce_to_string(rows, TEXT_COLUMNS[table])
    rejects = rejected_records(values)
    if table in REQUIRED_FIELDS:
        rows, lacking = require_fields(rows, REQUIRED_FIELDS[table])
        rejects = rejects.unionByName(lacking.select(F.to_json(F.struct("*")).alias("record"), F.lit("required field missing").alias("reason")))
    return with_audit(rows, run_date, now), rejects


def _held(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """Sessions that other loads have put into a table; two columns are read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "session_key int")
    table = spark.read.option("mergeSchema", "true").parquet(path)
    others = table.filter(~F.col("load_id").eqNullSafe(F.lit(load_id))) if "load_id" in table.columns else table
    return others.select(F.col("session_key").cast("int").alias("session_key")).distinct()


def load_table(
    spark: SparkSession,
    base: str,
    table: str,
    values: DataFrame,
    sessions: DataFrame,
    run_date: dt.date | str,
    load_id: str,
    checks: Sequence[Check] = (),
    skip_existing: bool = True,
    now: Column | None = None,
) -> DataFrame:
    """Stage, check and merge the landed lines of one table; the report per requested session.

    Sessions that the table already holds from other loads are skipped (``skip_existing``). Nothing is
    merged unless all checks pass on the staged rows. Any failure becomes the report's ``error`` of the
    sessions that were not there before. Up to the last step it leaves the table as it was; one while
    partitions are being replaced is mended by the same ``load_id``.
    """
    path, staging = f"{base}/{table}", f"{base}/_staging/{table}-{uuid.uuid4().hex}"
    requested = sessions.select("meeting_key", "session_key").distinct()
    try:
        held = _held(spark, path, load_id) if skip_existing else spark.createDataFrame([], "session_key int")
        # stored, for the merge changes what it is read from
        held.write.parquet(f"{staging}/held")
        existing = requested.join(spark.read.schema("session_key int").parquet(f"{staging}/held"), "session_key")
        try:
            batch, rejects = prepared(values, table, run_date, now)
            missing = [k for k in merge_keys(table) if k not in batch.columns]
            if missing:
                raise ValueError(f"merge keys missing in {table}: {missing}")
            write_table(batch, f"{staging}/rows")
            rejects.write.mode("overwrite").parquet(f"{base}/{REJECTS}/load_id={load_id}/endpoint={table}")
            staged = spark.read.schema(batch.schema).parquet(f"{staging}/rows")
            if checks:
                failed = run_checks(staged, checks, {}).filter("NOT passed").collect()  # one row per check
                if failed:
                    raise CheckFailed(", ".join(f"{r['check']}({r['column']}): {r['n_failed']}" for r in failed))
            fresh = only_new(staged.join(requested.select("session_key"), "session_key", "left_semi"), existing, ["session_key"])
            upsert_table(spark, path, fresh.select(*batch.columns), merge_keys(table), now=now, load_id=load_id, new_columns="add")
            report = load_report(requested, table, existing, staged)
        except Exception as error:  # one table's failure must not stop the others
            reason = f"{type(error).__name__}: {str(error).splitlines()[0][:200]}"
            empty = spark.createDataFrame([], "session_key int")
            report = load_report(requested, table, existing, empty, requested.select("session_key", F.lit(reason).alias("reason")))
        report.drop("endpoint").write.mode("overwrite").parquet(f"{base}/{LEDGER}/load_id={load_id}/endpoint={table}")
    finally:
        delete_path(spark, staging)
    return read_ledger(spark, base, load_id).filter(F.col("endpoint") == table)


def load_batch(
    spark: SparkSession,
    base: str,
    landed: Mapping[str, DataFrame],
    sessions: DataFrame,
    run_date: dt.date | str,
    load_id: str,
    checks: Mapping[str, Sequence[Check]] | None = None,
    **options,
) -> DataFrame:
    """Load every landed table (lines in ``value``); the ledger of this load, one row per table and session.

    Tables are independent: one that fails is reported and the others are published. The same ``load_id``
    may be run again, after a failure or not; it changes nothing that is already in place.
    """
    base = base.rstrip("/")
    for table, values in landed.items():
        load_table(spark, base, table, values, sessions, run_date, load_id, (checks or {}).get(table, ()), **options)
    return read_ledger(spark, base, load_id)


def read_ledger(spark: SparkSession, base: str, load_id: str | None = None) -> DataFrame:
    """``load_id, endpoint, meeting_key, session_key, status, reason, records`` of all loads, or of one."""
    schema = "meeting_key int, session_key int, status string, reason string, records bigint, load_id string, endpoint string"
    rows = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{LEDGER}")
    rows = rows if load_id is None else rows.filter(F.col("load_id") == load_id)
    return rows.select("load_id", "endpoint", "meeting_key", "session_key", "status", "reason", "records")


def read_rejects(spark: SparkSession, base: str, load_id: str) -> DataFrame:
    """``endpoint, record, reason`` of the landed records that a load left out."""
    rows = spark.read.schema(f"{_REJECTED}, load_id string, endpoint string").parquet(f"{base.rstrip('/')}/{REJECTS}")
    return rows.filter(F.col("load_id") == load_id).select("endpoint", "record", "reason")
