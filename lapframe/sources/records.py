"""Landed JSON record batches to typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_records(values: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON texts, each one object or a list, to rows.

    List items that are no objects are dropped, and so are malformed texts; :func:`rejected_records`
    returns those. A field of another type than the schema's is NULL.
    """
    text = F.trim(F.col(column))
    values = values.filter(F.try_parse_json(text).isNotNull())
    items = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(
        F.array(text)
    )
    return (
        values.select(F.explode(items).alias("__item"))
        .filter(F.ltrim(F.col("__item")).startswith("{"))
        .select(F.from_json("__item", schema).alias("r"))
        .select("r.*")
    )


def rejected_records(values: DataFrame, column: str = "value") -> DataFrame:
    """``record, reason`` of the texts that :func:`parse_records` leaves out as malformed.

    Empty texts are neither records nor rejects.
    """
    text = F.trim(F.col(column))
    bad = values.filter((text != "") & F.try_parse_json(text).isNull())
    return bad.select(F.col(column).alias("record"), F.lit("malformed JSON").alias("reason"))


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, whole_files: bool = False
) -> DataFrame:
    """Read a record batch with an explicit schema.

    By default every line is one JSON value (an object or a list), which keeps files splittable.
    ``whole_files`` reads pretty-printed files, one JSON value per file.
    """
    return parse_records(spark.read.text(path, wholetext=whole_files), schema)


def infer_schema(
    sample: Mapping[str, object], overrides: T.StructType | None = None
) -> T.StructType:
    """Column types from one sample record.

    Texts whose key ends with ``date`` or ``_at`` become timestamps, numbers DOUBLE, other texts
    STRING, booleans BOOLEAN, lists arrays of their first item's type. Keys with other values get no
    column unless ``overrides`` names them; overrides also replace inferred types.
    """
    fixed = {f.name: f.dataType for f in (overrides or T.StructType([])).fields}
    fields: dict[str, T.DataType] = {}
    for key, value in sample.items():
        kind = fixed.get(key) or _sample_type(key, value)
        if kind is not None:
            fields[key] = kind
    for key, kind in fixed.items():
        fields.setdefault(key, kind)
    return T.StructType([T.StructField(k, t) for k, t in fields.items()])


def _sample_type(key: str, value: object) -> T.DataType | None:
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, (int, float)):
        return T.DoubleType()
    if isinstance(value, (str, datetime)):
        timed = isinstance(value, datetime) or key.lower().endswith(("date", "_at"))
        return T.TimestampType() if timed else T.StringType()
    if isinstance(value, list):
        item = _sample_type("", value[0]) if value else None
        return T.ArrayType(item or T.StringType())
    return None


def normalize_columns(df: DataFrame, case: str = "lower") -> DataFrame:
    """Rename all columns to one letter case; two columns falling together is an error."""
    change = {"lower": str.lower, "upper": str.upper}[case]
    names = [change(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"columns differ only by case: {df.columns}")
    return df.toDF(*names)


def coerce_to_string(
    df: DataFrame, cols: Sequence[str], null_token: str = "None", missing: str = ""
) -> DataFrame:
    """Store mixed number/text columns as text: NULL becomes ``null_token``; a column that the batch
    lacks is added holding ``missing``."""
    present = set(df.columns)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("string"), F.lit(null_token))
            if c in present
            else F.lit(missing)
            for c in cols
        }
    )


def _all_present(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def require_fields(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected): rows with all of ``cols`` and rows lacking at least one."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        return df.limit(0), df
    ok = _all_present(cols)
    return df.filter(ok), df.filter(~ok)


def only_new(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys have no row in ``target``."""
    return df.join(target.select(*keys).distinct(), list(keys), "left_anti")
