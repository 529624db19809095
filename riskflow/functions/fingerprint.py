"""Content hashes of tables that don't depend on the order of rows or columns, and that add up.

A row is written as text: its columns in order of their names, each value with its length before it, a null as ``~``. The
fingerprint of some rows is their number and the sums, modulo 2^64, of both halves of the rows' md5. Repeated rows count,
and the fingerprint of a union is the sum of the parts' fingerprints, so an append needs only the new rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MODULUS = "18446744073709551616BD"  # 2^64


def _cell(field: T.StructField) -> Column:
    """A value as text that other engines write alike; fractions as Spark writes them, nested values as JSON."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(field.dataType, T.DateType):
        value = F.unix_date(value)
    elif isinstance(field.dataType, T.BooleanType):
        value = value.cast("int")
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(value)
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def row_text(df: DataFrame, leave_out: tuple[str, ...] = ()) -> Column:
    fields = sorted((f for f in df.schema.fields if f.name not in leave_out), key=lambda f: f.name)
    return F.concat_ws(";", *[_cell(f) for f in fields])


def _total(name: str) -> Column:
    return F.expr(f"pmod(sum({name}), {_MODULUS})").cast("decimal(20,0)").alias(name)


def fingerprints(df: DataFrame, by: tuple[str, ...] = (), **sums: Column) -> DataFrame:
    """(by..., rows, low, high) and the aggregates asked for, in one pass; the ``by`` columns are not part of the text."""
    half = lambda at: F.conv(F.substring("_md5", at, 16), 16, 10).cast("decimal(38,0)")
    rows = df.withColumn("_md5", F.md5(row_text(df, by))).withColumns({"low": half(1), "high": half(17)})
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), _total("low"), _total("high"), *[c.alias(k) for k, c in sums.items()])


def combined(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The fingerprints of unions of parts from those of the parts."""
    wide = parts.withColumns({c: F.col(c).cast("decimal(38,0)") for c in ("low", "high")})
    return wide.groupBy(*by).agg(F.sum("rows").alias("rows"), _total("low"), _total("high"))


def digest(*names: str) -> Column:
    """The sha256 of a fingerprint row and of what else goes with it."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("0")) for n in ("rows", "low", "high")], *names), 256)
