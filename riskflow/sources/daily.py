"""Logs with one folder per day (or month) of ``ts``, of which readers open only those they need.

A folder is named by the first day it holds.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.sources.sinks import LOG_CODEC, LOG_FILE_RECORDS

DAY = "day"


def append_daily(df: DataFrame, path: str, unit: str = "day") -> None:
    """Records as JSON lines below ``path``; those without a time have a folder of their own.

    ``unit`` is ``day`` or ``month``, the same for all writers of a log. Small folders get one file, large ones several.
    """
    rows = df.withColumn(DAY, F.to_date(F.date_trunc(unit, "ts"))).hint("rebalance", DAY)
    writer = rows.write.mode("append").partitionBy(DAY).option("ignoreNullFields", False)
    writer.option("maxRecordsPerFile", LOG_FILE_RECORDS).option("compression", LOG_CODEC).json(path)


def days(spark: SparkSession, path: str) -> list[date]:
    """The folders' first days, newest first, from their names alone."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    found = [n.removeprefix(f"{DAY}=") for n in names if n.startswith(f"{DAY}=")]
    return sorted((date.fromisoformat(n) for n in found if not n.startswith("__")), reverse=True)


def read_daily(spark: SparkSession, path: str, schema: T.StructType, since: date | None = None) -> DataFrame:
    """The records from the folder that holds day ``since`` on, or all; no rows where nobody has written yet.

    Where all folders begin a month, they may hold whole months, so the month of ``since`` is read from its beginning.
    """
    found = days(spark, path)
    if not found and not _exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).json(path)
    if since is not None:
        start = since.replace(day=1) if all(d.day == 1 for d in found) else since
        rows = rows.where(F.col(DAY) >= F.lit(start))
    return rows.drop(DAY)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def first_day_of_last(spark: SparkSession, path: str, schema: T.StructType, n: int) -> date | None:
    """The folder from which on there are at least ``n`` records; None if there are not so many with a time.

    Folders are counted from the newest, twice as many each time, and none twice.
    """
    left, at, step = days(spark, path), 0, 1
    total = 0
    while at < len(left):
        span = left[at : at + step]
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).json(path)
        total += rows.where(F.col(DAY).between(F.lit(span[-1]), F.lit(span[0]))).count()
        if total >= n:
            return span[-1]
        at, step = at + step, 2 * step
    return None


def read_last(spark: SparkSession, path: str, schema: T.StructType, n: int | None, tie: str = "request_id") -> DataFrame:
    """The last ``n`` records by (``ts``, ``tie``): the days found to hold them are read, no others."""
    if n is None:
        return read_daily(spark, path, schema)
    rows = read_daily(spark, path, schema, first_day_of_last(spark, path, schema, n))
    return rows.orderBy(F.col("ts").desc(), F.col(tie).desc()).limit(n)


def read_around(spark: SparkSession, path: str, schema: T.StructType, first: date | None, lead_days: int) -> DataFrame:
    """The records from ``lead_days`` before ``first`` on; all without a first day."""
    return read_daily(spark, path, schema, first - timedelta(days=lead_days) if first is not None else None)
