"""Logs by day and the stored reference against whole tables."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators import monitoring
from riskflow.operators.evaluation import score_counts
from riskflow.operators.features import clean, profile
from riskflow.sources import daily

SCHEMA = T.StructType([T.StructField("request_id", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("score", T.DoubleType())])


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = [(f"r{k}", start + timedelta(days=int(rng.random() ** 2 * 60), seconds=rng.randint(0, 9)), 0.5) for k in range(400)]
    rows += [("none", None, 0.1), ("last", start + timedelta(days=400), 0.2)]
    path = str(tmp_path_factory.mktemp("log") / "daily")
    df = spark.createDataFrame(rows, SCHEMA)
    daily.append_daily(df.limit(200), path)
    daily.append_daily(df.join(df.limit(200).select("request_id"), "request_id", "left_anti").select(df.columns), path)
    return df, path


@pytest.mark.parametrize("n", [1, 2, 30, 399, 401, 402, 5000])
def test_last_records(spark, log, n):
    df, path = log
    got = daily.read_last(spark, path, SCHEMA, n)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, monitoring.recent(df, n).collect()))


def test_only_needed_days_are_read(spark, log):
    df, path = log
    first = daily.first_day_of_last(spark, path, SCHEMA, 30)
    rows = daily.read_daily(spark, path, SCHEMA, first)
    assert "PartitionFilters: [isnotnull(day" in rows._jdf.queryExecution().executedPlan().toString()
    newest = daily.days(spark, path)
    assert newest[0] == date(2025, 2, 4) and newest == sorted(newest, reverse=True)
    # Twice as many days each time: at most about twice the days that were needed.
    assert 30 <= rows.count() <= 150 and rows.count() == df.where(F.to_date("ts") >= F.lit(first)).count()


@pytest.mark.parametrize("unit", ["day", "month"])
def test_records_around_a_day(spark, log, tmp_path, unit):
    df, _ = log
    path = str(tmp_path / unit)
    daily.append_daily(df, path, unit)
    got = daily.read_around(spark, path, SCHEMA, date(2024, 3, 20), 10)
    kept = {r["request_id"] for r in got.collect()}
    assert {r["request_id"] for r in df.where("ts >= '2024-03-10'").collect()} <= kept
    assert not kept & {r["request_id"] for r in df.where("ts < '2024-03-01'").collect()}
    last = daily.read_last(spark, path, SCHEMA, 30)
    assert Counter(map(tuple, last.collect())) == Counter(map(tuple, monitoring.recent(df, 30).collect()))


def test_no_log(spark, tmp_path):
    path = str(tmp_path / "none")
    assert daily.days(spark, path) == [] and daily.first_day_of_last(spark, path, SCHEMA, 5) is None
    assert daily.read_last(spark, path, SCHEMA, 5).count() == 0 and daily.read_last(spark, path, SCHEMA, None).columns == SCHEMA.names


def test_references_add_up(spark, cohort_table):
    scored = cohort_table.select((F.col("encounter_id") % 50 / 50.0).alias("score"), (F.col("encounter_id") % 3 == 0).cast("int").alias("target"))
    a, b = cohort_table.where("encounter_id % 2 = 0"), cohort_table.where("encounter_id % 2 = 1")
    one, two = scored.limit(2500), scored.exceptAll(scored.limit(2500))
    both = monitoring.reference_of(a, one).plus(monitoring.reference_of(b, two))
    assert Counter(map(tuple, both.profile.collect())) == Counter(map(tuple, profile(clean(cohort_table)).collect()))
    assert Counter(map(tuple, both.scores.collect())) == Counter(map(tuple, score_counts(scored).collect()))


def test_files_of_a_day_are_compressed_and_bounded(spark, log, tmp_path, monkeypatch):
    df, _ = log
    monkeypatch.setattr(daily, "LOG_FILE_RECORDS", 50)
    path = tmp_path / "bounded"
    daily.append_daily(df, str(path), "month")
    files = [p for p in path.rglob("part-*") if not p.name.endswith(".crc")]
    assert files and all(p.name.endswith(".json.snappy") for p in files)
    assert max(spark.read.json(str(p)).count() for p in files) <= 50
    assert daily.read_daily(spark, str(path), SCHEMA).count() == df.count()
