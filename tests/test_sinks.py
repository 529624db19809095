"""Logs are written compressed, in files of bounded size, and read back whole."""

from pathlib import Path

from pyspark.sql import functions as F

from riskflow.sources import read_label_log, read_request_lines, sinks


def test_logs_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LOG_FILE_RECORDS", 40)
    rows = spark.range(100, numPartitions=1).select(
        F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.when(F.col("id") > 3, F.col("id")).alias("encounter_id"), (F.col("id") % 3 == 0).alias("readmitted_30d")
    )
    sinks.append_log(rows, str(tmp_path / "log"))
    assert len(list(Path(tmp_path / "log").glob("*.json.snappy"))) == 3
    got = read_label_log(spark, str(tmp_path / "log"))
    assert sorted(map(str, got.select(rows.columns).collect())) == sorted(map(str, rows.collect()))
    lines = spark.range(100, numPartitions=1).select(F.concat(F.lit('{"é":'), "id", F.lit("}")).alias("line"))
    sinks.write_request_lines(lines, str(tmp_path / "requests"))
    assert len(list(Path(tmp_path / "requests").glob("*.txt.snappy"))) == 3
    assert sorted(read_request_lines(spark, str(tmp_path / "requests")).collect()) == sorted(lines.collect())
