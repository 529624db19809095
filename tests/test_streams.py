"""Streams of predictions and labels against brute force, and windows merged over many batches."""

import json
import os
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.streaming import streams, windows

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def write_log(folder, rows, files):
    """Records in ``files`` files, whose times say in which order they arrived."""
    os.makedirs(folder)
    for i, part in enumerate(np.array_split(np.arange(len(rows)), files)):
        path = f"{folder}/part-{i:03d}.json"
        with open(path, "w") as out:
            out.writelines(json.dumps(rows[k]) + "\n" for k in part)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def at(day):
    return (START + timedelta(seconds=int(day * 86400))).isoformat()


def test_labels_before_and_after_predictions_in_shuffled_batches(spark, tmp_path):
    rng = np.random.default_rng(11)
    made = [(f"r{i}", int(rng.integers(0, 120)), float(rng.uniform(0, 100))) for i in range(150)]
    told = [(int(rng.integers(0, 120)), float(rng.uniform(0, 100)), bool(rng.integers(0, 2))) for _ in range(90)]
    # Records arrive up to ten days late; the last ones close all ranges.
    made.sort(key=lambda r: r[2] + rng.uniform(0, 10))
    told.sort(key=lambda r: r[1] + rng.uniform(0, 10))
    write_log(str(tmp_path / "p"), [{"request_id": r, "ts": at(d), "score": 0.5, "model_version": "v", "features": {"encounter_id": e}} for r, e, d in made]
              + [{"request_id": "none", "ts": at(1), "features": {}}, {"request_id": "last", "ts": at(900), "features": {"encounter_id": -1}}], 5)
    write_log(str(tmp_path / "l"), [{"encounter_id": e, "ts": at(d), "readmitted_30d": y} for e, d, y in told] + [{"encounter_id": -2, "ts": at(900), "readmitted_30d": True}], 4)

    joined = streams.join_labels(
        streams.stream_predictions(spark, str(tmp_path / "p"), 1), streams.stream_labels(spark, str(tmp_path / "l"), 1),
        "left_outer", within="20 days", early="6 days", late="15 days",
    )
    out = joined.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
    query = out.trigger(availableNow=True).start()
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress}) >= 5
    rows = spark.read.parquet(str(tmp_path / "out"))
    got = sorted((r["request_id"], r["readmitted_30d"]) for r in rows.where("labelled_at IS NOT NULL").collect())
    want = sorted((r, y) for r, e, d in made for f, t, y in told if e == f and int(d * 86400) - 6 * 86400 <= int(t * 86400) <= int(d * 86400) + 20 * 86400)
    assert got == want
    early = {r for r, e, d in made for f, t, _ in told if e == f and d - 6 <= t < d}
    assert early and early <= {r for r, _ in got}
    left = {r["request_id"] for r in streams.unlabelled(rows).collect()}
    assert left - {"none"} == {r for r, _, _ in made} - {r for r, _ in want}


def test_merged_windows_equal_all_batches(spark, tmp_path):
    """Fifty batches, one of them repeated, and a draft of a run that died."""
    rng = np.random.default_rng(4)
    path, schema, want = str(tmp_path / "w"), "w_start bigint, endpoint string, requests bigint, p50 double", {}
    with pytest.raises(FileNotFoundError):
        windows.latest_windows(spark, path)
    write = windows.window_writer(path, every=8)
    for n in range(50):
        keys = {(int(rng.integers(0, 40)), str(rng.choice(["a", "b"]))) for _ in range(6)} if n % 9 else set()
        rows = [(*k, n, None if n % 5 == 0 else float(n)) for k in sorted(keys)]
        want.update({r[:2]: r[2:] for r in rows})
        for _ in range(2 if n in (15, 20) else 1):
            write(spark.createDataFrame(rows, schema).coalesce(1), n)
        if n == 30:
            spark.range(3).write.parquet(f"{path}/_current/_draft-dead")
    state = windows.latest_windows(spark, path)
    assert {(r["w_start"], r["endpoint"]): (r["requests"], r["p50"]) for r in state.collect()} == want and state.count() == len(want)
    kept = sorted(int(f.split("=")[1]) for f in os.listdir(path) if f.startswith("batch_id="))
    assert kept == list(range(40, 50)) and {"upto=39", "upto=47"} <= set(os.listdir(f"{path}/_current")) <= {"upto=39", "upto=47", "_draft-dead"}
    windows.compact_windows(spark, path)
    windows.compact_windows(spark, path)
    again = windows.latest_windows(spark, path)
    assert {(r["w_start"], r["endpoint"]): (r["requests"], r["p50"]) for r in again.collect()} == want


def test_alerts_of_arriving_gauges(spark, tmp_path):
    gauges = spark.createDataFrame([(f, v) for f, v in (("data_drift", 1.0), ("concept_drift", 0.0), ("drift_share", 1.0))], "metric string, value double")
    rows = gauges.withColumn("snapshot_ts", F.lit(START).cast("timestamp"))
    rows.write.parquet(str(tmp_path / "g"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "g"))
    streams.alert_stream(arriving, str(tmp_path / "a"), str(tmp_path / "c")).awaitTermination()
    assert [r["title"] for r in spark.read.json(str(tmp_path / "a")).collect()] == ["DRIFT FLAG UP"]
