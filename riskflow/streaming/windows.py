"""The current state of windows that a stream writes in update mode, kept small by merging old batches.

``batch_id=N`` folders hold the windows that batch N changed. ``_current/upto=N`` is a generation: the last state of every
window up to batch N, written aside and renamed when complete. A reader takes the latest generation and the batches after it,
so what it reads depends on the number of windows and on how often batches are merged, not on how many batches there were.
The generation before the latest stays with its later batches, for readers that have begun on it; older files go.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.sources.versions import delete, file_system, rename_new

WINDOW_KEYS = ("w_start", "endpoint")
#: Batches between two merges.
COMPACT_EVERY = 50


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``name=N`` under ``path``, in order."""
    where, fs = file_system(spark, path)
    found = fs.listStatus(where) if fs.exists(where) else []
    names = [f.getPath().getName() for f in found]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))


def _last_states(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    """The last row of each window, with the batch that wrote it as ``batch_id``."""
    generations = _numbers(spark, f"{path}/_current", "upto")
    done = generations[-1] if generations else -1
    later = [n for n in _numbers(spark, path, "batch_id") if n > done]
    if not generations and not later:
        raise FileNotFoundError(f"no windows under {path}")
    rows = spark.read.parquet(f"{path}/_current/upto={done}") if generations else None
    if later:
        changed = spark.read.option("basePath", path).parquet(*[f"{path}/batch_id={n}" for n in later])
        changed = changed.withColumn("batch_id", F.col("batch_id").cast("bigint"))
        rows = changed if rows is None else rows.unionByName(changed)
    elif rows is not None:
        return rows
    values = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*values), "batch_id")
    return rows.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*")


def latest_windows(spark: SparkSession, path: str, keys: tuple[str, ...] = WINDOW_KEYS) -> DataFrame:
    """The current state of every window; an error where no batch has been written."""
    return _last_states(spark, path, keys).drop("batch_id")


def compact_windows(spark: SparkSession, path: str, keys: tuple[str, ...] = WINDOW_KEYS) -> None:
    """Merge all batches into the next generation and retire what two generations no longer need.

    Not while a batch is being written: the sink calls it between batches. A repeated call changes nothing, and a run that
    dies leaves a draft behind, which no reader looks at.
    """
    generations, batches = _numbers(spark, f"{path}/_current", "upto"), _numbers(spark, path, "batch_id")
    if batches and batches[-1] > (generations[-1] if generations else -1):
        draft = f"{path}/_current/_draft-{uuid.uuid4().hex}"
        _last_states(spark, path, keys).write.parquet(draft)
        rename_new(spark, draft, f"{path}/_current/upto={batches[-1]}")
        generations.append(batches[-1])
    for old in generations[:-2]:
        delete(spark, f"{path}/_current/upto={old}")
    for n in batches:
        if len(generations) > 1 and n <= generations[-2]:
            delete(spark, f"{path}/batch_id={n}")


def window_writer(path: str, keys: tuple[str, ...] = WINDOW_KEYS, every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """Writes the changed windows of one micro-batch, and merges after every ``every`` batches.

    A repeated batch replaces its own folder; where a generation holds it already, its rows are the same.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if (batch_id + 1) % every == 0:
            compact_windows(batch.sparkSession, path, keys)

    return write
