"""A table's versions under one folder, each published by a manifest that appears at once.

``data/`` has one folder of Parquet for each attempt to write, ``manifests/`` one JSON file for each published version, named
by its number. A version is written, read back and checked, and only then its manifest is renamed into place; readers look
at manifests only, so a run that dies leaves files behind but never a version. The name is the content's: publishing the
current content again changes nothing. Of two runs that publish on the same parent one gets the number, the other an error.

The rename must not replace files, which holds for HDFS and local folders; object stores need a connector with that promise.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators import cohort, retrain
from riskflow.params import Params

HISTORY_SCHEMA = (
    "number bigint, data_version string, parent_data_version string, raw_sha256 string, path string, "
    "splits array<struct<split:string,rows:bigint,pos_rate:double,sha256:string>>"
)


class VersionConflict(RuntimeError):
    """Another run has published a version since the parent was read."""


class VersionCheckFailed(ValueError):
    """What was written is not what should be published."""


def file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; an error if ``target`` is there."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    where, _ = file_system(spark, target)
    qualified = where.makeQualified(*(lambda fs: (fs.getUri(), fs.getWorkingDirectory()))(file_system(spark, target)[1]))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        raise VersionConflict(f"{target} was published by another run") from None


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    where, fs = file_system(spark, path)
    out = fs.create(where, False)
    out.write(bytearray(text.encode()))
    out.close()


def delete(spark: SparkSession, path: str) -> None:
    where, fs = file_system(spark, path)
    fs.delete(where, True)


def history(spark: SparkSession, root: str) -> DataFrame:
    """All published versions; no rows where nothing has been published."""
    where, fs = file_system(spark, f"{root}/manifests")
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, "[0-9]*.json")) if fs.exists(where) else []
    if not len(found):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).json(f"{root}/manifests/[0-9]*.json")


def current(spark: SparkSession, root: str) -> dict | None:
    """The manifest of the newest version."""
    rows = history(spark, root).orderBy(F.col("number").desc()).limit(1).collect()
    return rows[0].asDict(recursive=True) if rows else None


def read(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The table of a version, the newest by default, with its ``split`` column."""
    manifests = history(spark, root)
    if version is not None:
        manifests = manifests.where(F.col("data_version") == version)
    rows = manifests.orderBy(F.col("number").desc()).limit(1).collect()
    if not rows:
        raise LookupError(f"no version {version or ''} under {root}")
    return spark.read.parquet(f"{root}/{rows[0]['path']}")


def splits(spark: SparkSession, root: str, version: str | None = None) -> dict[str, DataFrame]:
    table = read(spark, root, version)
    return {name: table.where(F.col("split") == name).drop("split") for name in ("train", "val", "test")}


def check(table: DataFrame) -> None:
    """What every version must hold: rows with a known split, and no patient or encounter in two of them."""
    shared = retrain.shared_between_splits(table).first()
    unknown = table.where(F.col("split").isNull() | ~F.col("split").isin("train", "val", "test")).limit(1).count()
    if shared["shared_patients"] or shared["shared_encounters"] or unknown:
        raise VersionCheckFailed(f"{shared['shared_patients']} patients and {shared['shared_encounters']} encounters are in several splits, {unknown} rows in none")


def publish(
    table: DataFrame, root: str, params: Params = Params(), raw: DataFrame | None = None,
    before_manifest: Callable[[str], None] | None = None,
) -> dict:
    """Write ``table`` (with ``split``) as the next version and return its manifest.

    The stored copy is checked and hashed, not the plan it came from. If the newest version already has this content,
    its manifest is returned and nothing stays behind. ``before_manifest`` is called with the version before it appears.
    """
    spark = table.sparkSession
    parent = current(spark, root)
    path = f"data/{uuid.uuid4().hex}"
    table.write.mode("errorifexists").partitionBy("split").parquet(f"{root}/{path}")
    stored = spark.read.schema(table.schema).parquet(f"{root}/{path}")
    row = cohort.lineage(stored, params, parent["data_version"] if parent else None, raw).first().asDict(recursive=True)
    if parent and parent["splits"] == row["splits"]:
        delete(spark, f"{root}/{path}")
        return parent
    check(stored)
    number = parent["number"] + 1 if parent else 1
    manifest = {"number": number, **row, "path": path}
    if before_manifest is not None:
        before_manifest(row["data_version"])
    part = f"{root}/manifests/.{uuid.uuid4().hex}"
    _write_text(spark, part, json.dumps(manifest) + "\n")
    rename_new(spark, part, f"{root}/manifests/{number:09d}.json")
    return manifest


def sweep(spark: SparkSession, root: str, older_than_ms: int = 86_400_000) -> int:
    """Remove what unfinished runs left behind for more than ``older_than_ms``; returns how many folders that were."""
    used = {r["path"] for r in history(spark, root).select("path").collect()}
    where, fs = file_system(spark, f"{root}/data")
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    stale = [s.getPath() for s in (fs.listStatus(where) if fs.exists(where) else []) if f"data/{s.getPath().getName()}" not in used and now - s.getModificationTime() >= older_than_ms]
    for path in stale:
        fs.delete(path, True)
    return len(stale)
