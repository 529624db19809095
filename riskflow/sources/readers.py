"""Batch readers. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import contract as C


def _try_cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    casts = [
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
        for f in schema.fields if f.name in df.columns
    ]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()]
    return df.select(*casts, *extra)


def read_encounters_csv(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """The raw encounter table. Only an empty cell is null; an empty lab cell means ``None`` (not tested).

    Cells are read as text by header name, so a file may lack columns or bring others along. With
    ``typed`` unusable numbers become null; leave it off to let the contract check report them.
    """
    text = spark.read.option("header", True).option("nullValue", "").option("inferSchema", False).csv(path)
    labs = {c: F.coalesce(F.col(c), F.lit("None")) for c in C.LAB_COLS if c in text.columns}
    text = text.withColumns(labs)
    return _try_cast_to(text, C.ENCOUNTER_SCHEMA) if typed else text


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One part of a table written by ``write_splits``; only its own directory is listed and read."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def read_splits(
    spark: SparkSession, path: str, extra_train: DataFrame | None = None
) -> dict[str, DataFrame]:
    parts = {name: read_split(spark, path, name) for name in ("train", "val", "test")}
    if extra_train is not None:
        parts["train"] = parts["train"].unionByName(extra_train, allowMissingColumns=True)
    return parts


def _read_json_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        # A log nobody has written to yet is an empty log.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    return _read_json_log(spark, path, C.PREDICTION_LOG_SCHEMA)


def read_label_log(spark: SparkSession, path: str) -> DataFrame:
    return _read_json_log(spark, path, C.LABEL_LOG_SCHEMA)


def read_request_lines(spark: SparkSession, path: str) -> DataFrame:
    """One request per line, still as text, so that absent and null fields can be told apart."""
    return spark.read.text(path).withColumnRenamed("value", "line")
