"""Deterministic pseudo-random numbers from row values, independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.functions.clinical import col

_MAX32 = 4294967295.0


def _first32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")


def hash_bucket(key: Column | str, seed: int) -> Column:
    """md5 of ``seed-key`` mapped to [0, 1]; the same key always gets the same bucket."""
    return _first32(F.concat(F.lit(f"{seed}-"), col(key).cast("string"))) / F.lit(_MAX32)


def hash_uniform(key: Column | str, name: str, seed: int) -> Column:
    """A uniform number in [0, 1) for one named draw of one row."""
    return _first32(F.concat(F.lit(f"{seed}|{name}|"), col(key).cast("string"))) / F.lit(_MAX32 + 1)


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
