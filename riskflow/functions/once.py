"""Columns that are computed once, however many later expressions read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``columns`` as the output of a one-row generator instead of a projection.

    The optimizer copies projected expressions into filters above them, and into every expression that
    mentions them. For a parsed value that a long CASE reads dozens of times this multiplies the
    work; generated columns are never copied. The plan stays narrow and inside generated code.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
