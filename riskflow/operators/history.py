"""Earlier and next visits of each patient, also for a patient with very many visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.operators.ranking import cut_ranges, join_ranges

SINGLE_TASK_ROWS = 1_000_000


def most_visits(df: DataFrame, patient: str) -> int:
    return df.groupBy(patient).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def visit_sequence(
    df: DataFrame, patient: str, ts: str, tie: str, max_rows: int = SINGLE_TASK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Add ``seq`` (1 for a patient's first visit) and ``next_ts`` (null for the last one).

    A patient with at most ``max_rows`` visits is ordered by one task. Beyond that all visits are cut into
    ranges of patient, time and ``tie``, within a day too; each range is ordered by itself and continues
    from the patient's earlier ranges. ``largest`` is the visit count of the busiest patient, measured
    unless given.
    """
    if largest is None:
        largest = most_visits(df, patient)
    if largest <= max_rows:
        w = Window.partitionBy(patient).orderBy(ts, tie)
        return df.withColumns({"seq": F.row_number().over(w), "next_ts": F.lead(ts).over(w)})

    rows = df.count()
    ranged, _ = cut_ranges(df, [F.col(c) for c in (patient, ts, tie)], rows, max_rows, "_range")
    inside = Window.partitionBy(patient, "_range").orderBy(ts, tie)
    ordered = ranged.withColumns({"_in": F.row_number().over(inside), "_next": F.lead(ts).over(inside)})
    parts = ranged.groupBy(patient, "_range").agg(F.count("*").alias("_n"), F.min(ts).alias("_first"))
    # A patient has at most as many parts as there are ranges.
    by_range = Window.partitionBy(patient).orderBy("_range")
    parts = parts.select(
        patient, "_range", F.lead("_first").over(by_range).alias("_after"),
        F.coalesce(F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    return join_ranges(ordered, parts, [patient], "_range", rows).select(
        *df.columns,
        (F.col("_before") + F.col("_in")).cast("int").alias("seq"),
        F.coalesce("_next", "_after").alias("next_ts"),
    )
