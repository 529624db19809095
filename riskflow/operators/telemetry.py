"""Request telemetry over time windows: rates, quantiles, sustained alerts and the service report.

Window starts are epoch seconds (``w_start``). Sliding windows are summed in two steps: the log is
first aggregated per step, and only those few sums are copied into the windows that overlap them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.operators.ranking import exact_quantiles
from riskflow.params import Params

# Histogram edges of latency (seconds) and risk score, and the alert limits.
LATENCY_EDGES = [0.005, 0.01, 0.025, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.5]
SCORE_EDGES = [i / 20 for i in range(21)]
RATE_FLOOR = 1e-9
# Alert: (measure, limit, window seconds, seconds it must last).
ALERTS = {
    "latency_p95": (0.3, 300, 120),
    "error_rate": (0.01, 300, 120),
    "invalid_rate": (0.05, 300, 60),
    "follow_up_rate": (0.35, 1800, 600),
}
# Alert: seconds without any request.
SILENT_SECONDS = 30
FLAG_METRICS = ["data_drift", "prediction_drift", "concept_drift"]


def step_start(ts: str, seconds: int) -> Column:
    return (F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds) * seconds).cast("bigint")


def windowed_sums(
    log: DataFrame, sums: dict[str, Column], size: int, step: int | None = None,
    by: tuple[str, ...] = (), ts: str = "ts",
) -> DataFrame:
    """Sums per window of ``size`` seconds starting every ``step`` seconds: (by..., w_start, sums...)."""
    step = step or size
    per_step = log.groupBy(*by, step_start(ts, step).alias("w_start")).agg(
        *[F.sum(c.cast("bigint")).alias(k) for k, c in sums.items()]
    )
    if step == size:
        return per_step
    starts = F.explode(F.sequence(F.col("w_start") - (size - step), F.col("w_start"), F.lit(step).cast("bigint")))
    spread = per_step.select(*by, starts.alias("w_start"), *sums)
    return spread.groupBy(*by, "w_start").agg(*[F.sum(k).alias(k) for k in sums])


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def request_rate(log: DataFrame, by: str = "endpoint", size: int = 60) -> DataFrame:
    """Requests per second by endpoint or status."""
    n = windowed_sums(log, {"n": F.lit(1)}, size, by=(by,))
    return n.select(by, "w_start", "n", (F.col("n") / F.lit(float(size))).alias("per_second"))


def bucket_flags(value: str, edges: list[float]) -> dict[str, Column]:
    counts = {f"_b{i}": flag(F.col(value) <= F.lit(e)) for i, e in enumerate(edges)}
    return {**counts, "n": flag(F.col(value).isNotNull())}


def interpolate(cumulative: Column, total: Column, edges: list[float], q: float) -> Column:
    """Quantile from cumulative bucket counts, linear inside the bucket.

    Beyond the last edge the last edge is returned; a first edge at or below zero is returned as is.
    """
    bounds = F.array(*[F.lit(float(e)) for e in edges])
    rank = total * F.lit(float(q))
    i = F.size(F.filter(cumulative, lambda c: c < rank))
    first = i == 0
    # try_element_at is null outside the array; the branches below keep those out.
    upper = F.try_element_at(bounds, i + 1)
    lower = F.when(first, F.lit(0.0)).otherwise(F.try_element_at(bounds, F.greatest(i, F.lit(1))))
    below = F.when(first, F.lit(0)).otherwise(F.try_element_at(cumulative, F.greatest(i, F.lit(1))))
    inside = F.try_element_at(cumulative, i + 1) - below
    at = lower + (upper - lower) * F.try_divide(rank - below, inside)
    return (
        F.when(total <= 0, F.lit(None).cast("double"))
        .when(i >= len(edges), F.lit(float(edges[-1])))
        .when(first & F.lit(edges[0] <= 0), F.lit(float(edges[0])))
        .otherwise(at)
    )


def histogram_quantile(
    log: DataFrame, value: str, edges: list[float], probs: dict[str, float], size: int,
    step: int | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """Quantiles per window from fixed buckets: (by..., w_start, n, one column per prob)."""
    sums = windowed_sums(log, bucket_flags(value, edges), size, step, by)
    cumulative = F.array(*[F.col(f"_b{i}") for i in range(len(edges))])
    return sums.select(
        *by, "w_start", "n", *[interpolate(cumulative, F.col("n"), edges, q).alias(name) for name, q in probs.items()]
    )


def latency_quantiles(log: DataFrame, size: int = 60, step: int | None = None, endpoint: str = "/predict") -> DataFrame:
    rows = log.where(F.col("endpoint") == endpoint)
    return histogram_quantile(rows, "latency_s", LATENCY_EDGES, {"p50": 0.5, "p95": 0.95}, size, step)


def scored_requests(log: DataFrame) -> DataFrame:
    return log.where(F.col("endpoint").startswith("/predict") & (F.col("status") == 200))


def score_quantiles(log: DataFrame, size: int = 300, step: int = 60) -> DataFrame:
    return histogram_quantile(scored_requests(log), "score", SCORE_EDGES, {"p50": 0.5, "p90": 0.9}, size, step)


def _share(log: DataFrame, condition: Column, name: str, size: int, step: int | None) -> DataFrame:
    sums = windowed_sums(log, {"n": F.lit(1), "hits": flag(condition)}, size, step)
    seconds = F.lit(float(size))
    rate = (F.col("hits") / seconds) / F.greatest(F.col("n") / seconds, F.lit(RATE_FLOOR))
    return sums.select("w_start", "n", "hits", rate.alias(name))


def error_rate(log: DataFrame, size: int = 60, step: int | None = None) -> DataFrame:
    return _share(log, F.col("status") >= 500, "error_rate", size, step)


def invalid_rate(log: DataFrame, size: int = 60, step: int | None = None) -> DataFrame:
    return _share(log, F.col("status") == 422, "invalid_rate", size, step)


def follow_up_rate(log: DataFrame, size: int = 300, step: int | None = 60) -> DataFrame:
    return _share(scored_requests(log), F.col("follow_up"), "follow_up_rate", size, step)


def model_in_use(log: DataFrame, size: int = 3600) -> DataFrame:
    """The model version of the last request in each window; of several at one instant the greatest name."""
    return log.groupBy(step_start("ts", size).alias("w_start")).agg(
        F.max_by("model_version", F.struct("ts", "model_version")).alias("model_version")
    )


def label_counts(labels: DataFrame, size: int = 86400) -> DataFrame:
    rows = labels.withColumn("label", F.col("readmitted_30d").cast("int"))
    return windowed_sums(rows, {"n": F.lit(1)}, size, by=("label",))


def sustained(
    windows: DataFrame, condition: Column, step: int, for_seconds: int, by: tuple[str, ...] = ()
) -> DataFrame:
    """Stretches where ``condition`` holds in consecutive windows for at least ``for_seconds``.

    Rows are windows, not requests, so a series has at most one per step of time; a window without
    requests ends a stretch. Returns (by..., start, end, duration, fires_at).
    """
    true = windows.where(F.coalesce(condition, F.lit(False)))
    order = Window.partitionBy(*by).orderBy("w_start")
    island = F.col("w_start") - F.row_number().over(order) * F.lit(step)
    stretches = true.withColumn("island", island).groupBy(*by, "island").agg(
        F.min("w_start").alias("start"), F.max("w_start").alias("end")
    )
    duration = F.col("end") - F.col("start")
    return stretches.where(duration >= for_seconds).select(
        *by, "start", "end", duration.alias("duration"), (F.col("start") + for_seconds).alias("fires_at")
    )


def silences(
    log: DataFrame, seconds: int = SILENT_SECONDS, since: Column | None = None, until: Column | None = None, ts: str = "ts"
) -> DataFrame:
    """Stretches of ``seconds`` or more without any request: (start, end, duration, fires_at), in epoch seconds.

    ``start`` is the second of the request before, ``end`` that of the one after. Without ``since`` and ``until`` the first
    and last request are the edges; with them the time before and after counts too, and a log without requests is one
    silence. Requests without a time are left out. Two requests in one step of ``seconds`` lie closer together than that, so
    the first and last second of each step are all that is compared: inside a day per day, and between days one row each.
    """
    second = F.unix_seconds(F.col(ts).cast("timestamp")).alias("second")
    times = log.select(second)
    for edge in (since, until):
        if edge is not None:
            # Edges are requests to the search; what lies outside them is cut.
            times = times.unionAll(log.sparkSession.range(1).select(F.unix_seconds(edge.cast("timestamp"))))
    if since is not None:
        times = times.where(F.col("second") >= F.unix_seconds(since.cast("timestamp")))
    if until is not None:
        times = times.where(F.col("second") <= F.unix_seconds(until.cast("timestamp")))
    steps = times.where("second IS NOT NULL").groupBy(F.floor(F.col("second") / seconds).alias("step")).agg(
        F.min("second").alias("first"), F.max("second").alias("last")
    ).withColumn("day", F.floor(F.col("first") / 86400))
    inside = Window.partitionBy("day").orderBy("step")
    per_day = steps.select("day", F.col("last").alias("start"), F.lead("first").over(inside).alias("end"), "first", "last")
    days = per_day.groupBy("day").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    between = days.select(F.col("last").alias("start"), F.lead("first").over(Window.orderBy("day")).alias("end"))
    found = per_day.select("start", "end").unionAll(between).where(F.col("end") - F.col("start") >= seconds)
    return found.select("start", "end", (F.col("end") - F.col("start")).alias("duration"), (F.col("start") + seconds).alias("fires_at"))


def sustained_alerts(log: DataFrame, step: int = 60) -> DataFrame:
    """The four threshold alerts and silence of the service: (alert, start, end, duration, fires_at)."""
    def measure(name: str, size: int) -> DataFrame:
        if name == "latency_p95":
            return latency_quantiles(log, size, step).select("w_start", F.col("p95").alias("value"))
        make = {"error_rate": error_rate, "invalid_rate": invalid_rate, "follow_up_rate": follow_up_rate}[name]
        return make(log, size, step).select("w_start", F.col(name).alias("value"))

    series = None
    for name, (limit, size, _) in ALERTS.items():
        one = measure(name, size).select(
            F.lit(name).alias("alert"), "w_start", (F.col("value") > F.lit(limit)).alias("firing")
        )
        series = one if series is None else series.unionAll(one)
    shortest = sustained(series, F.col("firing"), step, 0, ("alert",)).drop("fires_at")
    lasts = F.element_at(
        F.create_map(*[x for k, v in ALERTS.items() for x in (F.lit(k), F.lit(v[2]))]), F.col("alert")
    )
    over = shortest.where(F.col("duration") >= lasts).withColumn("fires_at", F.col("start") + lasts)
    return over.unionByName(silences(log).withColumn("alert", F.lit("service_silent")))


def gauge_history(snapshots: DataFrame) -> DataFrame:
    """(snapshot_ts, metric, value) over all stored snapshots."""
    from riskflow.operators.monitoring import gauges

    return gauges(snapshots)


def flag_alerts(gauge_rows: DataFrame) -> DataFrame:
    """Drift flags that are up."""
    return gauge_rows.where(F.col("metric").isin(*FLAG_METRICS) & (F.col("value") == 1))


def slo_report(log: DataFrame, params: Params = Params()) -> DataFrame:
    """One row: latency quantiles in ms, throughput, error share, and whether each target is met."""
    q = exact_quantiles(log.select((F.col("latency_s") * 1000).alias("ms")), "ms", [0.5, 0.95, 0.99])
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    row = log.agg(
        F.count("*").alias("requests"), F.avg(F.when(F.col("status") != 200, 1.0).otherwise(0.0)).alias("errors"),
        ((F.max(micros) - F.min(micros)) / 1e6).alias("seconds"),
    ).withColumn("q", q.select("q").scalar())
    rps = F.round(F.try_divide(F.col("requests"), F.col("seconds")), 5)
    row = row.select(
        "requests", *[F.round(F.col("q")[i], 2).alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))],
        rps.alias("throughput_rps"), F.round("errors", 4).alias("error_rate"),
    )
    met = {
        "p50_met": F.col("p50_ms") <= params.slo_p50_ms,
        "p95_met": F.col("p95_ms") <= params.slo_p95_ms,
        "throughput_met": F.col("throughput_rps") >= params.slo_min_rps,
        "errors_met": F.col("error_rate") <= params.slo_error_rate,
    }
    row = row.withColumns(met)
    return row.withColumn("all_met", F.col("p50_met") & F.col("p95_met") & F.col("throughput_met") & F.col("errors_met"))
