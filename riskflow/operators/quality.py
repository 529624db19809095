"""The data contract: per-cell violations, dataset checks, validation and request quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import contract as C
from riskflow.contract import ColumnRule
from riskflow.functions import compute_once
from riskflow.params import Params
from riskflow.session import stage

EXAMPLES = 5
_ISSUE = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("value", T.StringType()),
])


class DataValidationError(RuntimeError):
    pass


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _cell_check(rule: ColumnRule, cell: Column, text: bool, whole_floats: bool) -> Column:
    """Name of the check this cell fails, null when it passes all of them."""
    check = F.when(cell.isNull(), F.lit(None if rule.nullable else "not_null"))
    value = cell
    if rule.type != "string":
        if text:
            number = F.regexp_replace(cell, r"\.0+$", "") if whole_floats else cell
            value = number.try_cast(rule.type)
        check = check.when(value.isNull(), F.lit("type"))
    if rule.low is not None:
        outside = value < rule.low
        if rule.high is not None:
            outside = outside | (value > rule.high)
        check = check.when(outside, F.lit("range"))
    if rule.domain is not None:
        check = check.when(~value.isin(*rule.domain), F.lit("domain"))
    return check


def violations(df: DataFrame, rules: list[ColumnRule], whole_floats: bool = False) -> Column:
    """All failed cells of a row as ``array<struct<column, check, value>>``. No shuffle.

    Built by concatenation rather than by filtering an array, which Spark would interpret row by row.
    """
    cells = [F.array().cast(T.ArrayType(_ISSUE))]
    for rule in rules:
        if rule.name not in df.columns:
            continue
        cell = F.col(f"`{rule.name}`")
        check = _cell_check(rule, cell, _is_text(df, rule.name), whole_floats)
        issue = F.struct(
            F.lit(rule.name).alias("column"), check.alias("check"), cell.cast("string").alias("value")
        ).cast(_ISSUE)
        cells.append(F.when(check.isNull(), cells[0]).otherwise(F.array(issue)))
    return F.concat(*cells)


def missing_columns(df: DataFrame, rules: list[ColumnRule]) -> list[str]:
    return [r.name for r in rules if r.name not in df.columns]


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows (all of which are failures)."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )


def failed_values(df: DataFrame, rules: list[ColumnRule] = C.DATASET_RULES) -> DataFrame:
    """(column, check, value, n) for every failing value."""
    cells = df.select(F.explode(violations(df, rules)).alias("v")).select("v.*")
    failed = cells.groupBy("column", "check", "value").agg(F.count("*").alias("n"))
    for rule in rules:
        if rule.unique and rule.name in df.columns:
            failed = failed.unionByName(duplicate_values(df, rule.name).select(
                F.lit(rule.name).alias("column"), F.lit("unique").alias("check"),
                F.col(rule.name).cast("string").alias("value"), "n",
            ))
    return failed


def violation_report(df: DataFrame, rules: list[ColumnRule] = C.DATASET_RULES) -> DataFrame:
    """Failures per (column, check) with up to five distinct example values, smallest first."""
    failed = stage(failed_values(df, rules))
    totals = failed.groupBy("column", "check").agg(F.sum("n").alias("n_failures"))
    first = Window.partitionBy("column", "check").orderBy("value")
    # Spark keeps only the first five per task before it shuffles for this filter.
    examples = (
        failed.where(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= EXAMPLES)
        .groupBy("column", "check").agg(F.sort_array(F.collect_list("value")).alias("examples"))
    )
    return totals.join(examples, ["column", "check"], "left").select(
        "column", "check", "n_failures", F.coalesce("examples", F.array().cast("array<string>")).alias("examples")
    )


def _missing(df: DataFrame, name: str) -> Column:
    cell = F.col(f"`{name}`")
    missing = cell.isNull() | (cell == "?") if _is_text(df, name) else cell.isNull()
    return F.try_divide(F.count_if(missing), F.count("*"))


def missing_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Share of ``?`` or null per contract column, in one pass: (column, missing_rate)."""
    cols = columns or [r.name for r in C.DATASET_RULES if r.name in df.columns]
    return df.agg(*[_missing(df, c).alias(c) for c in cols]).unpivot([], cols, "column", "missing_rate")


def label_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.avg(F.when(F.col("readmitted") == "<30", 1.0).otherwise(0.0)).alias("label_rate"))


def dataset_checks(df: DataFrame, params: Params = Params(), min_rows: int | None = None) -> DataFrame:
    """Row count, missing rates and label rate in one pass: (check, column, value, passed)."""
    least = params.min_rows if min_rows is None else min_rows
    cols = [r.name for r in C.DATASET_RULES if r.name in df.columns]
    aggs = [F.count("*").cast("double").alias("_rows"), *[_missing(df, c).alias(c) for c in cols]]
    checks = [("min_rows", None, F.col("_rows"), F.col("_rows") >= least)]
    checks += [
        ("missing_rate", c, F.col(f"`{c}`"), F.coalesce(F.col(f"`{c}`") <= params.max_missing_rate, F.lit(True)))
        for c in cols
    ]
    if "readmitted" in df.columns:
        aggs.append(F.avg(F.when(F.col("readmitted") == "<30", 1.0).otherwise(0.0)).alias("_label"))
        inside = F.col("_label").between(params.min_label_rate, params.max_label_rate)
        checks.append(("label_rate", None, F.col("_label"), F.coalesce(inside, F.lit(True))))
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                 value.alias("value"), passed.alias("passed"))
        for check, column, value, passed in checks
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class ValidationReport:
    n_rows: int
    n_issues: int
    passed: bool
    issues: DataFrame


def validation_issues(df: DataFrame, params: Params = Params(), min_rows: int | None = None) -> DataFrame:
    """Everything wrong with the table: (type, column, check, n_failures, examples, value)."""
    spark = df.sparkSession
    schema = violation_report(df).select(
        F.lit("schema").alias("type"), "column", "check", "n_failures", "examples",
        F.lit(None).cast("double").alias("value"),
    )
    dataset = dataset_checks(df, params, min_rows).where(~F.col("passed")).select(
        F.lit("dataset").alias("type"), "column", "check", F.lit(None).cast("bigint").alias("n_failures"),
        F.lit(None).cast("array<string>").alias("examples"), "value",
    )
    absent = spark.createDataFrame(
        [("schema", c, "column_in_dataframe", 1, None, None) for c in missing_columns(df, C.DATASET_RULES)],
        "type string, column string, check string, n_failures bigint, examples array<string>, value double",
    )
    return schema.unionByName(dataset).unionByName(absent)


def validate(
    df: DataFrame, params: Params = Params(), min_rows: int | None = None, raise_on_error: bool = True
) -> ValidationReport:
    """Check a table; the issue list has at most a few rows per contract column."""
    issues = stage(validation_issues(df, params, min_rows))
    n_issues = issues.count()
    report = ValidationReport(df.count(), n_issues, n_issues == 0, issues)
    if n_issues and raise_on_error:
        raise DataValidationError(f"{n_issues} data issue(s)")
    return report


REPORT_SCHEMA = (
    "n_rows bigint, n_issues bigint, passed boolean, "
    "issues array<struct<type:string,column:string,check:string,n_failures:bigint,examples:array<string>,value:double>>"
)


def report_rows(report: ValidationReport) -> DataFrame:
    """The report as one row: n_rows, n_issues, passed and the issues."""
    issue = F.struct("type", "column", "check", "n_failures", "examples", "value")
    return report.issues.agg(F.sort_array(F.collect_list(issue)).alias("issues")).select(
        F.lit(report.n_rows).cast("bigint").alias("n_rows"), F.lit(report.n_issues).cast("bigint").alias("n_issues"),
        F.lit(report.passed).alias("passed"), "issues",
    )


def describe(issues: DataFrame, most: int = 10) -> str:
    """The first issues in words, for an error message."""
    rows = issues.orderBy("type", "column", "check").limit(most).collect()
    return "; ".join(f"{r['column'] or 'table'}: {r['check']}" + (f" ({r['n_failures']} rows)" if r["n_failures"] else "") for r in rows)


def parse_requests(lines: DataFrame, line: str = "line") -> DataFrame:
    """Request fields as text, defaults filled in, with ``violations``; other columns pass through.

    Defaults apply to absent fields only. A null lab value is read as ``None`` (not tested), the way
    the training table is read.
    """
    spaced = {r.name: r.name.replace("-", "_") for r in C.REQUEST_RULES if "-" in r.name}
    text = T.StructType(C.REQUEST_TEXT_SCHEMA.fields + [T.StructField(n, T.StringType()) for n in spaced.values()])
    parsed = compute_once(lines, {
        "_request": F.from_json(line, text), "_keys": F.json_object_keys(line),
    })
    fields = []
    for rule in C.REQUEST_RULES:
        value = F.col(f"_request.`{rule.name}`")
        absent = ~F.array_contains("_keys", rule.name)
        if rule.name in spaced:
            value = F.coalesce(value, F.col(f"_request.`{spaced[rule.name]}`"))
            absent = absent & ~F.array_contains("_keys", spaced[rule.name])
        if rule.has_default and rule.default is not None:
            when = value.isNull() if rule.name in C.LAB_COLS else value.isNull() & absent
            value = F.when(when, F.lit(rule.default)).otherwise(value)
        fields.append(value.alias(rule.name))
    keep = [F.col(f"`{c}`") for c in lines.columns if c not in C.REQUEST_TEXT_SCHEMA.fieldNames()]
    rows = parsed.select(*keep, *fields, F.col("_keys").isNull().alias("_broken"))
    broken = F.array(F.struct(
        F.lit(None).cast("string").alias("column"), F.lit("json").alias("check"), F.col(line).alias("value")
    ))
    checked = F.when(F.col("_broken"), broken).otherwise(violations(rows, C.REQUEST_RULES, whole_floats=True))
    # Callers filter on the violations and read them: both must see one computation.
    return compute_once(rows, {"violations": checked}).drop("_broken")


def accepted(parsed: DataFrame) -> DataFrame:
    """Requests without violations, typed and ready for scoring."""
    typed = [
        F.regexp_replace(F.col(f"`{r.name}`"), r"\.0+$", "").try_cast("bigint").alias(r.name)
        if r.type == "bigint" else F.col(f"`{r.name}`")
        for r in C.REQUEST_RULES
    ]
    names = {r.name for r in C.REQUEST_RULES} | {"violations", "line"}
    extra = [F.col(f"`{c}`") for c in parsed.columns if c not in names]
    return parsed.where(F.size("violations") == 0).select(*extra, *typed)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Rejected requests, whole, with the reasons."""
    names = {r.name for r in C.REQUEST_RULES}
    return parsed.where(F.size("violations") > 0).select(
        *[F.col(f"`{c}`") for c in parsed.columns if c not in names]
    )


def valid_labels(labels: DataFrame) -> DataFrame:
    """Feedback records with a positive id and a boolean outcome."""
    return labels.where(F.size(violations(labels, C.LABEL_RULES)) == 0)
