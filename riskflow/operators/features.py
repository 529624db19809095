"""Feature derivation, and the fitted transformation that training and scoring share."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.contract import CAT_COLS, CODE_COLS, INPUT_COLS, LAB_COLS, NUM_COLS
from riskflow.functions import (
    age_mid, compute_once, icd9_group, icd9_number, n_med_changes, n_meds_active, specialty_group, total_visits,
)
from riskflow.operators.ranking import quantiles
from riskflow.session import stage

CLIP_LOW, CLIP_HIGH = 0.005, 0.995
MIN_FREQUENCY = 20
#: A feature with more frequent categories is encoded by a join with its vocabulary, one with fewer by a column for each.
JOINED_CATEGORIES = 500


def null_question_marks(df: DataFrame) -> DataFrame:
    """``?`` means missing, in every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("?")) for c in text})


def ensure_inputs(df: DataFrame) -> DataFrame:
    """Add input columns the table lacks, as null."""
    absent = [c for c in INPUT_COLS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def clean(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 27 features in fixed order, after the ``keep`` columns. Narrow: no state, no shuffle.

    First ``?`` is read as null and each diagnosis code is parsed, then everything is derived from that.
    """
    keep = keep or []
    raw = ensure_inputs(df)
    kept = [F.col(f"`{c}`").alias(f"_keep_{c}") for c in keep]
    cells = []
    for c in INPUT_COLS:
        cell = F.col(f"`{c}`")
        if isinstance(raw.schema[c].dataType, T.StringType):
            cell = F.nullif(cell, F.lit("?"))
        if c in LAB_COLS:
            # An empty lab cell means "not tested" in training data, so it does in requests too.
            cell = F.when(F.col(f"`{c}`").isNull(), F.lit("None")).otherwise(cell)
        cells.append(cell.alias(c))
    d = compute_once(raw.select(*kept, *cells), {f"_icd_{i}": icd9_number(f"diag_{i}") for i in (1, 2, 3)})
    derived = {
        "age_num": age_mid("age"),
        "total_visits": total_visits(),
        "n_med_changes": n_med_changes(),
        "n_meds_active": n_meds_active(),
        "medical_specialty": specialty_group(),
        **{f"diag_{i}_grp": icd9_group(f"diag_{i}", F.col(f"_icd_{i}")) for i in (1, 2, 3)},
        **{c: F.col(c).try_cast("bigint") for c in CODE_COLS},
    }
    numbers = [derived.get(c, F.col(c)).try_cast("double") for c in NUM_COLS]
    categories = [derived.get(c, F.col(c)).cast("string") for c in CAT_COLS]
    return d.select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        *[F.nanvl(n, F.lit(None).cast("double")).alias(c) for n, c in zip(numbers, NUM_COLS)],
        *[n.alias(c) for n, c in zip(categories, CAT_COLS)],
    )


def profile(cleaned: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """How often each value of each feature occurs: (by..., feature, num, cat, n).

    One scan and one shuffle serve all 27 features; the rows are combined before the shuffle, so it
    moves distinct values, not encounters. Everything fitted or compared below reads this table.
    """
    entries = []
    for c in NUM_COLS:
        entries += [F.lit(c), F.col(c), F.lit(None).cast("string")]
    for c in CAT_COLS:
        entries += [F.lit(c), F.lit(None).cast("double"), F.col(c)]
    long = cleaned.select(
        *by, F.stack(F.lit(len(NUM_COLS) + len(CAT_COLS)), *entries).alias("feature", "num", "cat")
    )
    return long.groupBy(*by, "feature", "num", "cat").agg(F.count("*").alias("n"))


def _numeric(prof: DataFrame) -> DataFrame:
    return prof.where(F.col("feature").isin(*NUM_COLS)).select("feature", F.col("num").alias("value"), "n")


def medians(prof: DataFrame) -> DataFrame:
    """(feature, median) of the known values."""
    known = _numeric(prof).where(F.col("value").isNotNull())
    return quantiles(known, [0.5], ("feature",)).select("feature", F.col("q")[0].alias("median"))


def _per_feature(values: dict[str, float]) -> Column:
    pairs = [x for name, v in values.items() for x in (F.lit(name), F.lit(v).cast("double"))]
    return F.element_at(F.create_map(*pairs), F.col("feature")) if pairs else F.lit(None).cast("double")


def imputed(prof: DataFrame, median: dict[str, float]) -> DataFrame:
    """Value counts after unknown values took the median."""
    return (
        _numeric(prof).withColumn("value", F.coalesce("value", _per_feature(median)))
        .where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.sum("n").alias("n"))
    )


def clip_bounds(filled: DataFrame) -> DataFrame:
    """(feature, low, high): the 0.5 % and 99.5 % quantiles after imputation."""
    q = quantiles(filled, [CLIP_LOW, CLIP_HIGH], ("feature",))
    return q.select("feature", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def scale_stats(filled: DataFrame, low: dict[str, float], high: dict[str, float]) -> DataFrame:
    """(feature, mean, std) of the clipped values; std of the population, 1 where it is zero."""
    v = F.greatest(F.least(F.col("value"), _per_feature(high)), _per_feature(low))
    mean = F.sum(F.col("v") * F.col("n")) / F.sum("n")
    clipped = filled.withColumn("v", v)
    means = clipped.groupBy("feature").agg(mean.alias("mean"))
    # Squares around the mean, not sum-of-squares minus square-of-sum, which cancels badly.
    square = (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))
    spread = clipped.join(F.broadcast(means), "feature").groupBy("feature", "mean").agg(
        F.sqrt(F.sum(square * F.col("n")) / F.sum("n")).alias("std")
    )
    return spread.select("feature", "mean", F.when(F.col("std") > 0, F.col("std")).otherwise(1.0).alias("std"))


def vocabulary(prof: DataFrame, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """(feature, category, n, frequent) over the training rows; null counts as ``missing``."""
    return (
        prof.where(F.col("feature").isin(*CAT_COLS))
        .groupBy("feature", F.coalesce("cat", F.lit("missing")).alias("category"))
        .agg(F.sum("n").alias("n")).withColumn("frequent", F.col("n") >= min_frequency)
    )


def _rows(df: DataFrame) -> dict[str, tuple]:
    return {r["feature"]: tuple(r)[1:] for r in df.collect()}


def fit_state(prof: DataFrame, min_frequency: int = MIN_FREQUENCY) -> dict:
    """All fitted numbers: a few per numeric feature and the frequent categories of each other one.

    The driver gets one word for each coefficient that a linear model on these features has there anyway; rare categories,
    however many, stay in Spark.
    """
    prof = stage(prof)
    median = {f: r[0] for f, r in _rows(medians(prof)).items()}
    filled = stage(imputed(prof, median))
    bounds = _rows(clip_bounds(filled))
    low = {f: b[0] for f, b in bounds.items()}
    high = {f: b[1] for f, b in bounds.items()}
    scale = _rows(scale_stats(filled, low, high))
    vocab = vocabulary(prof, min_frequency)
    words: dict[str, list[str]] = {c: [] for c in CAT_COLS}
    for r in vocab.where("frequent").select("feature", "category").collect():
        words[r["feature"]].append(r["category"])
    rare = {r["feature"] for r in vocab.where(~F.col("frequent")).select("feature").distinct().collect()}
    return {
        "median": median, "low": low, "high": high,
        "mean": {f: s[0] for f, s in scale.items()}, "std": {f: s[1] for f, s in scale.items()},
        "categories": {c: sorted(words[c]) for c in CAT_COLS},
        "infrequent": {c: c in rare for c in CAT_COLS},
    }


def scaled(cleaned: DataFrame, state: dict, keep: list[str] | None = None) -> DataFrame:
    """The 12 numeric features imputed, clipped and standardised."""
    out = []
    for c in NUM_COLS:
        # A feature without any known training value carries no information.
        if c not in state["median"]:
            out.append(F.lit(0.0).alias(c))
            continue
        filled = F.coalesce(F.col(c), F.lit(state["median"][c]))
        clipped = F.greatest(F.least(filled, F.lit(state["high"][c])), F.lit(state["low"][c]))
        out.append(((clipped - F.lit(state["mean"][c])) / F.lit(state["std"][c])).alias(c))
    return cleaned.select(*(keep or []), *out)


def onehot_names(state: dict, features: list[str] = CAT_COLS) -> list[str]:
    """Names of the indicators: one per frequent category, then one for the rest where training had a rest."""
    return [
        f"{c}={word}" for c in features
        for word in [*state["categories"][c], *(["infrequent"] if state["infrequent"][c] else [])]
    ]


def onehot_columns(state: dict, features: list[str] = CAT_COLS) -> list[tuple[str, Column]]:
    """Indicator columns in the order of ``onehot_names``."""
    out = []
    for c in features:
        value = F.coalesce(F.col(c), F.lit("missing"))
        words = state["categories"][c]
        out += [(value == word).cast("double") for word in words]
        if state["infrequent"][c]:
            rest = ~value.isin(*words) if words else F.lit(True)
            out.append(rest.cast("double"))
    return list(zip(onehot_names(state, features), out))


def joined_categories(df: DataFrame, column: str, words: list[str], rest: bool, out: str) -> DataFrame:
    """Add the sparse indicator vector ``out`` of a feature with a long vocabulary, in the order of ``onehot_names``.

    The place of each value is found by an equi-join, which Spark broadcasts or sorts by the vocabulary's size. Rows keep
    their number: words are distinct. Values outside the vocabulary take the indicator of the rest, or none.
    """
    slots = len(words) + int(rest)
    table = df.sparkSession.createDataFrame(
        pa.table({"_word": pa.array(words, pa.string()), "_place": pa.array(range(len(words)), pa.int32())})
    )
    value = F.coalesce(F.col(f"`{column}`"), F.lit("missing"))
    placed = df.join(table, value == F.col("_word"), "left")
    # The encoder leaves the last place out: that of values without an indicator.
    known = {"ml_attr": {"type": "nominal", "num_vals": slots + 1}}
    place = F.coalesce("_place", F.lit(len(words))).cast("double").alias("_place", metadata=known)
    placed = placed.select(*[F.col(f"`{c}`") for c in df.columns], place)
    return OneHotEncoder(inputCol="_place", outputCol=out, dropLast=True).fit(placed).transform(placed).drop("_place")


class CleanRaw(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``clean`` as a pipeline stage; columns that are not inputs pass through."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean(dataset, keep=[c for c in dataset.columns if c not in INPUT_COLS])


class FeatureModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Applies fitted numbers to cleaned features; output is one vector column."""

    state = Param(Params._dummy(), "state", "fitted numbers as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str = "{}", outputCol: str = "features"):
        super().__init__()
        self._setDefault(state="{}", outputCol="features")
        self._set(**self._input_kwargs)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def feature_names(self) -> list[str]:
        return NUM_COLS + onehot_names(self.fitted())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.fitted()
        out = self.getOrDefault(self.outputCol)
        passed = [c for c in dataset.columns if c not in NUM_COLS + CAT_COLS]
        numeric = scaled(dataset, state, keep=[F.col(f"`{c}`") for c in passed + CAT_COLS])
        joined = [c for c in CAT_COLS if len(state["categories"][c]) > JOINED_CATEGORIES]
        columns = {f"_f{i}": F.col(c) for i, c in enumerate(NUM_COLS)}
        parts = list(columns)
        for c in CAT_COLS:
            if c in joined:
                parts.append(f"_v{c}")
                continue
            for _, indicator in onehot_columns(state, [c]):
                parts.append(f"_f{len(columns)}")
                columns[parts[-1]] = indicator
        wide = numeric.select(
            *[F.col(f"`{c}`") for c in passed], *[v.alias(k) for k, v in columns.items()],
            *[F.col(c).alias(f"_c{c}") for c in joined],
        )
        for c in joined:
            wide = joined_categories(wide, f"_c{c}", state["categories"][c], state["infrequent"][c], f"_v{c}")
        # The assembler stores mostly-zero rows sparsely.
        assembled = VectorAssembler(inputCols=parts, outputCol=out).transform(wide)
        if joined:
            # Without a name for each of very many places in the schema.
            size = {"ml_attr": {"num_attrs": len(NUM_COLS) + len(onehot_names(state))}}
            assembled = assembled.withMetadata(out, size)
        return assembled.select(*[F.col(f"`{c}`") for c in passed], out)


class FeaturePipeline(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits medians, clip bounds, scale and category vocabularies in one pass over cleaned features."""

    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, outputCol: str = "features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FeatureModel:
        state = fit_state(profile(dataset))
        return FeatureModel(state=json.dumps(state), outputCol=self.getOrDefault(self.outputCol))

