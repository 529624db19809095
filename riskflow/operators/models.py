"""The rule baseline, logistic regression, boosted trees and their calibrated ensemble."""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params as MLParams, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.contract import TARGET
from riskflow.functions import hash_bucket, lace_flag, lace_risk, with_lace
from riskflow.operators import boosting
from riskflow.operators.boosting import Boosting, Codes
from riskflow.operators.features import CleanRaw, FeatureModel, fit_state, imputed, profile
from riskflow.operators.isotonic import curve, isotonic_pools
from riskflow.operators.ranking import value_counts
from riskflow.params import Experiment, Params
from riskflow.session import keep

FOLDS = 3


def lace_transform(df: DataFrame) -> DataFrame:
    """The rule baseline: ``lace`` (0..19), ``score`` (0..1) and ``flag`` (1 from 10 points on)."""
    return with_lace(df).withColumns({
        "score": lace_risk("lace"), "flag": lace_flag("lace")
    })


class LaceModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The rule baseline with the interface of a fitted model."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return lace_transform(dataset).drop("lace", "flag")


class ScoreColumn(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Copies the positive class of a probability vector into one column."""

    inputCol = Param(MLParams._dummy(), "inputCol", "probability vector", TypeConverters.toString)
    outputCol = Param(MLParams._dummy(), "outputCol", "score column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="probability", outputCol="score"):
        super().__init__()
        self._setDefault(inputCol="probability", outputCol="score")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score = vector_to_array(F.col(self.getOrDefault(self.inputCol)))[1]
        return dataset.withColumn(self.getOrDefault(self.outputCol), score)


class BoostedModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Scores cleaned features with boosted trees; several calibrated models are averaged.

    ``model`` is JSON: how features become codes, and for each part its base, trees and calibration curve, if any.
    """

    model = Param(MLParams._dummy(), "model", "codes and parts as JSON", TypeConverters.toString)
    outputCol = Param(MLParams._dummy(), "outputCol", "score column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, model: str = "{}", outputCol: str = "score"):
        super().__init__()
        self._setDefault(model="{}", outputCol="score")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = json.loads(self.getOrDefault(self.model))
        codes = Codes(**fitted["codes"])
        parts = [(p["base"], boosting.load_trees(p), p["curve"]) for p in fitted["parts"]]

        @F.arrow_udf("double")
        def score(*columns: pa.Array) -> pa.Array:
            matrix = codes.of(list(columns))
            total = np.zeros(len(matrix))
            for base, trees, points in parts:
                margin = boosting.margins(matrix, base, trees, codes.ordered)
                total += np.interp(margin, *points) if points else 1.0 / (1.0 + np.exp(-margin))
            return pa.array(total / len(parts))

        return dataset.withColumn(self.getOrDefault(self.outputCol), score(*[F.col(f"`{c}`") for c in codes.names()]))


def class_weights(train: DataFrame) -> tuple[int, DataFrame]:
    """Row count, and the rows with ``weight`` = n / (2 * rows of the class)."""
    counts = {r[TARGET]: r["count"] for r in train.groupBy(TARGET).count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for label, rows in counts.items():
        weight = F.when(F.col(TARGET) == label, n / (2.0 * rows)).otherwise(weight)
    return n, train.withColumn("weight", weight)


@dataclass
class Prepared:
    """The training rows in the two forms that fits read, and what was fitted to get them."""

    features: FeatureModel
    codes: Codes
    vectors: DataFrame
    coded: DataFrame


def fit_features(train: DataFrame) -> Prepared:
    """The fitted transformation, from one profile of the training rows, and these rows as vectors and as codes."""
    cleaned = keep(CleanRaw().transform(train), "cleaned")
    prof = keep(profile(cleaned), "profile")
    state = fit_state(prof)
    model = FeatureModel(state=json.dumps(state))
    codes = boosting.fit_codes(imputed(prof, state["median"]), state)
    vectors = keep(model.transform(cleaned).select("encounter_id", TARGET, "features"), "vectors")
    return Prepared(model, codes, vectors, keep(boosting.coded(cleaned, codes, ["encounter_id", TARGET]), "codes"))


def fit_logistic(vectors: DataFrame, options: dict) -> LogisticRegressionModel:
    """Logistic regression with an L2 penalty of 1 / (2 C) on the summed loss; MLlib's is on the averaged one."""
    n_rows, weighted = class_weights(vectors)
    est = LogisticRegression(
        featuresCol="features", labelCol=TARGET, maxIter=options.get("max_iter", 100), tol=options.get("tol", 1e-6),
        standardization=False, regParam=1.0 / (options.get("C", 1.0) * n_rows))
    return (est.setWeightCol("weight") if options.get("balanced") else est).fit(weighted)


def logistic_gradient(model: LogisticRegressionModel, vectors: DataFrame, options: dict) -> np.ndarray:
    """Derivatives of the penalised mean loss by each coefficient; all near zero where the fit has reached the optimum."""
    n_rows, weighted = class_weights(vectors)
    weight = F.col("weight") if options.get("balanced") else F.lit(1.0)
    scored = model.transform(weighted.withColumn("_w", weight))
    rest = (vector_to_array("probability")[1] - F.col(TARGET)) * F.col("_w")
    # The summarizer takes no negative weights.
    up, down = (Summarizer.sum(F.col("features"), F.greatest(sign * rest, F.lit(0.0))) for sign in (1, -1))
    sums = scored.agg(up.alias("up"), down.alias("down"), F.sum("_w").alias("w")).first()
    return (sums["up"].toArray() - sums["down"].toArray()) / sums["w"] + model.coefficients.toArray() / (options.get("C", 1.0) * n_rows)


def _how(options: dict) -> Boosting:
    names = {"step": "step", "max_iter": "rounds", "leaves": "leaves", "l2": "l2", "min_leaf": "min_leaf"}
    return Boosting(**{names[k]: v for k, v in options.items() if k in names})


def _calibrated(coded: DataFrame, codes: Codes, options: dict, seed: int) -> list[dict]:
    """Three boosted models, each calibrated on the third of the encounters it has not seen.

    The margins of all held-out rows come from one pass, and all three curves from one run of pooling.
    """
    rows = keep(coded.withColumn(
        "fold", F.least(F.floor(hash_bucket("encounter_id", seed + 1) * FOLDS), F.lit(FOLDS - 1)).cast("int")
    ), "folds")

    def fold(i: int) -> dict:
        return boosting.fit(rows.where(F.col("fold") != i).drop("fold"), codes, _how(options), bool(options.get("balanced")), seed)

    with ThreadPoolExecutor(FOLDS) as threads:
        parts = list(threads.map(fold, range(FOLDS)))
    trees = [(p["base"], boosting.load_trees(p)) for p in parts]

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, own = boosting.code_matrix(batch), batch.column("fold").to_numpy()
            out = np.zeros(len(matrix))
            for i, (base, grown) in enumerate(trees):
                out[own == i] = boosting.margins(matrix[own == i], base, grown, codes.ordered)
            yield pa.RecordBatch.from_arrays([batch.column("fold"), pa.array(out), batch.column(TARGET)], names=["by", "margin", TARGET])

    held_out = rows.select("fold", F.col(TARGET).cast("int").alias(TARGET), "codes").mapInArrow(margins, f"by int, margin double, {TARGET} int")
    pools = isotonic_pools(value_counts(held_out, "margin", ("by",), pos=F.col(TARGET))).orderBy("by", "low").collect()
    return [{**p, "curve": curve([r for r in pools if r["by"] == i])} for i, p in enumerate(parts)]


def fit(experiment: Experiment, prepared: Prepared, params: Params = Params()) -> PipelineModel:
    """One experiment as a pipeline from raw encounter columns to ``score``, which can be saved whole."""
    options = dict(experiment.options)
    if experiment.kind == "logreg":
        model = fit_logistic(prepared.vectors, options)
        return PipelineModel([CleanRaw(), prepared.features, model, ScoreColumn()])
    if experiment.kind != "gbt":
        raise ValueError(f"unknown model: {experiment.kind}")
    if options.get("calibrate"):
        parts = _calibrated(prepared.coded, prepared.codes, options, params.seed)
    else:
        one = boosting.fit(prepared.coded, prepared.codes, _how(options), bool(options.get("balanced")), params.seed)
        parts = [{**one, "curve": None}]
    return PipelineModel([CleanRaw(), BoostedModel(model=json.dumps({"codes": asdict(prepared.codes), "parts": parts}))])


def fit_all(experiments: tuple[Experiment, ...], prepared: Prepared, params: Params = Params()) -> dict[str, PipelineModel]:
    """All experiments at once: their fits don't depend on each other, and small ones leave most of a cluster free."""
    with ThreadPoolExecutor(max(1, len(experiments))) as threads:
        return dict(zip([e.name for e in experiments], threads.map(lambda e: fit(e, prepared, params), experiments)))


def model_size_mb(spark: SparkSession, path: str) -> float:
    """Size of a saved model's directory."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return float(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) / 1e6
