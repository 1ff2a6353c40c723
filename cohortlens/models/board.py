"""Spark ML jobs: fits, scoring, calibration, stacking, boards, persistence."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import RFormula, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.evaluation import metrics
from cohortlens.models.fits import together
from cohortlens.operators.assemble import hash_percent
from cohortlens.session import materialise


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def pipeline(features: Sequence[str], estimator: Estimator) -> Pipeline:
    return Pipeline(stages=[assembler(features), estimator])


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balancing weights ``n / (2 n_class)``; two counts come back to the driver."""
    n = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")).first()
    total = n["p"] + n["q"]
    weight = F.when(F.col(label) == 1, total / (2.0 * max(n["p"], 1))).otherwise(total / (2.0 * max(n["q"], 1)))
    return df.withColumn(name, weight)


def balanced_rows(df: DataFrame, label: str, key: str, seed: int = 5454) -> DataFrame:
    """Rows of the smaller class repeated until both classes are about equal, for estimators without weights.

    A row is repeated as often as the whole part of the ratio says, and once more if
    a hash of its key falls below the rest; no row of either class is left out.
    """
    n = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")).first()
    if not n["p"] or not n["q"]:
        return df
    small, ratio = (1, n["q"] / n["p"]) if n["p"] < n["q"] else (0, n["p"] / n["q"])
    more = (hash_percent(key, seed) < F.lit(int(round(100 * (ratio % 1))))).cast("int")
    copies = F.when(F.col(label) == small, F.lit(int(ratio)) + more).otherwise(1)
    repeated = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.drop("_copy")


def score(model: Transformer, df: DataFrame, keys: Sequence[str], label: str | None = None,
          name: str = "p1") -> DataFrame:
    """Keys, label, positive-class probability and hard prediction of every row.

    Keys travel with the row, so nothing is paired by position.
    """
    out = model.transform(df)
    columns = [*keys] + ([label] if label else [])
    return out.select(
        *columns,
        F.get(vector_to_array("probability"), F.lit(1)).alias(name),
        F.col("prediction").cast("int").alias("predict"),
    )


def gbt_from_params(
    params: Mapping[str, object] | str, label: str, seed: int = 23, leave: Sequence[str] = (), weight: str | None = None
) -> GBTClassifier:
    """Boosted trees from a parameter file (JSON text or a dict ``{name: value | {"actual": value}}``).

    ``balance_classes`` needs the name of a ``weight`` column (see ``class_weights``).
    A parameter that Spark has no counterpart for is an error unless it is named in
    ``leave`` or has no value.
    """
    if isinstance(params, str):
        params = json.loads(params)
    read = {k: v["actual"] if isinstance(v, Mapping) else v for k, v in params.items()}
    # file name of a parameter -> Spark ML parameter (fixed correspondence)
    names = {
        "max_depth": "maxDepth", "ntrees": "maxIter", "learn_rate": "stepSize",
        "sample_rate": "subsamplingRate", "min_rows": "minInstancesPerNode",
        "min_split_improvement": "minInfoGain", "nbins": "maxBins",
    }
    known = {names[k]: v for k, v in read.items() if k in names and v is not None}
    if read.get("balance_classes"):
        if weight is None:
            raise ValueError("balance_classes needs a weight column")
        known["weightCol"] = weight
    given = {k for k, v in read.items() if v is not None and v is not False}
    other = sorted(given - set(names) - {"col_sample_rate", "balance_classes"} - set(leave))
    if other:
        raise ValueError(f"no counterpart for {', '.join(other)}")
    for whole in ("maxDepth", "maxIter", "minInstancesPerNode", "maxBins"):
        if whole in known:
            known[whole] = int(known[whole])
    rate = read.get("col_sample_rate")
    if rate is not None:
        known["featureSubsetStrategy"] = "all" if float(rate) >= 1 else str(float(rate))
    return GBTClassifier(labelCol=label, seed=seed).setParams(**known)


def fold_rows(df: DataFrame, key: str, folds: int, seed: int, name: str = "fold") -> DataFrame:
    """The fold of each row by a hash of its key: no key in two folds, and the same rows in every job."""
    return df.withColumn(name, hash_percent(key, seed) % folds)


def expand_grid(
    grid: Mapping[str, tuple[type[Estimator], Mapping, Mapping[str, Sequence]]], label: str, weight: str | None = None
) -> dict[str, Estimator]:
    """One estimator for each combination of the varied parameters, named ``family|parameter=value``.

    A family has a class, its fixed parameters and the values of those that vary.
    """
    out = {}
    columns = {"labelCol": label} | ({"weightCol": weight} if weight else {})
    for family, (kind, fixed, values) in grid.items():
        for cell in product(*values.values()):
            chosen = dict(zip(values, cell, strict=True))
            name = "|".join([family, *[f"{k}={v}" for k, v in chosen.items()]])
            out[name] = kind(**columns, **fixed, **chosen)
    return out


@dataclass
class GridBoard:
    """Metrics of every candidate over all its out-of-fold scores, which are in ``scored``."""

    board: DataFrame
    scored: DataFrame
    candidates: dict[str, Estimator]

    def best(self, family: str) -> Estimator:
        """The candidate of a family with the largest area; the first by name wins a tie."""
        own = self.board.filter(F.substring_index("model_id", "|", 1) == family)
        return self.candidates[own.orderBy(F.desc("auroc"), "model_id").first()["model_id"]]


def grid_board(
    df: DataFrame, features: Sequence[str], label: str, key: str, candidates: Mapping[str, Estimator], folds: int = 3,
    seed: int = 23, threads: int = 4, keep: Sequence[str] = (),
) -> GridBoard:
    """Out-of-fold scores of all candidates, and one board over them.

    Rows are written once with their fold and their assembled vector. Each (candidate, fold) is a job on a filter of
    that table, ``threads`` of them at a time; what they score is one table, and all curves are computed together.
    """
    columns = dict.fromkeys([key, label, *keep, *([w] if (w := "weight") in df.columns else [])])
    rows = materialise(fold_rows(assembler(features).transform(df), key, folds, seed).select(*columns, "features", "fold"), "folds")
    models = together(
        {
            (name, k): lambda e=e, k=k: e.fit(rows.filter(F.col("fold") != k))
            for name, e in candidates.items()
            for k in range(folds)
        },
        threads,
    )
    scored = None
    for (name, k), model in models.items():
        part = score(model, rows.filter(F.col("fold") == k), ["fold", *dict.fromkeys([key, *keep])], label)
        part = part.withColumn("model_id", F.lit(name))
        scored = part if scored is None else scored.unionByName(part)
    scored = materialise(scored, "out_of_fold")
    return GridBoard(metrics.metric_board(scored, "p1", label, "predict", ["model_id"]), scored, dict(candidates))


def logistic(df: DataFrame, formula: str, unseen: str = "error") -> PipelineModel:
    """Unpenalised binomial model by formula; text columns become dummies.

    A level met only at scoring is an error, or with ``unseen="keep"`` a level of its own.
    """
    return Pipeline(
        stages=[
            RFormula(formula=formula, featuresCol="features", labelCol="label", handleInvalid=unseen),
            LogisticRegression(regParam=0.0, featuresCol="features", labelCol="label"),
        ]
    ).fit(df)


def binomial_summary(df: DataFrame, formula: str, unseen: str = "error") -> DataFrame:
    """(term, coefficient, std_error, z, p_value) of the unpenalised binomial model, the intercept last."""
    frame = RFormula(formula=formula, featuresCol="features", labelCol="_label", handleInvalid=unseen).fit(df).transform(df)
    model = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="features", labelCol="_label", maxIter=100, tol=1e-10
    ).fit(frame)
    attributes = frame.schema["features"].metadata["ml_attr"]["attrs"]
    named = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    terms = [name for _, name in named] + ["intercept"]
    values = [*model.coefficients, model.intercept]
    summary = model.summary
    rows = [
        (t, float(v), float(e), float(z), float(p))
        for t, v, e, z, p in zip(
            terms, values, summary.coefficientStandardErrors, summary.tValues, summary.pValues, strict=True
        )
    ]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double, std_error double, z double, p_value double")


def fit_platt(scored: DataFrame, label: str, raw: str = "p1") -> PipelineModel:
    """Sigmoid of the model's score, fitted on the calibration rows."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=[raw], outputCol="_raw"),
            LogisticRegression(featuresCol="_raw", labelCol=label, probabilityCol="_cal",
                               rawPredictionCol="_cal_raw", predictionCol="_cal_hard"),
        ]
    ).fit(scored)


def calibrate(platt: PipelineModel, scored: DataFrame, name: str = "calibrated") -> DataFrame:
    return (
        platt.transform(scored)
        .withColumn(name, F.get(vector_to_array("_cal"), F.lit(1)))
        .drop("_raw", "_cal", "_cal_raw", "_cal_hard")
    )


def contenders(features: Sequence[str], label: str, weight: str | None = "weight", seed: int = 5454,
               trees: int = 20) -> dict[str, Estimator]:
    """Fixed list of contender models."""
    balanced = {"weightCol": weight} if weight else {}
    return {
        "GLM_1": LogisticRegression(labelCol=label, maxIter=50, **balanced),
        "DRF_1": RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=6, seed=seed, **balanced),
        "GBM_1": GBTClassifier(labelCol=label, maxIter=trees, maxDepth=3, seed=seed, **balanced),
        "DeepLearning_1": MultilayerPerceptronClassifier(
            labelCol=label, layers=[len(features), 8, 2], maxIter=50, seed=seed
        ),
    }


def top_learner(names: Sequence[str], label: str, at_least_zero: bool = True) -> LogisticRegression:
    """Unpenalised logistic regression over base scores whose weights are bounded from below by zero.

    A base that would get a negative weight is left out of the sum with weight 0; the intercept is free.
    """
    top = LogisticRegression(labelCol=label, family="binomial", tol=1e-10, maxIter=500)
    if at_least_zero:
        top = top.setLowerBoundsOnCoefficients(Matrices.dense(1, len(names), [0.0] * len(names)))
    return top


class Stack:
    """Logistic regression over out-of-fold base scores."""

    def __init__(self, bases: dict[str, PipelineModel], top: PipelineModel):
        self.bases, self.top = bases, top

    def score(self, df: DataFrame, keys: Sequence[str], label: str | None = None) -> DataFrame:
        for name, model in self.bases.items():
            df = _base_column(model, df, name)
        return score(self.top, df, keys, label)

    def weights(self, spark: SparkSession) -> DataFrame:
        """(base, weight) rows, the intercept last."""
        top = self.top.stages[-1]
        values = [*zip(self.bases, top.coefficients, strict=True), ("intercept", top.intercept)]
        return spark.createDataFrame([(n, float(v)) for n, v in values], "base string, weight double")


def _base_column(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    out = model.transform(df)
    return out.select(*df.columns, F.get(vector_to_array("probability"), F.lit(1)).alias(f"base_{name}"))


def fit_stack(
    df: DataFrame, features: Sequence[str], label: str, estimators: Mapping[str, Estimator],
    fold_key: str, folds: int = 3, seed: int = 5454, threads: int = 4, at_least_zero: bool = True,
) -> Stack:
    """Folds by hash of ``fold_key``; the base models are refitted on all rows for scoring. Fits run side by side.

    The weights of the bases are at least zero unless ``at_least_zero`` is off.
    """
    rows = materialise(fold_rows(df, fold_key, folds, seed, "_fold"), "stack_rows")
    fits = together(
        {
            (k, name): lambda k=k, e=e: pipeline(features, e).fit(rows if k is None else rows.filter(F.col("_fold") != k))
            for k in (*range(folds), None)
            for name, e in estimators.items()
        },
        threads,
    )
    scored = None
    for k in range(folds):
        held = rows.filter(F.col("_fold") == k)
        for name in estimators:
            held = _base_column(fits[k, name], held, name)
        scored = held if scored is None else scored.unionByName(held)
    names = [f"base_{n}" for n in estimators]
    top = pipeline(names, top_learner(names, label, at_least_zero)).fit(materialise(scored, "stack"))
    return Stack({n: fits[None, n] for n in estimators}, top)


def leaderboard(
    models: Mapping[str, object], frames: Mapping[str, DataFrame], keys: Sequence[str], label: str
) -> DataFrame:
    """Metrics of every model on every frame (validation, test), one row per model, best AUC first.

    Each frame is scored once per model; all curves are computed together.
    """
    scored = None
    for model_id, model in models.items():
        for frame, df in frames.items():
            rows = model.score(df, keys, label) if isinstance(model, Stack) else score(model, df, keys, label)
            rows = rows.withColumns({"model_id": F.lit(model_id), "frame": F.lit(frame)})
            scored = rows if scored is None else scored.unionByName(rows)
    board = metrics.metric_board(
        materialise(scored, "scored"), "p1", label, "predict", ["model_id", "frame"]
    )
    first = next(iter(frames))
    columns = ["auroc", "f1", "recall", "precision", "logloss", "accuracy", "tn", "fp", "fn", "tp", "auprc"]
    wide = board.groupBy("model_id").agg(
        *[F.max(F.when(F.col("frame") == f, F.col(c))).alias(f"{f}_{c}") for f in frames for c in columns]
    )
    return wide.withColumn("model_type", metrics.model_type()).orderBy(F.desc(f"{first}_auroc"), "model_id")


def feature_importance(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Importance per feature of a tree model, or absolute coefficient of a linear one."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else [abs(v) for v in last.coefficients]
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame([(f, float(values[i])) for i, f in enumerate(features)], schema)


def save_models(models: Mapping[str, PipelineModel], path: str) -> None:
    for name, model in models.items():
        model.write().overwrite().save(f"{path}/{name}")


def load_models(spark: SparkSession, path: str) -> dict[str, PipelineModel]:
    """Every model saved under ``path``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in system.listStatus(folder) if s.isDirectory())
    return {n: PipelineModel.load(f"{path}/{n}") for n in names}
