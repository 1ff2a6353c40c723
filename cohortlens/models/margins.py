"""Margin classifier (squared hinge loss) whose probabilities come from margins that no fitted row has seen."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.models.board import fold_rows
from cohortlens.session import materialise

#: The fit that leaves no fold out.
ALL = -1
SPREAD = 8


@dataclass
class MarginModel:
    """Weights with the intercept last, and the sigmoid ``1 / (1 + exp(-(slope * margin + shift)))`` of the margins."""

    weights: np.ndarray
    slope: float
    shift: float
    converged: bool = True

    @property
    def coefficients(self) -> DenseVector:
        """Weights of the log odds, which are linear in the features."""
        return Vectors.dense(self.slope * self.weights[:-1])

    @property
    def intercept(self) -> float:
        return float(self.slope * self.weights[-1] + self.shift)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``margin``, ``probability`` (a vector, class 1 last) and ``prediction`` (1 above margin 0).

        All three are null where a feature is missing.
        """
        out = df.withColumn("margin", margins(vector_to_array("features"), F.lit(ALL), {ALL: self.weights}))
        p = 1 / (1 + F.exp(-(self.slope * F.col("margin") + self.shift)))
        known = F.col("margin").isNotNull()
        return out.withColumn("probability", F.when(known, array_to_vector(F.array(1 - p, p)))).withColumn(
            "prediction", F.when(known, (F.col("margin") > 0).cast("double"))
        )


def margins(features: Column, fit: Column, weights: dict[int, np.ndarray]) -> Column:
    """Margin of each row by the weights of its ``fit``; null where a feature is missing."""
    place = {k: i for i, k in enumerate(weights)}
    matrix = np.array(list(weights.values()))

    @F.pandas_udf("double")
    def product(x: pd.Series, k: pd.Series) -> pd.Series:
        values = np.array(x.tolist(), dtype=float).reshape(len(x), -1)
        own = matrix[[place[int(i)] for i in k]]
        out = (values * own[:, :-1]).sum(axis=1) + own[:, -1]
        return pd.Series(out).where(~np.isnan(out), None)

    return product(features, fit)


def _sums(rows: DataFrame, trials: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Loss, gradient and curvature of every fit at its trial weights, from one pass over the rows.

    Each task adds up its rows by matrix products; the parts of a fit meet in ``SPREAD`` tasks, and that many rows for
    each fit reach the driver.
    """
    fits = list(trials)
    weights = np.array([trials[k] for k in fits]).T
    size = len(weights)
    schema = "_fit int, _salt int, _sums array<double>"

    def table(keys, sums) -> pa.RecordBatch:
        lists = pa.array([v.tolist() for v in sums], pa.list_(pa.float64()))
        fit, salt = (pa.array([k[i] for k in keys], pa.int32()) for i in (0, 1))
        return pa.RecordBatch.from_arrays([fit, salt, lists], ["_fit", "_salt", "_sums"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, salt = {}, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            fold, y, salt = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            salt = int(salt[0])
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            x = np.hstack([x, np.ones((len(y), 1))])
            short = 1 - y[:, None] * (x @ weights)
            for i, k in enumerate(fits):
                inside = (fold != k) & (short[:, i] > 0)
                v, gap = x[inside], short[inside, i]
                part = np.concatenate([[gap @ gap], -2 * (y[inside] * gap) @ v, 2 * (v.T @ v).ravel()])
                sums[k] = sums.get(k, 0.0) + part
        yield table([(k, salt) for k in sums], sums.values())

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for k, s, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                sums[k, s] = sums.get((k, s), 0.0) + part.values.to_numpy()
        yield table(list(sums), sums.values())

    salted = rows.select("fold", "_y", (F.spark_partition_id() % SPREAD).alias("_salt"), "_x")
    parts = salted.mapInArrow(add_up, schema).repartition("_fit", "_salt").mapInArrow(finish, schema)
    out = {k: np.zeros(1 + size + size * size) for k in fits}
    for row in parts.collect():  # SPREAD rows for each fit
        out[row["_fit"]] += np.array(row["_sums"])
    return {k: (v[0], v[1 : 1 + size], v[1 + size :].reshape(size, size)) for k, v in out.items()}


def fit_margins(
    rows: DataFrame, fits: list[int], size: int, penalty: float | None, steps: int = 50, tolerance: float = 1e-10
) -> tuple[dict[int, np.ndarray], dict[int, bool]]:
    """Newton steps with halving for all ``fits`` in the same pass; fit k leaves out the rows of fold k.

    Minimises the sum of ``max(0, 1 - y margin)^2`` plus ``|w|^2 / (2 penalty)``; the intercept is free of the penalty.
    The loss is quadratic between the places where rows leave or enter it, so steps end exactly.
    """
    ridge = np.zeros(size + 1)
    ridge[:-1] = 0.0 if penalty is None else 1.0 / penalty
    best = {k: (np.inf, np.zeros(size + 1)) for k in fits}
    trial, direction = {k: np.zeros(size + 1) for k in fits}, {}
    still = set(fits)
    for _ in range(steps):
        for k, (loss, slope, curve) in _sums(rows, {k: trial[k] for k in sorted(still)}).items():
            value, before = loss + 0.5 * ridge @ trial[k] ** 2, best[k][0]
            if value > before + 1e-12 * abs(before):
                direction[k] = direction[k] / 2
                trial[k] = best[k][1] + direction[k]
                if np.max(np.abs(direction[k])) < 1e-12:
                    still.discard(k)
                continue
            best[k] = (value, trial[k])
            if np.isfinite(before) and before - value <= tolerance * abs(before):
                still.discard(k)
                continue
            inverse = np.linalg.pinv(curve + np.diag(ridge), rcond=1e-10, hermitian=True)
            direction[k] = -inverse @ (slope + ridge * trial[k])
            trial[k] = best[k][1] + direction[k]
        if not still:
            break
    if still:
        warnings.warn(f"not converged after {steps} steps: {sorted(still)}", stacklevel=2)
    return {k: w for k, (_, w) in best.items()}, {k: k not in still for k in fits}


def fit_sigmoid(scored: DataFrame, label: str, margin: str = "margin") -> tuple[float, float]:
    """Slope and shift by Platt's rule: targets are drawn in from 0 and 1 by one row of each class.

    A row counts as both classes with the weights of its target, so that Spark's logistic regression fits it. Rows
    without margin are left out; without any the sigmoid is 1 / (1 + exp(-margin)).
    """
    scored = scored.filter(F.col(margin).isNotNull())
    n = scored.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")).first()
    if not n["p"] + n["q"]:
        return 1.0, 0.0
    target = F.when(F.col(label) == 1, (n["p"] + 1) / (n["p"] + 2)).otherwise(1 / (n["q"] + 2))
    both = F.array(*[F.struct(F.lit(y).alias("_y"), w.alias("_w")) for y, w in ((1.0, target), (0.0, 1 - target))])
    long = VectorAssembler(inputCols=[margin], outputCol="_margin").transform(scored).select("_margin", F.inline(both))
    top = LogisticRegression(featuresCol="_margin", labelCol="_y", weightCol="_w", tol=1e-10, maxIter=200).fit(long)
    return float(top.coefficients[0]), float(top.intercept)


@dataclass
class MarginClassifier:
    """Estimator for rows with a vector ``features`` and a 0/1 ``label``; its fit has ``transform`` like a Spark model.

    Folds are drawn by a hash of ``key``; the fits of the folds and that of all rows share their passes. The sigmoid is
    fitted on margins that each come from the fit that has not seen the row. ``penalty`` is the cost of a row's loss
    against the squared weights; None is no penalty. Rows with another label or a missing feature are left out.
    """

    label: str
    key: str
    penalty: float | None = 10.0
    folds: int = 5
    seed: int = 626
    steps: int = 50

    def fit(self, df: DataFrame) -> MarginModel:
        rows, weights, converged = self.fold_weights(df)
        if rows is None:
            return MarginModel(weights[ALL], 1.0, 0.0)
        held = self.held_out(rows, weights)
        return MarginModel(weights[ALL], *fit_sigmoid(held, self.label), converged=converged[ALL])

    def fold_weights(self, df: DataFrame) -> tuple[DataFrame | None, dict[int, np.ndarray], dict[int, bool]]:
        """Written rows with their fold, and the weights of every fit; without rows all weights are zero."""
        first = df.select("features").filter("features IS NOT NULL").first()
        if first is None:
            return None, {ALL: np.zeros(1)}, {ALL: True}
        x, size = vector_to_array("features"), len(first["features"])
        whole = F.col("features").isNotNull() & ~F.exists(x, F.isnan)
        rows = df.filter(F.col(self.label).isin(0, 1) & whole).select(F.col(self.key).alias("_key"), self.label, x.alias("_x"))
        rows = rows.withColumn("_y", 2.0 * F.col(self.label) - 1)
        rows = materialise(fold_rows(rows, "_key", self.folds, self.seed).withColumn("fold", F.col("fold").cast("int")), "margin_folds")
        weights, converged = fit_margins(rows, [*range(self.folds), ALL], size, self.penalty, self.steps)
        return rows, weights, converged

    def held_out(self, rows: DataFrame, weights: dict[int, np.ndarray]) -> DataFrame:
        """Label, fold and margin of every row by the fit that left it out."""
        scored = rows.select("_key", self.label, "fold", margins(F.col("_x"), F.col("fold"), weights).alias("margin"))
        return materialise(scored, "held_margins")
