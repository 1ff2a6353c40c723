"""Margin classifier, bounded stack weights and errors by entity against plain code."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_models import cox_data

from cohortlens.models import board, cox, margins, pu


def noisy(spark, n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = (x @ [1.5, -0.7] + rng.normal(size=n) > 0).astype(int)
    return spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(n)], "id long, y int, a double, b double")


def loss_slope(x, y, w, penalty):
    """Gradient of the penalised squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1))])
    gap = np.maximum(0, 1 - y * (x @ w))
    return -2 * (y * gap) @ x + np.append(w[:-1] / penalty, 0)


def test_every_fit_is_a_minimum(spark):
    df = noisy(spark)
    classifier = margins.MarginClassifier("y", "id", penalty=0.5, folds=3)
    rows, weights, converged = classifier.fold_weights(board.assembler(["a", "b"]).transform(df))
    got = rows.select("_key", "_x", "_y", "fold").collect()
    x, y, fold = np.array([r._x for r in got]), np.array([r._y for r in got]), np.array([r.fold for r in got])
    assert all(converged.values()) and set(weights) == {-1, 0, 1, 2}
    for k, w in weights.items():
        assert np.abs(loss_slope(x[fold != k], y[fold != k], w, 0.5)).max() < 1e-6


def test_sigmoid_has_no_slope_left(spark):
    df = board.assembler(["a", "b"]).transform(noisy(spark))
    classifier = margins.MarginClassifier("y", "id", folds=3)
    rows, weights, _ = classifier.fold_weights(df)
    held = classifier.held_out(rows, weights)
    slope, shift = margins.fit_sigmoid(held, "y")
    m, y = (np.array(v, float) for v in zip(*held.select("margin", "y").collect()))
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    gap = target - 1 / (1 + np.exp(-(slope * m + shift)))
    assert abs(gap.sum()) < 1e-3 and abs(gap @ m) < 1e-3
    model = classifier.fit(df)
    p = [r[0] for r in model.transform(df).select(vector_to_array("probability")[1]).collect()]
    x = np.array([r.features.toArray() for r in df.select("features").collect()])
    assert np.allclose(p, 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept))))


def test_margins_without_rows_labels_or_values(spark):
    df = noisy(spark, 60)
    classifier = margins.MarginClassifier("y", "id", folds=2)
    empty = classifier.fit(board.assembler(["a", "b"]).transform(df.limit(0)))
    assert empty.transform(board.assembler(["a", "b"]).transform(df.limit(0))).count() == 0
    broken = df.withColumn("a", F.when(F.col("id") > 0, F.col("a"))).withColumn("y", F.when(F.col("id") != 5, F.col("y")))
    rows = board.assembler(["a", "b"]).transform(broken)
    got = {r.id: r for r in classifier.fit(rows).transform(rows).collect()}
    assert len(got) == 60 and got[0].margin is None and got[0].probability is None and got[0].prediction is None
    assert got[5].margin is not None
    one_class = rows.withColumn("y", F.lit(1))
    assert all(r.probability is None or r.probability[1] > 0.5 for r in classifier.fit(one_class).transform(one_class).collect())


def test_margins_under_the_hold_out_constant(spark):
    df = noisy(spark).withColumn("shown", F.when(F.col("id") % 3 > 0, F.col("y")).otherwise(0))
    rows = pu.fourier_features(df, ["a", "b"], 0.4, 32)
    model = pu.fit_pu(rows, ["a", "b"], "shown", "id", margins.MarginClassifier("shown", "id", folds=3), dimension=32)
    scored = model.transform(rows).groupBy("y").agg(F.avg("pu_score").alias("s"))
    means = {r.y: r.s for r in scored.collect()}
    assert 0 < model.c <= 1 and means[1] > means[0] + 0.3


def test_stack_weights_are_not_negative(spark):
    df = noisy(spark).withColumn("c", -F.col("a"))
    bases = {"good": LogisticRegression(labelCol="y"), "bad": LogisticRegression(labelCol="y", maxIter=0)}
    stack = board.fit_stack(df, ["a", "b"], "y", bases, "id", folds=2)
    got = {r.base: r.weight for r in stack.weights(spark).collect()}
    assert list(got) == ["good", "bad", "intercept"] and got["good"] > 0 and got["bad"] >= 0
    names = ["a", "c", "b"]
    bounded = board.pipeline(names, board.top_learner(names, "y")).fit(df).stages[-1].coefficients
    assert bounded[0] > 0.5 and abs(bounded[1]) < 1e-9 and abs(bounded[2]) < 1e-9
    free = board.pipeline(["b"], board.top_learner(["b"], "y", at_least_zero=False)).fit(df).stages[-1].coefficients
    assert free[0] < 0


@pytest.mark.parametrize("columns", [["x1", "x2"], ["x1", "x2", "same"]])
def test_errors_by_entity_equal_numpy(spark, columns):
    data = cox_data()
    schema = "ent long, tstart int, tstop int, label int, x1 double, x2 double, same double"
    df = spark.createDataFrame(data, schema).withColumn("test_dt", F.lit("t"))
    model = cox.fit_cox(df, columns, "label")
    got = {r.feature: r for r in cox.coefficient_errors(model, df, "label", "ent").collect()}
    beta = model.coefficients["t"][:2]
    ent, stop, e = (np.array([r[i] for r in data], float) for i in (0, 2, 3))
    x = np.array([[r[4], r[5]] for r in data])
    w = np.exp(x @ beta)
    residual, info = np.zeros((len(data), 2)), np.zeros((2, 2))
    for t in np.unique(stop[e == 1]):
        at = stop == t  # every row is one step wide
        mean = (w[at][:, None] * x[at]).sum(0) / w[at].sum()
        hazard = e[at].sum() / w[at].sum()
        residual[at] = (x[at] - mean) * (e[at] - w[at] * hazard)[:, None]
        gap = x[at] - mean
        info += e[at].sum() * (w[at][:, None, None] * gap[:, :, None] * gap[:, None, :]).sum(0) / w[at].sum()
    by_entity = np.array([residual[ent == i].sum(0) for i in np.unique(ent)])
    inverse = np.linalg.inv(info)
    robust = np.sqrt(np.diag(inverse @ by_entity.T @ by_entity @ inverse))
    for i, name in enumerate(["x1", "x2"]):
        assert abs(got[name].std_error - np.sqrt(inverse[i, i])) < 1e-6
        assert abs(got[name].robust_error - robust[i]) < 1e-6
    if "same" in columns:
        assert got["same"].coefficient is None and got["same"].robust_error is None
