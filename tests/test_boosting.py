import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.models import boosting
from cohortlens.models.boosting import Settings

FEATURES = ["a", "b", "c"]


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 6, n), rng.integers(0, 4, n), rng.integers(0, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(2.5 - a + 0.5 * b))).astype(int)
    return [(i, *(float(v[i]) for v in (a, b, c)), int(y[i])) for i in range(n)]


SCHEMA = "id long, a double, b double, c double, y int"


def plain(rows, settings):
    """Boosted stumps with plain loops."""
    x, y = np.array([r[1:4] for r in rows]), np.array([r[4] for r in rows], float)
    score = np.full(len(rows), math.log(y.mean() / (1 - y.mean())))
    stages = []
    for at in range(1, settings.rounds + 1):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        best = None
        for f in boosting.tree_features(FEATURES, settings, at):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                gain = g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum()
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, left)
        left = best[1]
        step = settings.step * settings.annealing ** (at - 1)
        score = score + step * np.where(left, g[left].sum() / h[left].sum(), g[~left].sum() / h[~left].sum())
        stages.append(1 / (1 + np.exp(-score)))
    return stages


@pytest.fixture(scope="module")
def frame(spark):
    return data(), spark.createDataFrame(data(), SCHEMA)


def test_stumps_equal_plain_loops_at_every_stage(frame):
    rows, df = frame
    settings = Settings(rounds=4, depth=1, step=0.3, annealing=0.5, tree_columns=0.6, cut=2)
    model = boosting.fit(df, FEATURES, "y", "id", settings)
    want = plain(rows, settings)
    for r in model.staged(df, ["id"], "y").collect():
        assert abs(r["p1"] - want[r["stage"] - 1][r["id"]]) < 1e-9
    last = {r["id"]: r["p1"] for r in model.score(df, ["id"], "y").collect()}
    assert all(abs(last[i] - p) < 1e-9 for i, p in enumerate(want[-1]))


def test_leaves_are_those_of_the_fitted_tree_without_vectors(spark, frame):
    _, df = frame
    holes = df.withColumn("a", F.when(F.col("id") % 7 > 0, F.col("a"))).withColumn("b", F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.col("b")))
    model = boosting.fit(df, FEATURES, "y", "id", Settings(rounds=3, depth=4, tree_columns=0.6))
    rows = holes.withColumns(boosting.feature_values(FEATURES))
    for tree in model.trees:
        vectors = boosting.assembler([f"_f{i}" for i in tree.columns]).setOutputCol("_slice").transform(rows)
        found = tree.model.setLeafCol("_own").transform(vectors).withColumn("_leaf", tree.leaf())
        assert tree.leaves > 4 and all(r["_own"][0] == r["_leaf"] for r in found.collect())
    plan = model.score(holes, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF" not in plan and "VectorAssembler" not in plan


def test_column_share_and_leaf_limit(frame):
    _, df = frame
    model = boosting.fit(df, FEATURES, "y", "id", Settings(rounds=3, depth=3, tree_columns=0.5, leaf_limit=0.2))
    assert all(len(t.columns) == 2 for t in model.trees)
    assert len({tuple(t.columns) for t in model.trees}) > 1
    assert all(abs(v) <= 0.1 * 0.2 + 1e-12 for t in model.trees for v in t.adds)


def test_class_shares_do_not_depend_on_partitions(frame):
    _, df = frame
    settings = Settings(rounds=2, depth=2, class_shares=(0.5, 0.9))
    one, other = (boosting.fit(df.repartition(n), FEATURES, "y", "id", settings) for n in (1, 7))
    assert np.allclose(np.concatenate([t.adds for t in one.trees]), np.concatenate([t.adds for t in other.trees]))
    whole = boosting.fit(df, FEATURES, "y", "id", Settings(rounds=2, depth=2))
    assert [t.adds for t in whole.trees] != [t.adds for t in one.trees]


def test_stop_takes_the_first_stage_near_the_best(frame):
    _, df = frame
    model = boosting.fit(df, FEATURES, "y", "id", Settings(rounds=6, depth=2, step=0.3))
    kept, board = boosting.stop_by_area(model, df, "y", 0.01, every=2)
    areas = {r["stage"]: r["auroc"] for r in board.collect()}
    assert sorted(areas) == [2, 4, 6]
    assert len(kept.trees) == min(s for s, v in areas.items() if v >= max(areas.values()) - 0.01)
    whole, _ = boosting.stop_by_area(model, df.filter("y = 1"), "y")
    assert len(whole.trees) == 6


def test_one_class_and_no_rows(frame):
    _, df = frame
    ones = boosting.fit(df.filter("y = 1"), FEATURES, "y", "id", Settings(rounds=2))
    assert not ones.trees and ones.score(df, ["id"]).agg(F.min("p1")).first()[0] > 0.999
    none = boosting.fit(df.limit(0), FEATURES, "y", "id", Settings(rounds=2))
    assert none.staged(df, ["id"], "y").select("stage", "p1").distinct().collect() == [(0, 0.5)]


def test_out_of_fold_scores_each_row_once(frame):
    _, df = frame
    scored = boosting.out_of_fold(df, FEATURES, "y", "id", Settings(rounds=2, depth=2), folds=2)
    assert scored.count() == scored.select("id").distinct().count() == df.count()


def test_parameters():
    settings, folds = boosting.from_params(
        '{"ntrees": 7, "learn_rate_annealing": {"actual": 0.9}, "sample_rate": 0.8, "sample_rate_per_class": [0.5, 1.0],'
        ' "nfolds": 5, "col_sample_rate_per_tree": 0.4, "huber_alpha": null}'
    )
    assert folds == 5 and settings == Settings(rounds=7, annealing=0.9, class_shares=(0.5, 1.0), tree_columns=0.4)
    assert boosting.from_params({"sample_rate": 0.8})[0].class_shares == (0.8, 0.8)
    with pytest.raises(ValueError, match="huber_alpha"):
        boosting.from_params({"huber_alpha": 0.9})
    assert boosting.from_params({"huber_alpha": 0.9}, leave=["huber_alpha"])[1] == 0
    with pytest.raises(ValueError, match="share"):
        Settings(tree_columns=0)
