import numpy as np
import pytest
from conftest import day
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from cohortlens.causal import dag, mechanisms, scm
from cohortlens.evaluation import curves
from cohortlens.models import board, cox, importance, pu
from cohortlens.models.fits import together
from cohortlens.sources import tables


def cox_data(seed=1, n=180):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x1, x2 = float(rng.normal()), float(rng.integers(2))
        for k in range(int(rng.integers(1, 5))):
            e = int(rng.random() < 1 / (1 + np.exp(2.2 - 0.9 * x1 + 0.6 * x2)))
            out.append((i, 6 * k, 6 * k + 6, e, x1 + 0.2 * k, x2, 3.0))
            if e:
                break
    return out


def numpy_cox(data, columns):
    """Plain Newton on the Breslow likelihood."""
    start, stop, e = (np.array([r[i] for r in data], float) for i in (1, 2, 3))
    x = np.array([[r[c] for c in columns] for r in data], float)
    beta = np.zeros(len(columns))
    for _ in range(50):
        grad, info = np.zeros(len(columns)), np.zeros((len(columns),) * 2)
        for t in np.unique(stop[e == 1]):
            risk = (start < t) & (stop >= t)
            w = np.exp(x[risk] @ beta)
            m = (w[:, None] * x[risk]).sum(0) / w.sum()
            v = (w[:, None, None] * x[risk][:, :, None] * x[risk][:, None, :]).sum(0) / w.sum() - np.outer(m, m)
            d = (e == 1) & (stop == t)
            grad += x[d].sum(0) - d.sum() * m
            info += d.sum() * v
        beta = beta + np.linalg.solve(info, grad)
    hazard = {}
    for t in np.unique(stop[e == 1]):
        risk = (start < t) & (stop >= t)
        hazard[t] = ((e == 1) & (stop == t)).sum() / np.exp(x[risk] @ beta).sum()
    return beta, hazard


SCHEMA = "id long, tstart int, tstop int, y int, x1 double, x2 double, flat double"


@pytest.fixture(scope="module")
def fitted(spark):
    groups = {day("2018-01-01"): cox_data(1), day("2018-07-01"): cox_data(2, 120)}
    rows = [(*r, g) for g, data in groups.items() for r in data]
    df = spark.createDataFrame(rows, SCHEMA + ", test_dt date")
    return groups, df, cox.fit_cox(df, ["x1", "x2", "flat"], "y")


def test_cox_equals_numpy_per_group(fitted):
    groups, _, model = fitted
    for g, data in groups.items():
        beta, hazard = numpy_cox(data, [4, 5])
        got = model.coefficients[g]
        assert np.allclose(got[:2], beta, atol=1e-6)
        assert np.isnan(got[2])  # a constant column has no coefficient
        base = {r.time: r.hazard for r in model.baseline.filter(F.col("test_dt") == F.lit(g)).collect()}
        shift = float(np.exp(beta @ model.means[:2]))
        assert all(abs(base[int(t)] - h * shift) < 1e-6 for t, h in hazard.items())


def test_cox_expected_sums_hazard_over_interval(spark, fitted):
    groups, _, model = fitted
    g = day("2018-01-01")
    beta, hazard = numpy_cox(groups[g], [4, 5])
    df = spark.createDataFrame([(1, 0, 12, 0, 0.5, 1.0, 3.0, g), (2, 6, 12, 0, -1.0, 0.0, 3.0, g), (3, 60, 66, 0, 0.0, 0.0, 3.0, g)],
                               SCHEMA + ", test_dt date")
    got = {r.id: r for r in cox.predict_expected(model, df).collect()}
    want = np.exp(beta @ [0.5, 1.0]) * (hazard[6.0] + hazard[12.0])
    assert abs(got[1].predict - want) < 1e-6 and abs(got[1].event_prob - (1 - np.exp(-want))) < 1e-6
    assert abs(got[2].predict - np.exp(-beta[0]) * hazard[12.0]) < 1e-6
    assert got[3].predict == 0.0  # after the last event time


def test_cox_rows_wider_than_a_step(spark):
    merged = [(r[0], 0, r[2], r[3], r[4], r[5], r[6], day("2018-01-01")) for r in cox_data(3) if r[1] in (0, 6)]
    model = cox.fit_cox(spark.createDataFrame(merged, SCHEMA + ", test_dt date"), ["x1", "x2"], "y")
    beta, _ = numpy_cox(merged, [4, 5])
    assert np.allclose(model.coefficients[day("2018-01-01")], beta, atol=1e-6)


def test_cox_rows_with_a_list_of_groups(spark):
    from cohortlens.operators import assemble
    from cohortlens.operators.grid import Grid

    data = [(*r, day(["2017-01-01", "2017-07-01", "2018-01-01", None][r[0] % 4])) for r in cox_data(5, 160)]
    data.append((999, 0, 6, 1, None, 1.0, 3.0, day("2017-01-01")))
    df = spark.createDataFrame(data, SCHEMA + ", pred_dt date")
    grid = Grid(day("2017-07-01"), day("2018-07-01"), 6)
    listed, (train, _) = assemble.backtest_lists(df, grid), assemble.backtest_rows(df, grid)
    assert sorted((r.id, r.tstart, d) for r in listed.collect() for d in r.test_dt) == sorted((r.id, r.tstart, r.test_dt) for r in train.collect())
    got, want = (cox.fit_cox(rows, ["x1", "x2"], "y") for rows in (listed, train))
    assert got.coefficients.keys() == want.coefficients.keys() and len(want.coefficients) == 3
    for g, b in want.coefficients.items():
        assert np.allclose(got.coefficients[g], b, atol=1e-9) and abs(got.loglik[g] - want.loglik[g]) < 1e-9
    steps = [sorted((r.test_dt, r.time, round(r.hazard, 9)) for r in m.baseline.collect()) for m in (got, want)]
    assert steps[0] == steps[1]


def clusters(spark, n=600):
    rng = np.random.default_rng(9)
    out = []
    for i in range(n):
        truth = int(i % 3 == 0)
        shown = int(truth and rng.random() < 0.6)
        out.append((i, truth, shown, float(rng.normal(2.0 * truth)), float(rng.normal(-1.5 * truth))))
    return spark.createDataFrame(out, "id long, truth int, shown int, a double, b double")


@pytest.mark.parametrize("gamma", [0.4, None])
def test_pu_finds_hidden_positives(spark, gamma):
    df = clusters(spark)
    model = pu.fit_pu(df, ["a", "b"], "shown", "id", gamma=gamma, dimension=64)
    assert 0 < model.c <= 1
    area = curves.areas(curves.score_curve(model.transform(df), "pu_score", "truth")).first().auroc
    assert area > 0.85


def test_pu_constant_is_the_mean_of_the_held_out(spark):
    from cohortlens.operators.assemble import hash_percent
    from pyspark.ml.functions import vector_to_array

    df = clusters(spark)
    model = pu.fit_pu(df, ["a", "b"], "shown", "id", gamma=None)
    held = df.filter((F.col("shown") == 1) & (hash_percent("id", 626) < 10))
    raw = model.classifier.transform(model.features_of(held)).select(F.get(vector_to_array("probability"), F.lit(1))).collect()
    assert abs(model.c - sum(r[0] for r in raw) / len(raw)) < 1e-12


def test_pu_without_held_out_positives(spark):
    df = clusters(spark).withColumn("shown", F.lit(0))
    assert pu.fit_pu(df, ["a", "b"], "shown", "id", gamma=None).c == 1.0


def test_fourier_features_approximate_the_kernel(spark):
    df = spark.createDataFrame([(0.1, 0.2), (0.4, -0.3)], "a double, b double")
    z = [r.features.toArray() for r in pu.fourier_features(df, ["a", "b"], 0.4, 8192).collect()]
    assert abs(z[0] @ z[1] - np.exp(-0.4 * (0.3**2 + 0.5**2))) < 0.05


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_every_slot_is_a_permutation_of_its_own(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("a"), (F.col("id") * 100).alias("b"), F.lit(1).alias("y"))
    rows = importance.moved_values(df, ["k"], ["a", "b"], ["y"], 3, 3).toPandas().sort_values("k")
    moved = np.array(rows.moved.tolist())
    scale = np.array([10] * 3 + [100] * 3)
    assert moved.shape == (n, 6) and all(sorted(column) == list(range(n)) for column in (moved / scale).T)
    if n == 1000:
        near = np.corrcoef(np.vstack([np.arange(n), (moved / scale).T]))
        assert np.abs(near - np.eye(7)).max() < 0.15  # neither the row's place nor another slot shows


def test_permutation_importance_ranks_the_useful_feature(spark):
    df = clusters(spark).withColumn("noise", (F.col("id") * 7919 % 13).cast("double"))
    model = pu.fit_pu(df, ["a", "noise"], "truth", "id", gamma=None)
    got = importance.permutation_importance(lambda m: model.slot_scores(m, 2), df, ["id"], ["a", "noise"], "truth", 2)
    mean = {r.feature: r.m for r in got.groupBy("feature").agg(F.avg("importance").alias("m")).collect()}
    assert mean["a"] > 0.1 and abs(mean["noise"]) < 0.05
    assert got.count() == 4


@pytest.mark.parametrize("gamma", [None, 0.4])
def test_slot_scores_are_those_of_changed_rows(spark, gamma):
    df = clusters(spark).limit(40)
    model = pu.fit_pu(df, ["a", "b"], "truth", "id", gamma=gamma, dimension=16, seed=5)
    moved = importance.moved_values(df, ["id"], ["a", "b"], ["truth"], 1, 3)
    got = model.slot_scores(moved, 1).collect()
    for slot in range(3):
        changed = spark.createDataFrame(
            [(r.id, r.moved[0] if slot == 1 else r.x[0], r.moved[1] if slot == 2 else r.x[1]) for r in got], "id long, a double, b double"
        )
        want = {r.id: r.pu_score for r in model.transform(changed).collect()}
        assert all(abs(want[r.id] - r.scores[slot]) < 1e-9 for r in got)


def test_seed_of_a_pu_model_is_that_of_its_projection(spark):
    df = clusters(spark).limit(30)
    first, second = (pu.fit_pu(df, ["a", "b"], "truth", "id", dimension=8, seed=s).features_of(df).first().features for s in (1, 2))
    assert first != second


def test_boosting_calibration_and_persistence(spark, tmp_path):
    df = clusters(spark)
    gbt = board.gbt_from_params({"ntrees": 3, "max_depth": {"actual": 2}, "col_sample_rate": 0.5, "huber_alpha": None}, "truth")
    with pytest.raises(ValueError, match="huber_alpha"):
        board.gbt_from_params({"ntrees": 3, "huber_alpha": 0.9}, "truth")
    assert board.gbt_from_params({"huber_alpha": 0.9, "balance_classes": True}, "truth", leave=["huber_alpha"], weight="w").getWeightCol() == "w"
    assert (gbt.getMaxIter(), gbt.getMaxDepth()) == (3, 2)
    model = board.pipeline(["a", "b"], gbt).fit(df)
    scored = board.score(model, df, ["id"], "truth")
    assert scored.columns == ["id", "truth", "p1", "predict"]
    calibrated = board.calibrate(board.fit_platt(scored, "truth"), scored)
    gap = calibrated.agg(F.avg("calibrated") - F.avg("truth")).first()[0]
    assert abs(gap) < 1e-3  # a fitted intercept balances the mean
    board.save_models({"GBM_1": model, "GBM_2": model}, str(tmp_path / "exp"))
    loaded = board.load_models(spark, str(tmp_path / "exp"))
    assert sorted(loaded) == ["GBM_1", "GBM_2"]
    again = board.score(loaded["GBM_2"], df, ["id"]).agg(F.sum("p1")).first()[0]
    assert abs(again - scored.agg(F.sum("p1")).first()[0]) < 1e-9
    assert {r.feature for r in board.feature_importance(model, ["a", "b"], spark).collect()} == {"a", "b"}


def test_leaderboard_and_stack(spark):
    df = board.class_weights(clusters(spark), "truth")
    assert abs(df.groupBy("truth").agg(F.sum("weight").alias("w")).agg(F.max("w") - F.min("w")).first()[0]) < 1e-9
    estimators = {"GLM_1": LogisticRegression(labelCol="truth"), "GLM_2": LogisticRegression(labelCol="truth", regParam=5.0)}
    models = {n: board.pipeline(["a", "b"], e).fit(df) for n, e in estimators.items()}
    models["Stack_1"] = board.fit_stack(df, ["a", "b"], "truth", estimators, "id", folds=2)
    table = board.leaderboard(models, {"val": df, "test": df}, ["id"], "truth")
    got = table.collect()
    assert [r.model_type for r in got].count("GLM") == 2 and len(got) == 3
    assert all(r.val_auroc == r.test_auroc and r.val_tp + r.val_fn == 200 for r in got)


def test_grid_over_hash_folds(spark):
    df = clusters(spark)
    grid = {"GLM": (LogisticRegression, {}, {"regParam": [0.0, 50.0], "elasticNetParam": [1.0]})}
    ranked = board.grid_board(df, ["a", "b"], "truth", "id", board.expand_grid(grid, "truth"), 2)
    found = {r.model_id: r.auroc for r in ranked.board.collect()}
    assert set(found) == {"GLM|regParam=0.0|elasticNetParam=1.0", "GLM|regParam=50.0|elasticNetParam=1.0"}
    assert ranked.best("GLM").getRegParam() == 0.0
    assert ranked.scored.count() == 2 * df.count()  # every row once for each candidate, by a model of other folds
    folds = {r.id: r.fold for r in board.fold_rows(df, "id", 2, 23).collect()}
    assert all(folds[r.id] == r.fold for r in ranked.scored.collect())


def test_the_first_failure_of_several_fits_is_raised():
    assert together({i: lambda i=i: i * i for i in range(9)}, 3) == {i: i * i for i in range(9)}
    with pytest.raises(ZeroDivisionError):
        together({"a": lambda: 1, "b": lambda: 1 // 0})


def test_boosted_mechanism_where_the_mean_is_bent(spark):
    df = spark.range(800).select(
        "id", ((F.col("id") % 40) / 4 - 5).alias("x"), ((F.col("id") * 7919 % 100) / 500).alias("e")
    ).withColumns({"bent": F.col("x") * F.col("x") + F.col("e"), "straight": 3 * F.col("x") + F.col("e")})
    model = mechanisms.fit_mechanisms(df, [("x", "bent"), ("x", "straight")], ["id"])
    shapes = {r.node: r.shape for r in model.table(spark).collect()}
    assert shapes == {"x": "root", "bent": "boosted", "straight": "linear"}
    same = mechanisms.counterfactual_rows(model, df, ["id"], {"x": F.col("x")})
    assert same.filter("abs(bent - bent_cf) > 1e-9 or abs(straight - straight_cf) > 1e-9").count() == 0
    moved = mechanisms.counterfactual_rows(model, df, ["id"], {"x": 4.0}).agg(F.avg("bent_cf"), F.avg("straight_cf")).first()
    assert abs(moved[0] - 16.1) < 1.5 and abs(moved[1] - 12.1) < 0.01  # trees see 32 bins; a line would give 8.5


def test_flags_stay_flags_and_keep_their_noise(spark):
    df = spark.range(2000).select(
        "id", (F.col("id") % 2).alias("a"), (F.col("id") % 7 / 7.0).alias("x")
    ).withColumn("y", ((F.col("id") * 7919 % 100) < 20 + 50 * F.col("a")).cast("int"))
    df = df.withColumn("z", ((F.col("id") * 104729 % 100) < 100 * F.col("x")).cast("int"))
    df = df.unionByName(df.limit(1).withColumn("a", F.lit(None).cast("long")).withColumn("id", F.lit(-1).cast("long")))
    model = mechanisms.fit_mechanisms(df, [("a", "y"), ("x", "z"), ("y", "z")], ["id"])
    assert {n: (m.binary, m.shape in ("table", "root")) for n, m in model.mechanisms.items()} == {
        "a": (True, True), "x": (False, True), "y": (True, True), "z": (True, False)
    }
    rows = mechanisms.counterfactual_rows(model, df, ["id"], {"a": 1.0}).collect()
    known = [r for r in rows if r.a is not None]
    assert {r.y_cf for r in known} | {r.z_cf for r in known} == {0.0, 1.0}
    assert all(r.y_cf == r.y for r in known if r.a == 1)
    assert all(r.y_cf >= r.y for r in known)  # a higher probability takes no value away
    assert abs(sum(r.y_cf for r in known) / len(known) - 0.7) < 0.03
    assert all(r.z_cf == r.z for r in known if r.y_cf == r.y)
    assert [(r.y_cf, r.z_cf) for r in rows if r.a is None] == [(None, None)]


def test_formula_model(spark):
    df = clusters(spark).withColumn("kind", F.when(F.col("id") % 2 == 0, "x").otherwise("y"))
    model = board.logistic(df, "truth ~ a + kind")
    assert len(model.stages[-1].coefficients) == 2


# --- what-ifs ---------------------------------------------------------------


def chain(spark):
    return spark.range(200).select(
        "id", (F.col("id") % 17).cast("double").alias("a"),
    ).withColumn("b", 2 * F.col("a") + 1).withColumn("c", -3 * F.col("b") + 0.5 * (F.col("id") % 5))


def test_counterfactual_moves_by_the_product_of_slopes(spark):
    df = chain(spark)
    model = scm.fit_scm(df, [("a", "b"), ("b", "c")])
    assert abs(model.slopes["b"]["a"] - 2) < 1e-9 and abs(model.intercepts["b"] - 1) < 1e-9
    moved = scm.counterfactual(model, df, {"a": F.col("a") + 1})
    slope = model.slopes["b"]["a"] * model.slopes["c"]["b"]
    worst = moved.agg(F.max(F.abs(F.col("c_cf") - F.col("c") - F.lit(slope)))).first()[0]
    assert worst < 1e-9
    same = scm.counterfactual(model, df, {})
    assert same.agg(F.max(F.abs(F.col("c_cf") - F.col("c")))).first()[0] < 1e-9


def test_scm_with_two_parents(spark):
    df = spark.range(300).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"))
    df = df.withColumn("z", 4 * F.col("x") - 2 * F.col("y") + 3)
    model = scm.fit_scm(df, [("x", "z"), ("y", "z")])
    assert abs(model.slopes["z"]["x"] - 4) < 1e-9 and abs(model.slopes["z"]["y"] + 2) < 1e-9
    case = scm.case_study(df, F.col("x") == 1, ["x", "y", "z"], {"x": 2}).first()
    assert case.x == 2.0


def test_dag_tables(spark):
    edges = spark.createDataFrame([("a", "b", "Edge Coef."), ("b", "c", "Edge Coef."), ("b", "b", "Std. Error")], "`from` string, `to` string, type string")
    nodes = dag.dag_nodes(edges, "b", "b2")
    assert sorted(r.label for r in nodes.collect()) == ["a", "b2", "c"]
    named = dag.dag_edges(edges, nodes, "b", "b2")
    ids = {r.label: r.id for r in nodes.collect()}
    assert {(r["from"], r["to"]) for r in named.collect()} == {(ids["a"], ids["b2"]), (ids["b2"], ids["c"])}
    assert {(r.label, r.role) for r in dag.neighbours(named, "b2").collect()} == {("a", "parent"), ("c", "child")}


# --- sources ----------------------------------------------------------------


def test_csv_columns_by_name(spark, tmp_path):
    path = tmp_path / "homeless.csv"
    path.write_text("year,Homeless,Student Number,unused\n2019-2020,Y,7,q\n2019-2020,N,x,q\n")
    got = tables.read_csv(spark, str(path), "homeless")
    assert got.columns == ["Student Number", "Person ID", "year", "Homeless"]
    assert sorted((r[0] or 0, r[1], r[3]) for r in got.collect()) == [(0, None, "N"), (7, None, "Y")]
    assert tables.clean_names(got).columns == ["student_number", "person_id", "year", "homeless"]


def test_write_partitioned(spark, tmp_path):
    df = spark.range(100).withColumn("pred_yr", F.col("id") % 3)
    tables.write_table(df, str(tmp_path / "main"), partition_by=["pred_yr"])
    back = spark.read.parquet(str(tmp_path / "main")).select("id", "pred_yr")
    assert back.count() == 100
    plan = back.filter("pred_yr = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pred_yr" in plan


def test_names_and_tables(spark):
    a = spark.createDataFrame([(1, "x")], "id long, gender string")
    z = spark.createDataFrame([(1, "y")], "id long, gender string")
    left, right = tables.suffix_clashes(a, z, ["id"])
    assert left.join(right, "id").columns == ["id", "gender_x", "gender_y"]
    tables.as_tables({"left_rows": left})
    assert spark.sql("select gender_x from left_rows").first()[0] == "x"
    assert [r.feature for r in tables.catalogue(a).collect()] == ["id", "gender"]
    assert tables.snake("How confident? (Values)") == "how_confident_values"
