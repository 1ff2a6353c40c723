"""Queries: model jobs and what-ifs. Fits whose answer is known beforehand are in ``checks``, with their SQL."""

from __future__ import annotations

import random

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import functions as F

from cohortlens.causal import mechanisms, scm
from cohortlens.evaluation import curves, metrics
from cohortlens.models import board, boosting, cox, importance, margins, pu
from cohortlens.models.fits import together
from cohortlens.operators import assemble, labels
from cohortlens.plans import bindings as b
from cohortlens.plans import outcomes as out
from cohortlens.plans import sql as q
from cohortlens.plans.registry import query
from cohortlens.session import materialise

#: The counterparts of the source's twelve covariates in the main table.
COVARIATES = [
    "days_a", "days_n", "days_r", "urgent", "high", "low", "closed", "open", "urgent_in_yr", "n_f", "n_o", "n_p",
]


def survival_rows(spark, sf):
    rows = out.main_table(spark, sf).select("ent", "pred_dt", "label", *COVARIATES)
    return labels.survival_intervals(rows, b.ENT).drop("stop_dt")


def _cox(spark, sf):
    # read once for every Newton step: in as many pieces as there are tasks, however small the table is
    rows = survival_rows(spark, sf).repartition(spark.sparkContext.defaultParallelism, "ent")
    rows = materialise(rows, "survival")
    _, test = assemble.backtest_rows(rows, out.BACKTESTS)
    return cox.fit_cox(assemble.backtest_lists(rows, out.BACKTESTS), COVARIATES, "label"), test


@query("cox_fit")
def cox_fit(spark, sf):
    return _cox(spark, sf)[0].table()


@query("cox_expected")
def cox_expected(spark, sf):
    model, test = _cox(spark, sf)
    scored = cox.predict_expected(model, test)
    return scored.select("ent", "test_dt", "label", "tstart", "tstop", "predict", "event_prob")


@query("cox_backtest")
def cox_backtest(spark, sf):
    """Back-test board of the hazard model: areas, concordance, cells at the best-J and best-F1 thresholds."""
    model, test = _cox(spark, sf)
    scored = materialise(
        cox.predict_expected(model, test).select("test_dt", "tstart", "tstop", "label", "predict"), "cox"
    )
    keys = ["test_dt"]
    sweep = curves.threshold_runs(scored, "predict", "label", 0.0005, keys)
    best_j = curves.best_threshold(sweep, keys=keys).withColumnRenamed("threshold", "_t")
    hard = curves.binarise(curves.attach_by_key(scored, best_j, keys), "predict", "_t", name="hard")
    cells = metrics.confusion(hard, "label", "hard", keys)
    ranked = metrics.best_f1_board(scored, "predict", "label", keys, scale=False, strict=False).select(
        "test_dt", "auroc", "auprc", F.col("f1").alias("f1_prc"), F.col("precision").alias("precision_prc"),
        F.col("recall").alias("recall_prc"),
    )
    agreement = metrics.concordance(scored, "predict", "label", keys).select("test_dt", "concordance")
    return cells.withColumns(metrics.rates()).join(ranked, keys).join(agreement, keys)


def _model_frames(spark, sf):
    rows = materialise(out.main_table(spark, sf), "main")
    parts = assemble.split_by_year(rows, train=(1996, 1998), test=(2000, 2001), calibration=(1999, 1999))
    features = assemble.feature_columns(rows, ["ent", "pred_dt", "label"])
    return parts, features


GRID = {
    "GLM": (LogisticRegression, {"maxIter": 50}, {"regParam": [0.0, 0.01]}),
    "GBM": (GBTClassifier, {"maxIter": 20, "seed": 5454}, {"maxDepth": [3, 5]}),
}
FOLDS, FOLD_SEED = 3, 23


@query("model_board")
def model_board(spark, sf):
    """Contender models on balanced training rows, ranked on the validation year.

    Linear and boosted contenders are the best of a small grid over hash folds. The network takes no weights; it is
    trained on rows repeated to the same balance.
    """
    parts, features = _model_frames(spark, sf)
    train = materialise(board.class_weights(parts["train"], "label"), "train")
    repeated = materialise(board.balanced_rows(train, "label", "ent"), "repeated")
    chosen = board.contenders(features, "label")
    ranked = board.grid_board(train, features, "label", "ent", board.expand_grid(GRID, "label", "weight"), FOLDS, FOLD_SEED)
    chosen |= {"GLM_1": ranked.best("GLM"), "GBM_1": ranked.best("GBM")}
    models = together(
        {
            n: lambda e=e: board.pipeline(features, e).fit(train if e.hasParam("weightCol") else repeated)
            for n, e in chosen.items()
        }
    )
    frames = {"val": parts["calibration"], "test": parts["test"]}
    return board.leaderboard(models, frames, ["ent", "pred_dt"], "label")


@query("fold_table", f"""WITH {q.BASE}, {q.labelled(6)} SELECT CAST(CAST(concat('0x', substr(md5(concat(CAST(ent AS VARCHAR), '{FOLD_SEED}')),
    1, 8)) AS BIGINT) % 100 % {FOLDS} AS BIGINT) AS fold, COUNT(*) AS n, COUNT(DISTINCT ent) AS n_ent,
    COUNT(*) FILTER (WHERE label = 1) AS positive FROM labelled GROUP BY 1""")
def fold_table(spark, sf):
    """Folds by entity: the same rows at any partitioning, and no entity in two folds."""
    rows = board.fold_rows(b.labelled(spark, sf), "ent", FOLDS, FOLD_SEED)
    return rows.groupBy("fold").agg(
        F.count("*").alias("n"), F.count_distinct("ent").alias("n_ent"), F.count_if(F.col("label") == 1).alias("positive")
    )


@query("grid_means", f"""WITH {q.DOCS}, f AS (SELECT *, CAST(concat('0x', substr(md5(concat(CAST(doc_id AS VARCHAR), '{FOLD_SEED}')), 1, 8)) AS BIGINT)
    % 100 % {FOLDS} AS fold FROM docs)
  SELECT CAST(h.fold AS BIGINT) AS fold, h.toxic, ROUND(AVG(t.label), 3) AS p1 FROM (SELECT DISTINCT fold, toxic FROM f) h
  JOIN f t ON t.fold <> h.fold AND t.toxic = h.toxic GROUP BY h.fold, h.toxic""")
def grid_means(spark, sf):
    """Out-of-fold scores of an unpenalised model on one 0/1 column: the means of the other folds."""
    docs = materialise(b.scored_documents(spark, sf).select("doc_id", "toxic", "label"), "docs")
    plain = {"GLM": (LogisticRegression, {"tol": 1e-10, "maxIter": 200}, {"regParam": [0.0]})}
    ranked = board.grid_board(docs, ["toxic"], "label", "doc_id", board.expand_grid(plain, "label"), FOLDS, FOLD_SEED, keep=["toxic"])
    return ranked.scored.groupBy("fold", "toxic").agg(F.round(F.avg("p1"), 3).alias("p1"))


@query("stacked_ensemble")
def stacked_ensemble(spark, sf):
    parts, features = _model_frames(spark, sf)
    bases = board.contenders(features, "label", weight=None)
    stack = board.fit_stack(materialise(parts["train"], "train"), features, "label", bases, "ent")
    return stack.score(parts["test"], ["ent", "pred_dt"], "label")


GBT_PARAMS = """{"max_depth": {"actual": 3}, "ntrees": {"actual": 10}, "learn_rate": {"actual": 0.1}, "nfolds": {"actual": 3},
  "learn_rate_annealing": {"actual": 0.99}, "sample_rate_per_class": {"actual": [0.8, 0.9]}, "min_rows": {"actual": 5},
  "col_sample_rate": {"actual": 0.8}, "col_sample_rate_per_tree": {"actual": 0.8}, "max_abs_leafnode_pred": {"actual": 4.0}}"""


@query("calibrated_gbt")
def calibrated_gbt(spark, sf):
    """Boosted trees from a parameter text, stopped by their area on the calibration year and calibrated on it, scored on the
    test years."""
    parts, features = _model_frames(spark, sf)
    settings, _ = boosting.from_params(GBT_PARAMS)
    model = boosting.fit(parts["train"], features, "label", "ent", settings)
    model, _ = boosting.stop_by_area(model, parts["calibration"], "label", every=2)
    keys = ["ent", "pred_dt"]
    platt = board.fit_platt(model.score(parts["calibration"], keys, "label"), "label")
    return board.calibrate(platt, model.score(parts["test"], keys, "label"))


@query("boosted_folds")
def boosted_folds(spark, sf):
    """Board of the same trees over their out-of-fold scores, by fold."""
    parts, features = _model_frames(spark, sf)
    settings, folds = boosting.from_params(GBT_PARAMS)
    scored = boosting.out_of_fold(parts["train"], features, "label", "ent", settings, folds, ["pred_dt"])
    return metrics.metric_board(materialise(scored, "out_of_fold"), "p1", "label", "predict", ["fold"])


#: Leaves of twenty rows or more: cuts that part a handful of rows tie, and rounding would decide between them.
STUMPS = boosting.Settings(rounds=3, depth=1, step=0.3, annealing=0.5, tree_columns=0.6, class_shares=(0.6, 0.9), min_rows=20, bins=128)
STUMP_FEATURES = ["days_a", "days_n", "days_r"]


def stump_sql(at: int) -> str:
    """The scores after round ``at`` from those before it."""
    s, names = STUMPS, [STUMP_FEATURES[i] for i in boosting.tree_features(STUMP_FEATURES, STUMPS, at)]
    long = " UNION ALL ".join(f"SELECT '{n}' AS f, CAST({n} AS DOUBLE) AS v, g FROM picked{at}" for n in names)
    value = "CASE f " + " ".join(f"WHEN '{n}' THEN {n}" for n in names) + " END"
    step = s.step * s.annealing ** (at - 1)
    return f"""picked{at} AS (SELECT *, label - 1 / (1 + exp(-xb)) AS g, exp(-xb) / ((1 + exp(-xb)) * (1 + exp(-xb))) AS h FROM round{at - 1}
    WHERE CAST(concat('0x', substr(md5(concat(CAST(ent AS VARCHAR), '{s.seed + at}')), 1, 8)) AS BIGINT) % 100
      < CASE WHEN label = 1 THEN {round(100 * s.class_shares[1])} ELSE {round(100 * s.class_shares[0])} END),
  value{at} AS (SELECT f, v, SUM(g) AS g, COUNT(*) AS n FROM ({long}) GROUP BY f, v),
  cut{at} AS (SELECT f, (v + LEAD(v) OVER o) / 2 AS edge, SUM(g) OVER o AS gl, SUM(n) OVER o AS nl, SUM(g) OVER (PARTITION BY f) AS gt,
    SUM(n) OVER (PARTITION BY f) AS nt FROM value{at} WINDOW o AS (PARTITION BY f ORDER BY v)),
  best{at} AS (SELECT f, edge FROM cut{at} WHERE nl >= {s.min_rows} AND nt - nl >= {s.min_rows}
    ORDER BY ROUND(gl * gl / nl + (gt - gl) * (gt - gl) / (nt - nl), 9) DESC, f, edge LIMIT 1),
  leaf{at} AS (SELECT {value} <= edge AS small, SUM(g) / SUM(h) AS adds FROM picked{at}, best{at} GROUP BY 1),
  round{at} AS (SELECT r.* EXCLUDE (xb), xb + CAST({step} AS DOUBLE) * adds AS xb FROM round{at - 1} r, best{at} b JOIN leaf{at} l
    ON l.small = ({value.replace("THEN ", "THEN r.")} <= b.edge))"""


STUMP_SQL = f"""WITH {q.SCORED}, round0 AS (SELECT ent, label, days_a, days_n, days_r, (SELECT ln(AVG(label) / (1 - AVG(label))) FROM scored) AS xb
  FROM scored), {", ".join(stump_sql(at) for at in range(1, STUMPS.rounds + 1))},
  staged AS ({" UNION ALL ".join(f"SELECT CAST({at} AS INTEGER) AS stage, label, 1 / (1 + exp(-xb)) AS score FROM round{at}" for at in range(1, STUMPS.rounds + 1))})"""


def _stumps(spark, sf):
    rows = materialise(b.scored_spine(spark, sf).select("ent", "label", *STUMP_FEATURES), "stumps")
    return boosting.fit(rows, STUMP_FEATURES, "label", "ent", STUMPS), rows


@query("boosted_rounds", f"""{STUMP_SQL} SELECT stage, ROUND(score, 6) AS p1, COUNT(*) AS n, COUNT(*) FILTER (WHERE label = 1) AS positive
  FROM staged GROUP BY ALL""")
def boosted_rounds(spark, sf):
    """Scores after each of three rounds of depth one, with shares of columns and classes and a falling step."""
    model, rows = _stumps(spark, sf)
    staged = model.staged(rows, ["ent"], "label")
    return staged.groupBy("stage", F.round("p1", 6).alias("p1")).agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("positive")
    )


@query("boosted_stage_areas", f"""{STUMP_SQL}, rounded AS (SELECT stage, label, ROUND(score, 6) AS score FROM staged), {q.curve("rounded", "stage")}
  SELECT stage, ROUND(SUM(CAST(neg AS DOUBLE) * (tp - pos / 2.0)) / (CAST(ANY_VALUE(p) AS DOUBLE) * ANY_VALUE(n)), 6) AS auroc
  FROM curve GROUP BY stage""")
def boosted_stage_areas(spark, sf):
    """Area under the curve after each round."""
    model, rows = _stumps(spark, sf)
    return boosting.stage_areas(model, rows, "label").select("stage", F.round("auroc", 6).alias("auroc"))


@query("model_importance")
def model_importance(spark, sf):
    parts, features = _model_frames(spark, sf)
    model = board.pipeline(features, GBTClassifier(labelCol="label", maxIter=10, maxDepth=3, seed=23)).fit(
        parts["train"]
    )
    return board.feature_importance(model, features, spark)


@query("logistic")
def logistic(spark, sf):
    """Binomial model on the answered rows of three quarters of the survey cohort, probabilities of all the rest."""
    train, test = assemble.hash_split(materialise(out.survey_table(spark, sf), "survey"), "ent")
    train = train.filter(F.col("answer") != 0)
    formula = "depressive_disorder ~ answer + race + gender + language + excused + unexcused + total_courses + a_grades"
    model = board.logistic(train, formula, unseen="keep")
    return board.score(model, test, ["ent"], "depressive_disorder", "prob")


def _pu_rows(spark, sf):
    rows = out.main_table(spark, sf).select("ent", "pred_dt", "label", *COVARIATES)
    return materialise(rows.withColumn("key", F.concat_ws("/", "ent", "pred_dt")), "pu")


@query("pu_backtest")
def pu_backtest(spark, sf):
    """One PU model per test date, all fitted and evaluated together. Rows are projected as they are read, nothing wide is
    written."""
    rows, scored = _pu_rows(spark, sf), None
    splits = assemble.backtest_splits(rows, out.BACKTESTS)
    seen = {day: F.array_contains("test_dt", F.lit(day).cast("date")) for day, _, _ in splits}
    models = pu.fit_pu_sets(assemble.backtest_lists(rows, out.BACKTESTS), COVARIATES, "label", "key", seen)
    for day, _, test in splits:
        part = models[day].transform(test).select(F.lit(day).cast("date").alias("test_dt"), "ent", "label", "pu_score")
        scored = part if scored is None else scored.unionByName(part)
    return metrics.best_f1_board(materialise(scored, "scored"), "pu_score", "label", ["test_dt"])


@query("pu_margin_embeddings")
def pu_margin_embeddings(spark, sf):
    """Embedding class 0 as in ``pu_embeddings``, with the margin classifier on the kernel features: areas of all vectors."""
    rows, names = _shown_vectors(spark, sf)
    estimator = margins.MarginClassifier("shown", "vec_id")
    model = pu.fit_pu(rows, names, "shown", "vec_id", estimator, gamma=0.05, dimension=256)
    scored = materialise(model.transform(rows).select("vec_id", "truth", "pu_score"), "scored")
    return curves.areas(curves.score_curve(scored, "pu_score", "truth"))


@query("pu_embeddings")
def pu_embeddings(spark, sf):
    """Embedding class 0 with part of its members unlabelled: PU scores of all vectors."""
    rows, names = _shown_vectors(spark, sf)
    model = pu.fit_pu(rows, names, "shown", "vec_id", dimension=256)
    return model.transform(rows).select("vec_id", "truth", "shown", "pu_score")


def _shown_vectors(spark, sf):
    vectors = b.table(spark, sf, "embeddings")
    names = [f"v{i}" for i in range(64)]
    positive = F.col("label") == 0
    shown = positive & (assemble.hash_percent("vec_id", 11) < 70)
    rows = vectors.select(
        "vec_id", positive.cast("int").alias("truth"), shown.cast("int").alias("shown"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)],
    )
    return materialise(rows, "vectors"), names


@query("permutation_importance")
def permutation_importance(spark, sf):
    """Importance in the kernel model of the back-test, trained on all its rows."""
    rows = _pu_rows(spark, sf).select("ent", "pred_dt", "key", "label", *COVARIATES)
    model = pu.fit_pu(rows, COVARIATES, "label", "key", held=False)
    found = importance.permutation_importance(
        lambda moved: model.slot_scores(moved, 10), rows, ["ent", "pred_dt"], COVARIATES, "label"
    )
    return found.groupBy("feature").agg(
        F.avg("importance").alias("mean_imp"), F.stddev_pop("importance").alias("sd_imp")
    )


MOVED, REPEATS, SEED = ["days_a", "score"], 3, 626


def _moves_sql() -> str:
    """The permutations written out: the rounds of each slot, folded over the row number.

    The keys are drawn modulo n in the query, since n is the number of rows; the number of rounds is that of up to
    2^20 rows, and rows in the library have fewer rounds for fewer rows.
    """
    slots = [(f, r) for f in MOVED for r in range(REPEATS)]
    values = []
    for i, (feature, repeat) in enumerate(slots):
        rng = random.Random(f"{SEED}/{feature}/{repeat}")
        keys = [(rng.randrange(1 << 62), rng.randrange(1, importance.PRIME), rng.randrange(importance.PRIME)) for _ in range(24)]
        values.append(f"({i}, '{feature}', {repeat}, [{', '.join(f'[{k}, {a}, {b}]' for k, a, b in keys)}])")
    p = importance.PRIME
    return f"""{q.SCORED}, slots(slot, feature, repeat, keys) AS (VALUES {", ".join(values)}),
  rows AS (SELECT ent, pred_dt, label, CAST(days_a AS DOUBLE) AS days_a, CAST(score AS DOUBLE) AS score,
    row_number() OVER (ORDER BY ent, pred_dt) - 1 AS idx, COUNT(*) OVER () AS n FROM scored),
  sent AS (SELECT feature, repeat, CASE feature WHEN 'days_a' THEN days_a ELSE score END AS value,
    list_reduce([[idx, 0, 0]] || keys[1:greatest(8, len(bin(n)) + 4)], lambda x, key: CASE
      WHEN ((greatest(x[1], ((key[1] % n) - x[1] + n) % n) % {p}) * key[2] + key[3]) % {p} % 2 = 1
      THEN [((key[1] % n) - x[1] + n) % n, 0, 0] ELSE x END)[1] AS idx FROM rows, slots),
  moves AS (SELECT r.ent, r.pred_dt, r.label, r.days_a, r.score, s.feature, s.repeat, s.value FROM sent s JOIN rows r USING (idx))"""


def _moved(spark, sf):
    rows = b.scored_spine(spark, sf)
    return importance.moved_values(rows, ["ent", "pred_dt"], MOVED, ["label"], REPEATS, SEED)


@query("permutation_moves", f"""WITH {_moves_sql()} SELECT ent, pred_dt, feature, repeat, value FROM moves""")
def permutation_moves(spark, sf):
    """The value that comes to each row by the permutation of each feature and repeat."""
    moved = _moved(spark, sf)
    slots = moved.select("ent", "pred_dt", F.posexplode("moved").alias("slot", "value"))
    names = F.array(*[F.lit(f) for f in MOVED])
    return slots.select(
        "ent", "pred_dt", F.get(names, F.floor(F.col("slot") / REPEATS).cast("int")).alias("feature"),
        (F.col("slot") % REPEATS).alias("repeat"), "value",
    )


@query("permutation_f1", f"""WITH {_moves_sql()}, s AS (
    SELECT feature, repeat, label, CASE feature WHEN 'days_a' THEN value + 100 * score ELSE days_a + 100 * value END AS v FROM moves
    UNION ALL SELECT '', -1, label, days_a + 100 * score FROM rows),
  c AS (SELECT DISTINCT feature, repeat, SUM(label) OVER w AS tp, COUNT(*) OVER w AS k, SUM(label) OVER (PARTITION BY feature, repeat) AS p
    FROM s WINDOW w AS (PARTITION BY feature, repeat ORDER BY v DESC RANGE UNBOUNDED PRECEDING)),
  f AS (SELECT feature, repeat, MAX(CASE WHEN p > 0 THEN 2.0 * tp / (k + p) ELSE 0 END) AS f1 FROM c GROUP BY feature, repeat)
  SELECT feature, repeat, ROUND((SELECT f1 FROM f WHERE repeat < 0) - f1, 9) + 0.0 AS importance FROM f WHERE repeat >= 0""")
def permutation_f1(spark, sf):
    """Drop of the best F1 of a given linear score."""
    rows = b.scored_spine(spark, sf)

    def scores(moved):
        x, new = F.col("x"), F.col("moved")
        own = F.get(x, F.lit(0)) + 100 * F.get(x, F.lit(1))
        first = [F.get(new, F.lit(r)) + 100 * F.get(x, F.lit(1)) for r in range(REPEATS)]
        second = [F.get(x, F.lit(0)) + 100 * F.get(new, F.lit(REPEATS + r)) for r in range(REPEATS)]
        return moved.withColumn("scores", F.array(own, *first, *second))

    found = importance.permutation_importance(scores, rows, ["ent", "pred_dt"], MOVED, "label", REPEATS, SEED)
    return found.withColumn("importance", F.round("importance", 9) + 0.0)


# --- what-ifs ---------------------------------------------------------------

EDGES = [("l_quantity", "l_extendedprice"), ("l_extendedprice", "l_tax"), ("l_quantity", "l_discount"),
         ("l_discount", "l_tax")]
CHAIN = [("l_quantity", "l_extendedprice"), ("l_extendedprice", "l_tax")]
LINE = """fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s1, regr_intercept(l_extendedprice, l_quantity) AS i1,
  regr_slope(l_tax, l_extendedprice) AS s2, regr_intercept(l_tax, l_extendedprice) AS i2 FROM lineitem)"""


def _lines(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )


@query("scm_chain", f"""WITH {LINE} SELECT 'l_extendedprice' AS node, 'l_quantity' AS parent, ROUND(s1, 4) + 0.0 AS slope,
  ROUND(i1, 4) AS intercept FROM fit UNION ALL SELECT 'l_tax', 'l_extendedprice', ROUND(s2, 4) + 0.0, ROUND(i2, 4) FROM fit""")
def scm_chain(spark, sf):
    table = scm.fit_scm(_lines(spark, sf), CHAIN).table(spark)
    return table.withColumns({"slope": F.round("slope", 4), "intercept": F.round("intercept", 4)})


# two parents: the 2 x 2 normal equations written out; slopes in millionths
@query("scm_fit", """WITH m AS (SELECT AVG(l_tax) AS mt, AVG(l_discount) AS md, AVG(l_extendedprice) AS me, AVG(l_quantity) AS mq,
    COVAR_POP(l_discount, l_discount) AS dd, COVAR_POP(l_extendedprice, l_extendedprice) AS ee,
    COVAR_POP(l_discount, l_extendedprice) AS de, COVAR_POP(l_discount, l_tax) AS dt, COVAR_POP(l_extendedprice, l_tax) AS et,
    COVAR_POP(l_quantity, l_quantity) AS qq, COVAR_POP(l_quantity, l_discount) AS qd,
    COVAR_POP(l_quantity, l_extendedprice) AS qe FROM lineitem),
  s AS (SELECT *, (dt * ee - et * de) / (dd * ee - de * de) AS bd, (et * dd - dt * de) / (dd * ee - de * de) AS be FROM m),
  long AS (SELECT 'l_extendedprice' AS node, 'l_quantity' AS parent, qe / qq AS slope, me - qe / qq * mq AS intercept FROM s
    UNION ALL SELECT 'l_discount', 'l_quantity', qd / qq, md - qd / qq * mq FROM s
    UNION ALL SELECT 'l_tax', 'l_discount', bd, mt - bd * md - be * me FROM s
    UNION ALL SELECT 'l_tax', 'l_extendedprice', be, mt - bd * md - be * me FROM s)
  SELECT node, parent, ROUND(slope * 1e6, 3) + 0.0 AS slope, ROUND(intercept, 4) + 0.0 AS intercept FROM long""")
def scm_fit(spark, sf):
    table = scm.fit_scm(_lines(spark, sf), EDGES).table(spark)
    return table.withColumns({"slope": F.round(F.col("slope") * 1e6, 3), "intercept": F.round("intercept", 4)})


@query("counterfactual", f"""WITH {LINE} SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice + s1 * (10 - l_quantity), 2)
  AS price_cf, ROUND(l_tax + s2 * s1 * (10 - l_quantity), 4) + 0.0 AS tax_cf FROM lineitem, fit""")
def counterfactual(spark, sf):
    """Every line with its quantity set to 10."""
    rows = _lines(spark, sf)
    changed = scm.counterfactual(scm.fit_scm(rows, CHAIN), rows, {"l_quantity": 10.0})
    return changed.select(
        "l_orderkey", "l_linenumber",
        F.round("l_extendedprice_cf", 2).alias("price_cf"), F.round("l_tax_cf", 4).alias("tax_cf"),
    )


@query("case_study", f"""WITH {LINE}, base AS (SELECT 10.0::DOUBLE AS l_quantity, AVG(l_extendedprice) AS l_extendedprice,
    AVG(l_tax) AS l_tax FROM lineitem WHERE l_returnflag = 'R')
  SELECT ROUND(l_extendedprice, 2) AS price, ROUND(l_extendedprice + s1 * (40 - l_quantity), 2) AS price_cf,
    ROUND(l_tax + s2 * s1 * (40 - l_quantity), 4) AS tax_cf FROM base, fit""")
def case_study(spark, sf):
    """Mean line of one class with an override, and what it would be at quantity 40."""
    lines = b.table(spark, sf, "lineitem")
    model = scm.fit_scm(lines, CHAIN)
    case = scm.case_study(
        lines, F.col("l_returnflag") == "R", ["l_quantity", "l_extendedprice", "l_tax"], {"l_quantity": 10.0}
    )
    changed = scm.counterfactual(model, case, {"l_quantity": 40.0})
    return changed.select(
        F.round("l_extendedprice", 2).alias("price"), F.round("l_extendedprice_cf", 2).alias("price_cf"),
        F.round("l_tax_cf", 4).alias("tax_cf"),
    )


FLAGS = [("big", "taxed"), ("big", "returned"), ("taxed", "returned")]
FLAG_LINES = """flags AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity > 25 AS INTEGER) AS big,
    CAST(l_tax > 0.04 AS INTEGER) AS taxed, CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem)"""


def _flags(spark, sf):
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        (F.col("l_quantity") > 25).cast("int").alias("big"),
        (F.col("l_tax") > 0.04).cast("int").alias("taxed"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )


def _unit(node: str) -> str:
    text = f"concat(CAST(l_orderkey AS VARCHAR), '/', CAST(l_linenumber AS VARCHAR), '/noise/{node}')"
    return f"CAST(CAST(concat('0x', substr(md5({text}), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0"


@query("counterfactual_discrete", f"""WITH {FLAG_LINES}, p_tax AS (SELECT big, AVG(taxed) AS p FROM flags GROUP BY big),
  p_back AS (SELECT big, taxed, AVG(returned) AS p FROM flags GROUP BY big, taxed),
  u AS (SELECT f.*, {_unit("taxed")} AS u1, {_unit("returned")} AS u2, a.p AS p1, c.p AS q1 FROM flags f JOIN p_tax a USING (big)
    JOIN p_tax c ON c.big = 1),
  moved AS (SELECT *, CAST(CASE WHEN taxed = 1 THEN u1 * p1 ELSE p1 + u1 * (1 - p1) END < q1 AS INTEGER) AS taxed_cf FROM u)
  SELECT m.l_orderkey, m.l_linenumber, m.taxed_cf,
    CAST(CASE WHEN m.returned = 1 THEN u2 * a.p ELSE a.p + u2 * (1 - a.p) END < c.p AS INTEGER) AS returned_cf
  FROM moved m JOIN p_back a ON a.big = m.big AND a.taxed = m.taxed JOIN p_back c ON c.big = 1 AND c.taxed = m.taxed_cf""")
def counterfactual_discrete(spark, sf):
    """Every line with a large quantity: flags that follow from it stay flags."""
    rows, key = _flags(spark, sf), ["l_orderkey", "l_linenumber"]
    changed = mechanisms.counterfactual_rows(mechanisms.fit_mechanisms(rows, FLAGS, key), rows, key, {"big": 1.0})
    return changed.select(*key, F.col("taxed_cf").cast("int").alias("taxed_cf"), F.col("returned_cf").cast("int").alias("returned_cf"))


@query("mechanism_errors", """WITH held AS (SELECT l_quantity AS x, l_extendedprice AS y, CAST(concat('0x', substr(md5(concat(
    CAST(l_orderkey AS VARCHAR), '/', CAST(l_linenumber AS VARCHAR), '626')), 1, 8)) AS BIGINT) % 100 < 20 AS h FROM lineitem),
  fit AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM held WHERE NOT h)
  SELECT 'l_extendedprice' AS node, 'value' AS kind, ROUND(AVG((y - i - s * x) * (y - i - s * x)) / 1e6, 3) AS error_linear
  FROM held, fit WHERE h
  UNION ALL SELECT 'l_quantity', 'value', NULL UNION ALL SELECT 'big', 'binary', NULL UNION ALL SELECT 'taxed', 'binary', NULL""")
def mechanism_errors(spark, sf):
    """Kind of each node and held-out error of the linear candidate, in millions."""
    edges = [("l_quantity", "l_extendedprice"), ("big", "taxed")]
    model = mechanisms.fit_mechanisms(_flags(spark, sf), edges, ["l_orderkey", "l_linenumber"])
    return model.table(spark).select("node", "kind", F.round(F.col("error_linear") / 1e6, 3).alias("error_linear"))
