"""Queries: model jobs against closed forms, and compositions on rows with two keys or two headers.

An iterative fit has an exact meaning where its answer is known beforehand: the
gradient of a fitted hazard model is zero, an unpenalised binomial model on one
category gives the means of the categories, and so does a PU model on such a base.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.evaluation import curves, metrics
from cohortlens.models import board, cox, margins, pu
from cohortlens.operators import asof, assemble, labels
from cohortlens.plans import bindings as b
from cohortlens.plans import outcomes as out
from cohortlens.plans import sql as q
from cohortlens.plans.registry import query
from cohortlens.session import materialise, scratch_path
from cohortlens.sources import tables

HAZARD = ["days_a", "score"]
BETA = [0.05, -0.3]
RISK = f"""{q.SCORED}, {out.INTERVALS.format(source='scored')}, {out.BACKTEST_SQL},
  risk AS (SELECT test_dt, ent, tstop, label AS e, CAST(days_a AS DOUBLE) AS x0, score AS x1, {BETA[0]} * days_a + ({BETA[1]}) * score AS xb
    FROM spells_rows JOIN bt ON pred_dt < test_dt),
  per AS (SELECT test_dt, tstop, SUM(e) AS d, SUM(e * xb) AS exb, SUM(exp(xb)) AS s, SUM(e * x0) AS ex0, SUM(e * x1) AS ex1,
    SUM(exp(xb) * x0) AS s0, SUM(exp(xb) * x1) AS s1, SUM(exp(xb) * x0 * x0) AS s00, SUM(exp(xb) * x0 * x1) AS s01,
    SUM(exp(xb) * x1 * x1) AS s11 FROM risk GROUP BY test_dt, tstop HAVING SUM(e) > 0)"""


def _training(spark, sf):
    rows = materialise(labels.survival_intervals(b.scored_spine(spark, sf), b.ENT).drop("stop_dt"), "survival")
    return assemble.backtest_rows(rows, out.BACKTESTS)


@query("cox_sums", f"""WITH {RISK} SELECT test_dt, ROUND(SUM(exb) - SUM(d * ln(s)), 3) AS loglik,
    ROUND(SUM(ex0 - d * s0 / s), 3) + 0.0 AS grad_days_a, ROUND(SUM(ex1 - d * s1 / s), 3) + 0.0 AS grad_score,
    ROUND(SUM(d * (s00 / s - s0 * s0 / (s * s))), 3) + 0.0 AS info_00, ROUND(SUM(d * (s01 / s - s0 * s1 / (s * s))), 3) + 0.0 AS info_01,
    ROUND(SUM(d * (s11 / s - s1 * s1 / (s * s))), 3) + 0.0 AS info_11 FROM per GROUP BY test_dt""")
def cox_sums(spark, sf):
    """Log-likelihood, gradient and information of the hazard model at fixed coefficients."""
    train, _ = _training(spark, sf)
    groups = [r["test_dt"] for r in train.select("test_dt").distinct().collect()]
    sums = cox.partial_likelihood(train, HAZARD, "label", {g: np.array(BETA) for g in groups})
    values = {"loglik": F.col("loglik"), "grad_days_a": F.col("grad")[0], "grad_score": F.col("grad")[1]}
    values |= {f"info_{n}": F.col("info")[i] for i, n in enumerate(("00", "01", "11"))}
    return sums.select("test_dt", *[(F.round(v, 3) + 0.0).alias(n) for n, v in values.items()])


@query("cox_hazard_steps", f"""WITH {RISK} SELECT test_dt, CAST(tstop AS INTEGER) AS time, ROUND(d / s, 9) AS hazard FROM per""")
def cox_hazard_steps(spark, sf):
    """Breslow steps of the baseline hazard at the same coefficients."""
    steps = _given(_training(spark, sf)[0]).baseline
    return steps.select("test_dt", F.col("time").cast("int").alias("time"), F.round("hazard", 9).alias("hazard"))


def _given(train):
    groups = [r["test_dt"] for r in train.select("test_dt").distinct().collect()]
    return cox.given_model(train, HAZARD, "label", {g: BETA for g in groups})


@query("cox_expected_given", f"""WITH {RISK}, seen AS (SELECT s.*, pred_dt AS test_dt FROM spells_rows s JOIN (SELECT DISTINCT test_dt FROM risk)
    ON test_dt = pred_dt),
  e AS (SELECT s.ent, s.test_dt, s.tstart, s.tstop, {BETA[0]} * s.days_a + ({BETA[1]}) * s.score AS xb, SUM(p.d / p.s) AS h
    FROM seen s LEFT JOIN per p ON p.test_dt = s.test_dt AND p.tstop > s.tstart AND p.tstop <= s.tstop
    GROUP BY ALL)
  SELECT ent, test_dt, ROUND(exp(xb) * coalesce(h, 0), 6) AS predict, ROUND(1 - exp(-exp(xb) * coalesce(h, 0)), 6) AS event_prob FROM e""")
def cox_expected_given(spark, sf):
    """Expected events in each test row's interval, and their probability, at the same coefficients."""
    train, test = _training(spark, sf)
    scored = cox.predict_expected(_given(train), test)
    return scored.select(
        "ent", "test_dt", F.round("predict", 6).alias("predict"), F.round("event_prob", 6).alias("event_prob")
    )


@query("cox_fit_gradient", f"""WITH {RISK} SELECT DISTINCT test_dt, feature, 0.0::DOUBLE AS gradient, true AS converged
  FROM per, (VALUES ('days_a'), ('score')) f(feature)""")
def cox_fit_gradient(spark, sf):
    """The gradient at the fitted coefficients, per event, which is zero."""
    train, _ = _training(spark, sf)
    model = cox.fit_cox(train, HAZARD, "label")
    fitted = {g: np.nan_to_num(v) for g, v in model.coefficients.items() if np.isfinite(model.loglik[g])}
    sums = cox.partial_likelihood(train, HAZARD, "label", fitted)
    events = train.groupBy("test_dt").agg(F.sum("label").alias("n"))
    done = F.create_map(*[v for g in fitted for v in (F.lit(g), F.lit(model.converged[g]))])
    long = sums.join(events, "test_dt").select(
        "test_dt", "n", F.posexplode("grad").alias("at", "g"), F.element_at(done, F.col("test_dt")).alias("converged")
    )
    names = F.array(*[F.lit(f) for f in HAZARD])
    value = F.round(F.col("g") / F.col("n"), 4)
    return long.select(
        "test_dt", F.get(names, F.col("at")).alias("feature"), F.when(value == 0, 0.0).otherwise(value).alias("gradient"), "converged"
    )


@query("cox_robust_errors", f"""WITH {RISK}, info AS (SELECT test_dt, SUM(d * (s00 / s - s0 * s0 / (s * s))) AS a,
    SUM(d * (s01 / s - s0 * s1 / (s * s))) AS b, SUM(d * (s11 / s - s1 * s1 / (s * s))) AS c FROM per GROUP BY test_dt),
  residual AS (SELECT r.test_dt, ent, SUM((x0 - s0 / s) * (e - exp(xb) * d / s)) AS u, SUM((x1 - s1 / s) * (e - exp(xb) * d / s)) AS v
    FROM risk r JOIN per p ON p.test_dt = r.test_dt AND p.tstop = r.tstop GROUP BY r.test_dt, ent),
  meat AS (SELECT test_dt, SUM(u * u) AS uu, SUM(u * v) AS uv, SUM(v * v) AS vv FROM residual GROUP BY test_dt),
  both_sides AS (SELECT *, a * c - b * b AS det FROM info JOIN meat USING (test_dt))
  SELECT test_dt, 'days_a' AS feature, ROUND(sqrt(c / det), 6) AS std_error,
    ROUND(sqrt(c * c * uu - 2 * b * c * uv + b * b * vv) / det, 6) AS robust_error FROM both_sides
  UNION ALL SELECT test_dt, 'score', ROUND(sqrt(a / det), 6), ROUND(sqrt(b * b * uu - 2 * a * b * uv + a * a * vv) / det, 6)
  FROM both_sides""")
def cox_robust_errors(spark, sf):
    """Errors of the hazard model at the same coefficients, from the information and from residuals by entity."""
    train, _ = _training(spark, sf)
    errors = cox.coefficient_errors(_given(train), train, "label", "ent")
    return errors.select(
        "test_dt", "feature", F.round("std_error", 6).alias("std_error"), F.round("robust_error", 6).alias("robust_error")
    )


#: A base that is right on four documents of five, and one that is wrong on two of three.
BASES = f"""{q.DOCS}, based AS (SELECT doc_id, label, CASE WHEN doc_id % 5 = 0 THEN 1 - label ELSE label END AS likely,
    CASE WHEN doc_id % 3 = 0 THEN label ELSE 1 - label END AS contrary FROM docs)"""


def _based(spark, sf):
    odd = lambda n: F.when(F.col("doc_id") % n == 0, 1 - F.col("label"))
    docs = b.scored_documents(spark, sf).select("doc_id", "label", odd(5).otherwise(F.col("label")).alias("likely"),
                                                (1 - odd(3).otherwise(F.col("label"))).alias("contrary"))
    return materialise(docs, "docs")


@query("stack_weights_at_least_zero", f"""WITH {BASES}, p AS (SELECT likely, AVG(label) AS p FROM based GROUP BY likely)
  SELECT CAST(b.likely AS INTEGER) AS likely, ROUND(ANY_VALUE(p), 3) AS prob, COUNT(*) AS n, 0.0::DOUBLE AS weight_contrary,
    SUM((label - p) * contrary) <= 0 AS pulls_down FROM based b JOIN p USING (likely) GROUP BY b.likely""")
def stack_weights_at_least_zero(spark, sf):
    """Top model over two bases of which one speaks against the label: it gets no weight, the rest fits the means.

    ``pulls_down``: the likelihood would only rise with a negative weight.
    """
    docs, names = _based(spark, sf), ["likely", "contrary"]
    model = board.pipeline(names, board.top_learner(names, "label")).fit(docs)
    weight = float(model.stages[-1].coefficients[1])
    scored = board.score(model, docs, names, "label", "prob")
    return scored.groupBy(F.col("likely").cast("int").alias("likely")).agg(
        F.round(F.avg("prob"), 3).alias("prob"), F.count("*").alias("n"), F.lit(round(weight, 3) + 0.0).alias("weight_contrary"),
        (F.sum((F.col("label") - F.col("prob")) * F.col("contrary")) <= 0).alias("pulls_down"),
    )


@query("margin_means", f"""WITH {BASES}, f AS (SELECT *, CAST(concat('0x', substr(md5(concat(CAST(doc_id AS VARCHAR), '626')), 1, 8)) AS BIGINT)
    % 100 % 3 AS fold FROM based),
  held AS (SELECT h.fold, h.likely, 2 * AVG(t.label) - 1 AS margin FROM (SELECT DISTINCT fold, likely FROM f) h
    JOIN f t ON t.fold <> h.fold AND t.likely = h.likely GROUP BY h.fold, h.likely
    UNION ALL SELECT -1, likely, 2 * AVG(label) - 1 FROM f GROUP BY likely)
  SELECT CAST(fold AS INTEGER) AS fold, CAST(likely AS INTEGER) AS likely, ROUND(margin, 6) AS margin FROM held""")
def margin_means(spark, sf):
    """Unpenalised margins on one 0/1 column are the mean of the labels -1 and 1, of all rows and of the other folds."""
    docs = _based(spark, sf)
    classifier = margins.MarginClassifier("label", "doc_id", penalty=None, folds=3)
    rows, weights, _ = classifier.fold_weights(board.assembler(["likely"]).transform(docs))
    held = classifier.held_out(rows, weights).join(docs.select(F.col("doc_id").alias("_key"), "likely"), "_key")
    whole = margins.MarginModel(weights[margins.ALL], 1.0, 0.0).transform(board.assembler(["likely"]).transform(docs))
    both = held.select("fold", "likely", "margin").unionByName(whole.select(F.lit(margins.ALL).alias("fold"), "likely", "margin"))
    return both.groupBy("fold", F.col("likely").cast("int").alias("likely")).agg(F.round(F.avg("margin"), 6).alias("margin"))


@query("binomial_means", f"""WITH {q.DOCS} SELECT lang, ROUND(AVG(label), 3) AS prob, COUNT(*) AS n FROM docs GROUP BY lang""")
def binomial_means(spark, sf):
    """Unpenalised binomial model on one category: the fitted probabilities are the means of the categories."""
    docs = materialise(b.scored_documents(spark, sf).select("doc_id", "lang", "label"), "docs")
    model = board.logistic(docs, "label ~ lang")
    scored = board.score(model, docs.withColumnRenamed("label", "truth"), ["lang"], "truth", "prob")
    return scored.groupBy("lang").agg(F.round(F.avg("prob"), 3).alias("prob"), F.count("*").alias("n"))


HELD = """CAST(concat('0x', substr(md5(concat(CAST(doc_id AS VARCHAR), '626')), 1, 8)) AS BIGINT) % 100 < 10"""


@query("pu_means", f"""WITH {q.DOCS}, base AS (SELECT toxic, AVG(label) AS s FROM docs WHERE NOT (label = 1 AND {HELD}) GROUP BY toxic),
  c AS (SELECT AVG(s) AS c FROM docs JOIN base USING (toxic) WHERE label = 1 AND {HELD})
  SELECT toxic, ROUND(s / c, 3) AS pu_score FROM base, c""")
def pu_means(spark, sf):
    """PU model on one 0/1 column: its base scores are means, its constant their mean over the held-out positives."""
    docs = materialise(b.scored_documents(spark, sf).select("doc_id", "toxic", "label"), "docs")
    plain = LogisticRegression(labelCol="label", regParam=0.0, tol=1e-10, maxIter=200)
    model = pu.fit_pu(docs, ["toxic"], "label", "doc_id", estimator=plain, gamma=None)
    scored = model.transform(docs)
    return scored.groupBy("toxic").agg(F.round(F.avg("pu_score"), 3).alias("pu_score"))


@query("platt_means", f"""WITH {q.DOCS} SELECT toxic, ROUND(AVG(label), 3) AS calibrated FROM docs GROUP BY toxic""")
def platt_means(spark, sf):
    """Calibration of a score with two values: the calibrated scores are the means of both."""
    docs = materialise(b.scored_documents(spark, sf).select("doc_id", "toxic", "label"), "docs")
    scored = docs.withColumn("p1", F.when(F.col("toxic") == 1, 0.3).otherwise(0.8))
    calibrated = board.calibrate(board.fit_platt(scored, "label"), scored)
    return calibrated.groupBy("toxic").agg(F.round(F.avg("calibrated"), 3).alias("calibrated"))


@query("balanced_weights", f"""WITH {q.DOCS} SELECT label, COUNT(*) AS n, ROUND(SUM((SELECT COUNT(*) FROM docs) / 2.0 /
    (SELECT COUNT(*) FROM docs x WHERE x.label = docs.label)), 6) AS weight FROM docs GROUP BY label""")
def balanced_weights(spark, sf):
    """Class weights: both classes weigh half of all rows."""
    docs = b.scored_documents(spark, sf).select("doc_id", "label")
    return board.class_weights(docs, "label").groupBy("label").agg(
        F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("weight")
    )


@query("balanced_rows", f"""WITH {q.DOCS}, n AS (SELECT COUNT(*) FILTER (WHERE label = 1) AS p, COUNT(*) FILTER (WHERE label = 0) AS q FROM docs),
  r AS (SELECT CASE WHEN p < q THEN 1 ELSE 0 END AS small, GREATEST(p, q) / CAST(LEAST(p, q) AS DOUBLE) AS ratio FROM n)
  SELECT label, CAST(SUM(CASE WHEN label = small THEN FLOOR(ratio) + CASE WHEN CAST(concat('0x', substr(md5(concat(CAST(doc_id AS VARCHAR),
      '5454')), 1, 8)) AS BIGINT) % 100 < ROUND(100 * (ratio - FLOOR(ratio))) THEN 1 ELSE 0 END ELSE 1 END) AS BIGINT) AS n
  FROM docs, r GROUP BY label""")
def balanced_rows(spark, sf):
    """Rows of the smaller class repeated up to the larger."""
    docs = b.scored_documents(spark, sf).select("doc_id", "label")
    return board.balanced_rows(docs, "label", "doc_id").groupBy("label").agg(F.count("*").alias("n"))


@query("binomial_standard_errors", f"""WITH {q.DOCS}, c AS (SELECT COUNT(*) FILTER (WHERE toxic = 0 AND label = 1) AS a,
    COUNT(*) FILTER (WHERE toxic = 0 AND label = 0) AS b, COUNT(*) FILTER (WHERE toxic = 1 AND label = 1) AS c,
    COUNT(*) FILTER (WHERE toxic = 1 AND label = 0) AS d FROM docs)
  SELECT 'toxic' AS term, ROUND(ln(CAST(c AS DOUBLE) / d) - ln(CAST(a AS DOUBLE) / b), 4) AS coefficient,
    ROUND(SQRT(1.0 / a + 1.0 / b + 1.0 / c + 1.0 / d), 4) AS std_error FROM c
  UNION ALL SELECT 'intercept', ROUND(ln(CAST(a AS DOUBLE) / b), 4), ROUND(SQRT(1.0 / a + 1.0 / b), 4) FROM c""")
def binomial_standard_errors(spark, sf):
    """Coefficients and standard errors on one 0/1 column, which a two by two table gives."""
    docs = materialise(b.scored_documents(spark, sf).select("doc_id", "toxic", "label"), "docs")
    terms = board.binomial_summary(docs, "label ~ toxic")
    return terms.select("term", F.round("coefficient", 4).alias("coefficient"), F.round("std_error", 4).alias("std_error"))


@query("saved_model_scores", f"""WITH {q.DOCS} SELECT lang, ROUND(AVG(label), 3) AS prob FROM docs GROUP BY lang""")
def saved_model_scores(spark, sf):
    """A model saved, listed, loaded and used to score."""
    docs = materialise(b.scored_documents(spark, sf).select("doc_id", "lang", "label"), "docs")
    folder = scratch_path(spark, "models")
    board.save_models({"means": board.logistic(docs, "label ~ lang")}, folder)
    (model,) = board.load_models(spark, folder).values()
    scored = model.transform(docs).select("lang", F.get(vector_to_array("probability"), F.lit(1)).alias("prob"))
    return scored.groupBy("lang").agg(F.round(F.avg("prob"), 3).alias("prob"))


@query("roc_with_area", f"""WITH {q.SCORED}, {q.curve('scored', 'pred_dt')}, area AS (SELECT pred_dt, ROUND(SUM(CAST(neg AS DOUBLE) * (tp - pos / 2.0))
    / NULLIF(CAST(ANY_VALUE(p) AS DOUBLE) * ANY_VALUE(n), 0), 6) AS tot_auroc FROM curve GROUP BY pred_dt)
  SELECT pred_dt, 'fixed' AS model_type, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr, CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr, tot_auroc
  FROM curve JOIN area USING (pred_dt)
  UNION ALL SELECT pred_dt, 'fixed', 0.0::DOUBLE, 0.0::DOUBLE, tot_auroc FROM area""")
def roc_with_area(spark, sf):
    """ROC rows of each model with its type and whole area."""
    curve = curves.score_curve(b.scored_spine(spark, sf), "score", "label", ["pred_dt"])
    area = curves.areas(curve, ["pred_dt"]).select("pred_dt", F.round("auroc", 6).alias("tot_auroc"))
    points = curves.roc_points(curve, ["pred_dt"]).drop("threshold")
    return points.join(area, "pred_dt").withColumn("model_type", F.lit("fixed"))


MANY = f"""{q.BASE}, {q.labelled()}, many AS (SELECT label, CAST(concat('0x', substr(md5(concat(CAST(ent AS VARCHAR), '/',
    CAST(pred_dt AS VARCHAR))), 1, 8)) AS BIGINT) % 5003 / CAST(5003 AS DOUBLE) AS score FROM labelled), {q.curve('many', '')}"""


def _many_scores(spark, sf):
    """Thousands of distinct scores, with ties, that depend on the key alone."""
    text = F.concat_ws("/", F.col("ent").cast("string"), F.col("pred_dt").cast("string"))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return b.labelled(spark, sf).select("label", ((head % 5003) / F.lit(5003.0)).alias("score"))


@query("roc_curve_many_scores", f"""WITH {MANY} SELECT threshold, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr,
  CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr FROM curve UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_curve_many_scores(spark, sf):
    return curves.roc_points(curves.score_curve(_many_scores(spark, sf), "score", "label"))


@query("best_f1_many_scores", f"""WITH {MANY}, f AS (SELECT threshold, COALESCE(2.0 * tp / NULLIF(p + tp + fp, 0), 0) AS f1 FROM curve)
  SELECT threshold, f1 AS max_f1 FROM f ORDER BY f1 DESC, threshold LIMIT 1""")
def best_f1_many_scores(spark, sf):
    return curves.best_f1(curves.score_curve(_many_scores(spark, sf), "score", "label"))


@query("backtest_counts_inclusive", f"""WITH {q.BASE}, {q.labelled(6)}, {out.BACKTEST_SQL}
  SELECT test_dt, COUNT(*) AS n_train, COUNT(*) FILTER (WHERE label = 1) AS train_positive
  FROM bt JOIN labelled ON pred_dt <= test_dt GROUP BY test_dt""")
def backtest_counts_inclusive(spark, sf):
    """Training rows when the test date itself is seen."""
    train, _ = assemble.backtest_rows(b.labelled(spark, sf), out.BACKTESTS, inclusive=True)
    return train.groupBy("test_dt").agg(F.count("*").alias("n_train"), F.count_if(F.col("label") == 1).alias("train_positive"))


@query("welch_p_value", f"""WITH {q.DOCS}, m AS (SELECT lang, (AVG(n_chars) FILTER (WHERE label = 1) - AVG(n_chars) FILTER (WHERE label = 0)) / 500 AS t
    FROM docs GROUP BY lang)
  SELECT lang, 1 AS df, ROUND(1 - 2 / pi() * atan(abs(t)), 9) + 0.0 AS p_value FROM m
  UNION ALL SELECT lang, 2, ROUND(1 - abs(t) / sqrt(2 + t * t), 9) + 0.0 FROM m
  UNION ALL SELECT lang, 4, ROUND(1 - 0.75 * abs(t) / sqrt(1 + t * t / 4) * (1 - t * t / (1 + t * t / 4) / 12), 9) + 0.0 FROM m""")
def welch_p_value(spark, sf):
    """Two-sided p-values of t statistics of the data where Student's distribution has a closed form."""
    mean = lambda y: F.avg(F.when(F.col("label") == y, F.col("n_chars")))
    t = b.scored_documents(spark, sf).groupBy("lang").agg(((mean(1) - mean(0)) / 500).alias("t"))
    rows = t.withColumn("df", F.explode(F.array(*[F.lit(n) for n in (1, 2, 4)])))
    return rows.select("lang", "df", (F.round(metrics.t_p_value("t", F.col("df").cast("double")), 9) + 0.0).alias("p_value"))


# --- compositions -----------------------------------------------------------


@query("censor_two_persons", f"""WITH {out.CENSORED} SELECT ent, CAST(month(pred_dt) AS BIGINT) AS person, pred_dt, label FROM stopped
  WHERE pred_dt <= stop_dt""")
def censor_two_persons(spark, sf):
    """Entities known under two person ids: one censoring date for all their rows."""
    rows = b.labelled(spark, sf, 12).select("ent", F.month("pred_dt").cast("bigint").alias("person"), "pred_dt", "label")
    return labels.censor_after_last_positive(rows, b.ENT).select("ent", "person", "pred_dt", "label")


@query("snapshot_two_persons", f"""WITH {q.BASE}, snap AS (SELECT ent, make_date(year(dt), 7, 1) AS start_dt,
    COUNT(*) FILTER (WHERE status = 'F') AS n_f, COUNT(*) FILTER (WHERE status = 'O') AS n_o FROM ord GROUP BY 1, 2),
  best AS (SELECT s.ent, s.pred_dt, MAX(start_dt) AS start_dt FROM spine s JOIN snap p ON s.ent = p.ent AND p.start_dt < s.pred_dt
    GROUP BY s.ent, s.pred_dt)
  SELECT ent, pred_dt, start_dt, n_f, n_o FROM best JOIN snap USING (ent, start_dt)""")
def snapshot_two_persons(spark, sf):
    """Snapshots counted under two person ids, reduced to one for each entity and date before they are looked up."""
    status = b.yearly_status(spark, sf).withColumn("person", F.length("priority"))
    counted = asof.snapshot_counts(status, ["ent", "person"], "status", ["F", "O"])
    known = counted.groupBy("ent", "start_dt").agg(F.sum("F").alias("n_f"), F.sum("O").alias("n_o"))
    return asof.latest_snapshot(b.spine(spark, sf), known, b.GRID, b.ENT).select("ent", "pred_dt", "start_dt", "n_f", "n_o")


#: Broken on purpose: prices of every seventh order, dates of every eleventh, no status in every thirteenth.
@query("csv_quarantine", """WITH o AS (SELECT *, o_orderkey % 7 = 0 AS p, o_orderkey % 11 = 0 AS d, o_orderkey % 13 = 0 AS s FROM orders)
  SELECT 'n_rows' AS what, COUNT(*) AS n FROM o UNION ALL SELECT 'n_rejected', COUNT(*) FILTER (WHERE p OR d OR s) FROM o
  UNION ALL SELECT 'n_malformed', 0 UNION ALL SELECT 'order_key', 0 UNION ALL SELECT 'price', COUNT(*) FILTER (WHERE p) FROM o
  UNION ALL SELECT 'day', COUNT(*) FILTER (WHERE d) FROM o UNION ALL SELECT 'status', COUNT(*) FILTER (WHERE s) FROM o
  UNION ALL SELECT 'kept', COUNT(*) FROM o WHERE NOT (p OR d OR s)
  UNION ALL SELECT 'lines of both', COUNT(*) FROM o WHERE p AND d""")
def csv_quarantine(spark, sf):
    """Orders written as CSV with broken values, loaded again: counts per column, rows kept, lines set aside."""
    key = F.col("o_orderkey")
    rows = b.table(spark, sf, "orders").select(
        key.alias("order_key"),
        F.when(key % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(key % 11 == 0, "31/31/1999").otherwise(F.to_date("o_orderdate").cast("string")).alias("day"),
        F.when(key % 13 != 0, F.col("o_orderstatus")).alias("status"),
    )
    path = scratch_path(spark, "csv")
    tables.write_table(rows, path, "csv")
    loaded = tables.load_csv(
        spark, path, "order_key long, price double, day date, status string", scratch_path(spark, "loaded"), ["status"]
    )
    told = spark.createDataFrame(list(loaded.counts.items()), "what string, n long")
    kept = loaded.rows.select(F.lit("kept").alias("what"))
    both = loaded.rejects.filter(F.array_contains("bad_columns", "price") & F.array_contains("bad_columns", "day"))
    found = kept.unionByName(both.select(F.lit("lines of both").alias("what"))).groupBy("what").agg(F.count("*").alias("n"))
    return told.unionByName(found)


@query("csv_mixed_headers", "SELECT o_orderkey AS order_key, o_custkey AS entity, o_orderstatus AS status FROM orders")
def csv_mixed_headers(spark, sf):
    """Two sets of files with another order of columns, read together by name."""
    rows = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("entity"), F.col("o_orderstatus").alias("status")
    )
    folder = scratch_path(spark, "csv")
    even = F.col("order_key") % 2 == 0
    tables.write_table(rows.filter(even), f"{folder}/a", "csv")
    tables.write_table(rows.filter(~even).select("status", "entity", "order_key"), f"{folder}/b", "csv")
    return tables.read_csv(spark, [f"{folder}/a", f"{folder}/b"], "order_key long, entity long, status string", mixed=True)


@query("partitioned_sink", f"""WITH {q.BASE} SELECT CAST(year(pred_dt) AS INTEGER) AS pred_yr, COUNT(*) AS n FROM spine GROUP BY 1""")
def partitioned_sink(spark, sf):
    """The spine written by year and read again."""
    rows = b.spine(spark, sf).select("ent", "pred_dt", F.year("pred_dt").alias("pred_yr"))
    path = scratch_path(spark, "spine")
    tables.write_table(rows, path, partition_by=["pred_yr"])
    return spark.read.parquet(path).groupBy("pred_yr").agg(F.count("*").alias("n"))
