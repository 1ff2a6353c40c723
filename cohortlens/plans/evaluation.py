"""Queries: curves, thresholds, metrics, fairness, report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.causal import dag
from cohortlens.evaluation import curves, metrics
from cohortlens.operators import labels
from cohortlens.plans import bindings as b
from cohortlens.plans import outcomes as out
from cohortlens.plans import sql as q
from cohortlens.plans.registry import query

SCORED_CURVE = f"WITH {q.SCORED}, {q.curve('scored', 'pred_dt')}"
DOC_CURVE = f"WITH {q.DOCS}, {q.curve('docs', '')}"
DATE = ["pred_dt"]


def _round(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _scored_curve(spark, sf):
    return curves.score_curve(b.scored_spine(spark, sf), "score", "label", DATE)


@query("roc_curve", f"""{SCORED_CURVE} SELECT pred_dt, threshold, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr,
  CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr FROM curve
  UNION ALL SELECT DISTINCT pred_dt, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM curve""")
def roc_curve(spark, sf):
    return curves.roc_points(_scored_curve(spark, sf), DATE)


@query("pr_curve", f"""{SCORED_CURVE} SELECT pred_dt, threshold, CAST(tp AS DOUBLE) / NULLIF(p, 0) AS recall,
  CAST(tp AS DOUBLE) / (tp + fp) AS precision FROM curve
  UNION ALL SELECT DISTINCT pred_dt, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 1.0::DOUBLE FROM curve""")
def pr_curve(spark, sf):
    return curves.pr_points(_scored_curve(spark, sf), DATE)


@query("roc_curve_reduced", f"""{SCORED_CURVE}, l AS (SELECT *, LEAD(pos) OVER (PARTITION BY pred_dt ORDER BY threshold DESC) AS np,
    LEAD(neg) OVER (PARTITION BY pred_dt ORDER BY threshold DESC) AS nn,
    ROW_NUMBER() OVER (PARTITION BY pred_dt ORDER BY threshold DESC) AS i FROM curve)
  SELECT pred_dt, threshold, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr, CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr FROM l
    WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg
  UNION ALL SELECT DISTINCT pred_dt, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM curve""")
def roc_curve_reduced(spark, sf):
    return curves.roc_points(_scored_curve(spark, sf), DATE, drop_collinear=True)


@query("roc_curve_documents", f"""{DOC_CURVE} SELECT threshold, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr,
  CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr FROM curve UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_curve_documents(spark, sf):
    return curves.roc_points(curves.score_curve(b.scored_documents(spark, sf), "score", "label"))


AREAS = """SELECT {k} ROUND(SUM(CAST(neg AS DOUBLE) * (tp - pos / 2.0)) / NULLIF(CAST(ANY_VALUE(p) AS DOUBLE) * ANY_VALUE(n), 0), 6)
  AS auroc, ROUND(SUM(pos * (CAST(tp AS DOUBLE) / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN 1
  ELSE CAST(tp - pos AS DOUBLE) / (tp - pos + fp - neg) END) / 2) / NULLIF(ANY_VALUE(p), 0), 6) AS auprc FROM curve {g}"""


# ranks say the same as areas, by another road
@query("auroc", f"""WITH {q.SCORED}, r AS (SELECT pred_dt, label, RANK() OVER (PARTITION BY pred_dt ORDER BY score)
    + (COUNT(*) OVER (PARTITION BY pred_dt, score) - 1) / 2.0 AS mean_rank FROM scored),
  s AS (SELECT pred_dt, SUM(CASE WHEN label = 1 THEN mean_rank END) AS rs, COUNT(*) FILTER (WHERE label = 1) AS p,
    COUNT(*) FILTER (WHERE label = 0) AS n FROM r GROUP BY pred_dt)
  SELECT pred_dt, ROUND(CAST((rs - p * (p + 1) / 2.0) AS DOUBLE) / NULLIF(p * n, 0), 6) AS auroc FROM s""")
def auroc(spark, sf):
    areas = curves.areas(_scored_curve(spark, sf), DATE)
    return _round(areas.select("pred_dt", "auroc"), "auroc")


@query("auprc", f"{SCORED_CURVE} SELECT pred_dt, auprc FROM ({AREAS.format(k='pred_dt,', g='GROUP BY pred_dt')})")
def auprc(spark, sf):
    return _round(curves.areas(_scored_curve(spark, sf), DATE).select("pred_dt", "auprc"), "auprc")


@query("areas_documents", f"{DOC_CURVE} {AREAS.format(k='', g='')}")
def areas_documents(spark, sf):
    curve = curves.score_curve(b.scored_documents(spark, sf), "score", "label")
    return _round(curves.areas(curve), "auroc", "auprc")


SWEEP = f"""WITH {q.SCORED}, lim AS (SELECT pred_dt, MIN(score) AS lo, MAX(score) AS hi FROM scored GROUP BY pred_dt),
  thr AS (SELECT pred_dt, lo + k * CAST(0.05 AS DOUBLE) AS threshold FROM (SELECT pred_dt, lo,
    UNNEST(generate_series(0, CAST(FLOOR((hi - lo) / 0.05 + 1e-10) AS BIGINT))) AS k FROM lim)),
  swept AS (SELECT t.pred_dt, t.threshold, COUNT(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
    COUNT(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp, COUNT(*) FILTER (WHERE label = 1) AS p,
    COUNT(*) FILTER (WHERE label = 0) AS n FROM thr t JOIN scored s ON t.pred_dt = s.pred_dt GROUP BY 1, 2),
  sweep AS (SELECT pred_dt, threshold, tp, fp, CAST(tp AS DOUBLE) / NULLIF(p, 0) AS sensitivity,
    CAST(n - fp AS DOUBLE) / NULLIF(n, 0) AS specificity,
    CAST(tp AS DOUBLE) / NULLIF(p, 0) + CAST(n - fp AS DOUBLE) / NULLIF(n, 0) - 1 AS j_index FROM swept)"""


@query("threshold_sweep", f"{SWEEP} SELECT pred_dt, ROUND(threshold, 6) AS threshold, tp, fp, sensitivity, specificity, "
       "ROUND(j_index, 6) AS j_index FROM sweep")
def threshold_sweep(spark, sf):
    sweep = curves.threshold_sweep(b.scored_spine(spark, sf), "score", "label", 0.05, DATE)
    return _round(sweep, "threshold", "j_index")


@query("best_j_threshold", f"""{SWEEP}, best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY pred_dt
    ORDER BY j_index DESC NULLS LAST, threshold) AS r FROM sweep)
  SELECT pred_dt, ROUND(threshold, 6) AS threshold, ROUND(j_index, 6) AS j_index FROM best WHERE r = 1""")
def best_j_threshold(spark, sf):
    sweep = curves.threshold_sweep(b.scored_spine(spark, sf), "score", "label", 0.05, DATE)
    return _round(curves.best_threshold(sweep, keys=DATE), "threshold", "j_index")


F1 = """f1s AS (SELECT *, COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(p + tp + fp, 0), 0) AS f1 FROM curve),
  best AS (SELECT pred_dt, threshold, f1 AS max_f1 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pred_dt
    ORDER BY f1 DESC, threshold) AS r FROM f1s) WHERE r = 1)"""


@query("best_f1", f"{SCORED_CURVE}, {F1} SELECT * FROM best")
def best_f1(spark, sf):
    return curves.best_f1(_scored_curve(spark, sf), DATE)


CELLS = """cells AS (SELECT {k} COUNT(*) FILTER (WHERE label = 0 AND predict = 0) AS tn,
  COUNT(*) FILTER (WHERE label = 0 AND predict = 1) AS fp, COUNT(*) FILTER (WHERE label = 1 AND predict = 0) AS fn,
  COUNT(*) FILTER (WHERE label = 1 AND predict = 1) AS tp FROM {source} {g})"""
RATES = """COALESCE(CAST(tp + tn AS DOUBLE) / NULLIF(tn + fp + fn + tp, 0), 0) AS accuracy,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall,
  COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0) AS f1"""
LOGLOSS = "ROUND((fp + fn) * -LN(2.220446049250313e-16) / NULLIF(tn + fp + fn + tp, 0), 6) AS logloss"


@query("confusion", f"""WITH {q.SCORED}, hard AS (SELECT *, CASE WHEN score >= 0.4 THEN 1 ELSE 0 END AS predict FROM scored),
  {CELLS.format(k='pred_dt,', source='hard', g='GROUP BY pred_dt')} SELECT *, {RATES} FROM cells""")
def confusion(spark, sf):
    hard = curves.binarise(b.scored_spine(spark, sf), "score", 0.4)
    return metrics.confusion(hard, "label", "predict", DATE).withColumns(metrics.rates())


@query("metric_board", f"""{SCORED_CURVE}, hard AS (SELECT *, CASE WHEN score > 0.4 THEN 1 ELSE 0 END AS predict FROM scored),
  {CELLS.format(k='pred_dt,', source='hard', g='GROUP BY pred_dt')},
  area AS ({AREAS.format(k='pred_dt,', g='GROUP BY pred_dt')})
  SELECT c.*, {RATES}, {LOGLOSS}, auroc, auprc FROM cells c JOIN area a ON c.pred_dt = a.pred_dt""")
def metric_board(spark, sf):
    hard = curves.binarise(b.scored_spine(spark, sf), "score", 0.4, strict=True)
    return _round(metrics.metric_board(hard, "score", "label", "predict", DATE), "logloss", "auroc", "auprc")


@query("best_f1_board", f"""WITH {q.SCORED}, lim AS (SELECT pred_dt, MIN(score) AS lo, MAX(score) AS hi FROM scored GROUP BY pred_dt),
  scaled AS (SELECT s.pred_dt, label, COALESCE((score - lo) / NULLIF(hi - lo, 0), 0) AS score FROM scored s
    JOIN lim l ON s.pred_dt = l.pred_dt), {q.curve('scaled', 'pred_dt')}, {F1},
  hard AS (SELECT s.pred_dt, label, CASE WHEN score > threshold THEN 1 ELSE 0 END AS predict FROM scaled s
    JOIN best t ON s.pred_dt = t.pred_dt),
  {CELLS.format(k='pred_dt,', source='hard', g='GROUP BY pred_dt')},
  area AS ({AREAS.format(k='pred_dt,', g='GROUP BY pred_dt')})
  SELECT c.*, b.threshold, max_f1, {RATES}, {LOGLOSS}, auroc, auprc FROM cells c
    JOIN area a ON c.pred_dt = a.pred_dt JOIN best b ON c.pred_dt = b.pred_dt""")
def best_f1_board(spark, sf):
    board = metrics.best_f1_board(b.scored_spine(spark, sf), "score", "label", DATE)
    return _round(board, "logloss", "auroc", "auprc")


@query("log_loss", f"""WITH {q.DOCS}, c AS (SELECT lang, label, LEAST(GREATEST(score, 2.220446049250313e-16),
    1 - 2.220446049250313e-16) AS p FROM docs)
  SELECT lang, ROUND(AVG(-(label * LN(p) + (1 - label) * LN(1 - p))), 6) AS log_loss FROM c GROUP BY lang""")
def log_loss(spark, sf):
    return _round(metrics.log_loss(b.scored_documents(spark, sf), "label", "score", ["lang"]), "log_loss")


@query("welch_t", f"""WITH {q.SCORED}, m AS (SELECT COUNT(*) FILTER (WHERE label = 0) AS n0, COUNT(*) FILTER (WHERE label = 1) AS n1,
    AVG(score) FILTER (WHERE label = 0) AS mean0, AVG(score) FILTER (WHERE label = 1) AS mean1,
    VAR_SAMP(score) FILTER (WHERE label = 0) AS v0, VAR_SAMP(score) FILTER (WHERE label = 1) AS v1 FROM scored)
  SELECT n0, n1, ROUND(mean0, 6) AS mean0, ROUND(mean1, 6) AS mean1, ROUND((mean0 - mean1) / SQRT(v0 / n0 + v1 / n1), 6) AS t,
    ROUND(POW(v0 / n0 + v1 / n1, 2) / (POW(v0 / n0, 2) / (n0 - 1) + POW(v1 / n1, 2) / (n1 - 1)), 4) AS df FROM m""")
def welch_t(spark, sf):
    test = metrics.welch_t(b.scored_spine(spark, sf), "score", "label", p_value=False)
    return _round(test, "mean0", "mean1", "t").withColumn("df", F.round("df", 4))


@query("season_summary", f"""{SCORED_CURVE}, area AS ({AREAS.format(k='pred_dt,', g='GROUP BY pred_dt')}),
  long AS (SELECT pred_dt, 'auroc' AS metric, auroc AS value FROM area UNION ALL SELECT pred_dt, 'auprc', auprc FROM area)
  SELECT 'fixed' AS model_id, CAST(month(pred_dt) AS INTEGER) AS season_month, metric, ROUND(AVG(value), 5) AS mean,
    MIN(value) AS min, MAX(value) AS max, COUNT(value) AS n FROM long GROUP BY month(pred_dt), metric""")
def season_summary(spark, sf):
    areas = _round(curves.areas(_scored_curve(spark, sf), DATE), "auroc", "auprc").withColumn("model_id", F.lit("fixed"))
    summary = metrics.season_summary(areas, ["auroc", "auprc"], test="pred_dt")
    return summary.withColumn("mean", F.round("mean", 5))


HISTORY = f"""WITH {q.SCORED}, hist AS (SELECT ent, pred_dt, label, score, MAX(label) OVER (PARTITION BY ent) AS ever_positive,
    LAG(score) OVER (PARTITION BY ent ORDER BY pred_dt) AS previous_score,
    LEAD(label) OVER (PARTITION BY ent ORDER BY pred_dt) AS next_label FROM scored)"""


def _history(spark, sf):
    rows = b.scored_spine(spark, sf).select("ent", "pred_dt", "label", "score")
    return metrics.score_history(rows, b.ENT, "score", "label", "pred_dt")


@query("score_history", f"{HISTORY} SELECT * FROM hist")
def score_history(spark, sf):
    return _history(spark, sf)


@query("before_or_at_event", f"{HISTORY} SELECT * FROM hist WHERE label = 1 OR next_label = 1")
def before_or_at_event(spark, sf):
    return metrics.before_or_at_event(_history(spark, sf), "label")


@query("caught_positives", f"""WITH {q.SCORED} SELECT ent, pred_dt, score FROM scored
  WHERE pred_dt = DATE '1999-01-01' AND label = 1 AND score >= 0.4""")
def caught_positives(spark, sf):
    hard = curves.binarise(b.scored_spine(spark, sf), "score", 0.4)
    return metrics.caught_positives(hard, "1999-01-01", "label", "predict", "pred_dt").select("ent", "pred_dt", "score")


@query("first_detection", f"""{SCORED_CURVE} SELECT pred_dt, tp AS num_tps_at_rank, MAX(threshold) AS first_detection,
  MIN(tp + fp - pos - neg + 1) AS pred_rank, CAST(SUM(pos + neg) AS BIGINT) AS n_rows FROM curve GROUP BY pred_dt, tp""")
def first_detection(spark, sf):
    return curves.first_detection(_scored_curve(spark, sf), DATE)


@query("concordance", f"""WITH {q.SCORED}, {out.INTERVALS.format(source='scored')},
  pairs AS (SELECT a.tstop, a.score AS es, c.score AS cs FROM spells_rows a JOIN spells_rows c ON a.tstop = c.tstop
    AND a.label = 1 AND c.label = 0)
  SELECT CAST(COUNT(*) FILTER (WHERE es > cs) AS DOUBLE) AS concordant, CAST(COUNT(*) FILTER (WHERE es = cs) AS DOUBLE) AS tied,
    CAST(COUNT(*) AS DOUBLE) AS pairs, ROUND((COUNT(*) FILTER (WHERE es > cs) + COUNT(*) FILTER (WHERE es = cs) / 2.0)
    / COUNT(*), 6) AS concordance FROM pairs""")
def concordance(spark, sf):
    rows = labels.survival_intervals(b.scored_spine(spark, sf), b.ENT)
    return _round(metrics.concordance(rows, "score", "label"), "concordance")


@query("concordance_error", f"""WITH {q.SCORED}, {out.INTERVALS.format(source='scored')},
  pairs AS (SELECT a.ent AS one, c.ent AS other, CASE WHEN a.score > c.score THEN 1.0 WHEN a.score = c.score THEN 0.5 ELSE 0.0 END AS v
    FROM spells_rows a JOIN spells_rows c ON a.tstop = c.tstop AND a.label = 1 AND c.label = 0),
  sides AS (SELECT one AS ent, v FROM pairs UNION ALL SELECT other, v FROM pairs),
  own AS (SELECT ent, CAST(SUM(v) AS DOUBLE) AS won, CAST(COUNT(*) AS DOUBLE) AS n FROM sides GROUP BY ent),
  total AS (SELECT SUM(won) / SUM(n) AS c, SUM(n) / 2 AS pairs, COUNT(*) AS entities FROM own)
  SELECT entities, pairs, ROUND(c, 6) AS concordance, ROUND(SQRT(SUM((won - c * n) * (won - c * n))) / pairs, 9) AS std_error
  FROM own, total GROUP BY entities, pairs, c""")
def concordance_error(spark, sf):
    rows = labels.survival_intervals(b.scored_spine(spark, sf), b.ENT)
    found = metrics.concordance_error(rows, "score", "label", "ent")
    return _round(found, "concordance").withColumn("std_error", F.round("std_error", 9))


# --- fairness ---------------------------------------------------------------

GROUPS = f"""WITH {q.DOCS}, hard AS (SELECT *, CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS predict FROM docs),
  long AS (SELECT label, predict, 'lang' AS feature, lang AS "group" FROM hard
    UNION ALL SELECT label, predict, 'source', source FROM hard
    UNION ALL SELECT label, predict, 'toxic', CAST(toxic AS VARCHAR) FROM hard),
  {CELLS.format(k='feature, "group",', source='long', g='GROUP BY feature, "group"')}"""
FEATURES = ["lang", "source", "toxic"]


def _hard_documents(spark, sf):
    return curves.binarise(b.scored_documents(spark, sf), "score", 0.3)


@query("metrics_by_group", f"""{GROUPS} SELECT feature, "group", f1, recall, precision FROM (SELECT *, {RATES} FROM cells)""")
def metrics_by_group(spark, sf):
    return metrics.metrics_by_group(_hard_documents(spark, sf), "label", "predict", FEATURES)


@query("fairness_gaps", f"""{GROUPS}, m AS (SELECT feature, CAST(tp + fp AS DOUBLE) / (tn + fp + fn + tp) AS sel,
    COALESCE(CAST(fp AS DOUBLE) / NULLIF(fp + tn, 0), 0) AS fpr, {RATES} FROM cells)
  SELECT feature, MAX(sel) - MIN(sel) AS demographic_parity_diff,
    GREATEST(MAX(recall) - MIN(recall), MAX(fpr) - MIN(fpr)) AS eq_odds_diff,
    LEAST(MIN(recall) / NULLIF(MAX(recall), 0), MIN(fpr) / NULLIF(MAX(fpr), 0)) AS eq_odds_ratio,
    MIN(f1) AS f1_min, MAX(recall) AS recall_max, MAX(recall) - MIN(recall) AS recall_diff,
    MIN(recall) / NULLIF(MAX(recall), 0) AS recall_ratio, MIN(precision) AS precision_min FROM m GROUP BY feature""")
def fairness_gaps(spark, sf):
    return metrics.fairness_gaps(_hard_documents(spark, sf), "label", "predict", FEATURES)


# --- report tables ----------------------------------------------------------


@query("importance_summary", """SELECT p_type, feature, ROUND(AVG(v), 6) AS mean_imp, ROUND(STDDEV_SAMP(v), 6) AS sd_imp
  FROM (SELECT p_type, 'p_size' AS feature, CAST(p_size AS DOUBLE) AS v FROM part
  UNION ALL SELECT p_type, 'p_retailprice', p_retailprice FROM part) GROUP BY p_type, feature""")
def importance_summary(spark, sf):
    wide = b.table(spark, sf, "part").select("p_type", F.col("p_size").cast("double"), "p_retailprice")
    return _round(metrics.importance_summary(wide, ["p_size", "p_retailprice"], ["p_type"]), "mean_imp", "sd_imp")


@query("stacked_roc", f"""{SCORED_CURVE}, fam AS (
    SELECT CAST(tp AS DOUBLE) / NULLIF(p, 0) AS tpr, CAST(fp AS DOUBLE) / NULLIF(n, 0) AS fpr,
      'PUL-' || substr(CAST(pred_dt AS VARCHAR), 3, 5) AS model_name FROM curve
    UNION ALL SELECT CAST(tp AS DOUBLE) / NULLIF(p, 0), 1 - (1 - CAST(fp AS DOUBLE) / NULLIF(n, 0)),
      'Cox-' || substr(CAST(pred_dt AS VARCHAR), 3, 5) FROM curve
    UNION ALL SELECT CAST(tp AS DOUBLE) / NULLIF(p, 0), CAST(fp AS DOUBLE) / NULLIF(n, 0),
      CASE WHEN month(pred_dt) = 1 THEN 'linear' ELSE 'GBM-2' END FROM curve)
  SELECT ROUND(tpr, 6) AS tpr, ROUND(fpr, 6) AS fpr, model_name,
    model_name LIKE 'PUL%' AS is_champion, CASE WHEN model_name LIKE 'PUL%' THEN model_name ELSE 'others' END AS shown_as
  FROM fam""")
def stacked_roc(spark, sf):
    curve = _scored_curve(spark, sf)
    points = curve.select(
        F.col("pred_dt").alias("test_dt"),
        F.try_divide("fp", "n").alias("fpr"),
        F.try_divide("tp", "p").alias("tpr"),
    )
    cox = points.select("test_dt", (1 - F.col("fpr")).alias("specificity"), F.col("tpr").alias("sensitivity"))
    ids = F.when(F.month("test_dt") == 1, "GLM_1").otherwise("GBM_2")  # as the boards of this library name them
    named = points.withColumn("model_id", ids).withColumn(
        "model_name",
        metrics.contender_name("model_id", "^[A-Za-z]+", "_[0-9]+$", {("GLM", "_1"): "linear"}, ["Stack"]),
    )
    return _round(metrics.stacked_roc({"PUL": points, "Cox": cox, "board": named}, "PUL"), "tpr", "fpr")


EDGES = """edges AS (SELECT n_name AS "from", r_name AS "to",
  CASE WHEN n_nationkey % 5 <> 4 THEN 'Edge Coef.' ELSE 'Std. Error' END AS type FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT r_name, 'NATION_0', 'Edge Coef.' FROM region WHERE r_regionkey > 0),
  nodes AS (SELECT label, ROW_NUMBER() OVER (ORDER BY label) AS id FROM (SELECT DISTINCT
    CASE WHEN label = 'ASIA' THEN 'ASIA_12M' ELSE label END AS label FROM
    (SELECT "from" AS label FROM edges UNION ALL SELECT "to" FROM edges))),
  named AS (SELECT CASE WHEN "from" = 'ASIA' THEN 'ASIA_12M' ELSE "from" END AS from_nm,
    CASE WHEN "to" = 'ASIA' THEN 'ASIA_12M' ELSE "to" END AS to_nm FROM edges WHERE type = 'Edge Coef.')"""


def _edges(spark, sf):
    nation, region = b.table(spark, sf, "nation"), b.table(spark, sf, "region")
    down = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("from"), F.col("r_name").alias("to"),
        F.when(F.col("n_nationkey") % 5 != 4, "Edge Coef.").otherwise("Std. Error").alias("type"),
    )
    up = region.filter("r_regionkey > 0").select(
        F.col("r_name").alias("from"), F.lit("NATION_0").alias("to"), F.lit("Edge Coef.").alias("type")
    )
    edges = down.unionByName(up)
    nodes = dag.dag_nodes(edges, "ASIA", "ASIA_12M")
    return dag.dag_edges(edges, nodes, "ASIA", "ASIA_12M"), nodes


@query("dag_nodes", f"WITH {EDGES} SELECT * FROM nodes")
def dag_nodes(spark, sf):
    return _edges(spark, sf)[1]


@query("dag_edges", f"""WITH {EDGES} SELECT from_nm, to_nm, a.id AS "from", z.id AS "to" FROM named
  LEFT JOIN nodes a ON from_nm = a.label LEFT JOIN nodes z ON to_nm = z.label""")
def dag_edges(spark, sf):
    return _edges(spark, sf)[0]


@query("dag_neighbours", f"""WITH {EDGES} SELECT from_nm AS label, 'parent' AS role FROM named WHERE to_nm = 'ASIA_12M'
  UNION ALL SELECT to_nm, 'child' FROM named WHERE from_nm = 'ASIA_12M'""")
def dag_neighbours(spark, sf):
    return dag.neighbours(_edges(spark, sf)[0], "ASIA_12M")


@query("model_names", """SELECT p_partkey, split_part(p_name, ' ', 1) AS model_type,
  split_part(p_name, ' ', 2) || '_' || CAST(p_size AS VARCHAR) AS experiment FROM part""")
def model_names(spark, sf):
    named = b.table(spark, sf, "part").select(
        "p_partkey", F.concat(F.translate("p_name", " ", "_"), F.lit("_"), "p_size").alias("model_id")
    )
    return named.select(
        "p_partkey", metrics.model_type().alias("model_type"), metrics.experiment_id("model_id").alias("experiment")
    )
