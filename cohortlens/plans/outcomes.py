"""Queries: labels, assembly, splits, checks, survey cohort, sources."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from cohortlens.functions import dates
from cohortlens.operators import asof, assemble, fallback, labels, survey, windows
from cohortlens.operators.grid import Grid
from cohortlens.plans import bindings as b
from cohortlens.plans import features as feats
from cohortlens.plans import sql as q
from cohortlens.plans.registry import query
from cohortlens.session import materialise, scratch_path
from cohortlens.sources import tables

BACKTESTS = Grid(dt.date(1998, 1, 1), dt.date(2000, 7, 1), 6)
BACKTEST_SQL = """bt AS (SELECT CAST(g AS DATE) AS test_dt
  FROM generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '2000-07-01', INTERVAL 6 MONTH) t(g))"""

# --- labels -----------------------------------------------------------------


@query("first_event", f"WITH {q.ORD}, {q.SPAN}, {q.FIRST} SELECT * FROM firsts")
def first_event(spark, sf):
    return b.first_positive(spark, sf)


@query("class_lookup", """SELECT c_custkey AS ent, n_name, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 1 ELSE 0 END AS far
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def class_lookup(spark, sf):
    classes = labels.class_of(
        b.table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey"),
        b.table(spark, sf, "region"), "r_regionkey",
    ).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name",
        F.col("r_name").isin("ASIA", "EUROPE").cast("int").alias("far"),
    )
    customers = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("ent"), "c_nationkey")
    return labels.class_of(customers, classes, "c_nationkey").drop("c_nationkey").fillna(0, ["far"])


def _label_sql(horizon: int, unresolved: bool = False) -> str:
    return f"""WITH {q.BASE}, {q.labelled(horizon, unresolved)}
  SELECT ent, pred_dt, condition_start, label, prior FROM labelled"""


LABEL_COLUMNS = ["ent", "pred_dt", "condition_start", "label", "prior"]


@query("forward_label_6m", _label_sql(6))
def forward_label_6m(spark, sf):
    return b.labelled(spark, sf, 6).select(LABEL_COLUMNS)


@query("forward_label_12m", _label_sql(12))
def forward_label_12m(spark, sf):
    return b.labelled(spark, sf, 12).select(LABEL_COLUMNS)


@query("unresolved_label", _label_sql(12, True))
def unresolved_label(spark, sf):
    return b.labelled(spark, sf, 12, unresolved=True).select(LABEL_COLUMNS)


CENSORED = f"""{q.BASE}, {q.labelled(12)},
  stopped AS (SELECT ent, pred_dt, label, COALESCE(MAX(CASE WHEN label = 1 THEN pred_dt END) OVER (PARTITION BY ent), pred_dt)
    AS stop_dt FROM labelled)"""


@query("censor_after_last_positive", f"WITH {CENSORED} SELECT * FROM stopped WHERE pred_dt <= stop_dt")
def censor_after_last_positive(spark, sf):
    rows = b.labelled(spark, sf, 12).select("ent", "pred_dt", "label")
    return labels.censor_after_last_positive(rows, b.ENT).drop("depress_dt")


INTERVALS = """kept AS (SELECT *, COALESCE(MAX(CASE WHEN label = 1 THEN pred_dt END) OVER (PARTITION BY ent),
    MAX(pred_dt) OVER (PARTITION BY ent)) AS stop_dt FROM {source}),
  timed AS (SELECT * EXCLUDE (stop_dt), CAST(6 * ROW_NUMBER() OVER (PARTITION BY ent ORDER BY pred_dt) AS INTEGER) AS tstop
    FROM kept WHERE pred_dt <= stop_dt),
  spells_rows AS (SELECT *, CAST(tstop - 6 AS INTEGER) AS tstart FROM timed)"""


@query("survival_intervals", f"""WITH {q.SCORED}, {INTERVALS.format(source='scored')}
  SELECT ent, pred_dt, label, tstart, tstop FROM spells_rows""")
def survival_intervals(spark, sf):
    rows = b.scored_spine(spark, sf).select("ent", "pred_dt", "label")
    return labels.survival_intervals(rows, b.ENT).drop("stop_dt")


# --- checks -----------------------------------------------------------------


@query("label_qa_antijoin", f"""WITH {q.BASE}, {q.FIRST}, lab AS (SELECT DISTINCT ent FROM spine WHERE pred_dt < DATE '1997-01-01')
  SELECT DISTINCT f.ent, s.enrollment_start, f.condition_start FROM firsts f ANTI JOIN lab l ON f.ent = l.ent
  LEFT JOIN (SELECT DISTINCT ent, enrollment_start FROM spine) s ON f.ent = s.ent
  WHERE f.ent IN (SELECT ent FROM ord WHERE status IN ('F', 'O')) AND f.condition_start > s.enrollment_start + 60""")
def label_qa_antijoin(spark, sf):
    rows = b.spine(spark, sf)
    return labels.positives_outside_spine(
        b.first_positive(spark, sf), rows.filter(F.col("pred_dt") < "1997-01-01"), rows,
        b.orders(spark, sf), "ent", F.col("status").isin("F", "O"),
    )


@query("prior_positive_entities", f"""WITH {q.BASE}, {q.labelled(12)}
  SELECT COUNT(DISTINCT ent) AS n FROM labelled WHERE prior = 1""")
def prior_positive_entities(spark, sf):
    return labels.prior_positive_entities(b.labelled(spark, sf, 12), b.ENT)


@query("duplicate_keys", """SELECT l_orderkey, l_partkey, COUNT(*) AS n FROM lineitem
  GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1""")
def duplicate_keys(spark, sf):
    return fallback.duplicate_keys(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"])


@query("exclusive_violations", f"""WITH {feats.STATIC} SELECT student_id, person_id, pred_dt FROM hot
  WHERE lang_english + lang_spanish + lang_somali > 1""")
def exclusive_violations(spark, sf):
    flags = ["lang_english", "lang_spanish", "lang_somali"]
    hits = fallback.exclusive_violations(feats.static_attributes(spark, sf), flags)
    return hits.select("student_id", "person_id", "pred_dt")


@query("class_counts", f"""WITH {q.BASE}, {q.labelled(12)} SELECT CAST(year(pred_dt) AS INTEGER) AS pred_yr, label,
  COUNT(*) AS n FROM labelled GROUP BY 1, 2""")
def class_counts(spark, sf):
    return assemble.class_counts(b.labelled(spark, sf, 12), "label")


# --- assembly ---------------------------------------------------------------

MAIN_COLUMNS = [
    "ent", "pred_dt", "days_a", "days_n", "days_r", "urgent", "high", "low", "closed", "open",
    "urgent_in_yr", "urgent_ever", "n_f", "n_o", "n_p", *feats.SHARE_NAMES.values(), "tenure", "label",
]


def main_table(spark, sf):
    """All feature families on the spine, shares required, degenerate tenure dropped.

    Families that need no spine row of their own stay aggregates and meet the
    spine in the one join of ``assemble``; the label is made on the spine itself. The
    order lines feed two families and are the big side, so they are written once.
    """
    rows = materialise(b.spine(spark, sf), "spine")
    lines = materialise(b.graded_codes(b.items(spark, sf)), "lines")
    names = {"F": "n_f", "O": "n_o", "P": "n_p"}
    snapshots = asof.snapshot_counts(b.yearly_status(spark, sf), b.ENT, "status", list(names))
    flags = {"closed": F.col("status").isin("F", "P"), "open": F.col("status") == "O"}
    status = b.yearly_status(spark, sf)
    tables_ = [
        windows.window_distinct_days(None, lines, b.GRID, b.ENT, b.CODES).withColumnsRenamed(
            {c: f"days_{c.lower()}" for c in b.CODES}
        ),
        asof.ever_before_flags(rows, b.incidents(spark, sf), b.ENT, feats.EVER),
        asof.school_year_flags(None, status, b.ENT, flags),
        asof.current_and_ever(
            None, status, b.ENT, F.col("priority") == "1-URGENT", "urgent_in_yr", "urgent_ever"
        ),
        asof.latest_snapshot(None, snapshots.withColumnsRenamed(names), b.GRID, b.ENT).drop("start_dt"),
    ]
    base = b.labelled(spark, sf, rows=rows).select(
        "ent", "pred_dt", F.round(dates.years_between("enrollment_start", "pred_dt"), 6).alias("tenure"), "label"
    )
    out = assemble.assemble(
        base, tables_, [feats.grade_shares(spark, sf, rows, lines)], keys=b.ENT, nonzero=["tenure"]
    )
    return out.select(MAIN_COLUMNS)


def _cte(name: str) -> str:
    """The final SELECT of a registered feature query as a CTE of its own."""
    from cohortlens.plans.registry import ORACLES

    return f"{name} AS ({ORACLES[name]})"


_others = {
    "trailing_window_counts": ["days_a", "days_n", "days_r"],
    "ever_before_flags": ["urgent", "high", "low"],
    "school_year_flags": ["closed", "open"],
    "current_and_ever": ["urgent_in_yr", "urgent_ever"],
    "latest_snapshot_rank": ["n_f", "n_o", "n_p"],
    "forward_label_6m": ["label"],
}
MAIN_SQL = f"""{q.BASE}, {", ".join(_cte(n) for n in [*_others, "window_shares_with_lags"])},
  filled AS (SELECT s.ent, s.pred_dt,
    {", ".join(f"COALESCE({n}.{c}, 0) AS {c}" for n, cs in _others.items() for c in cs)},
    {", ".join(f"g.{c}" for c in feats.SHARE_NAMES.values())},
    ROUND({feats._fraction('s.enrollment_start', 's.pred_dt')}, 6) AS tenure
    FROM spine s JOIN window_shares_with_lags g ON s.ent = g.ent AND s.pred_dt = g.pred_dt
    {" ".join(f"LEFT JOIN {n} ON s.ent = {n}.ent AND s.pred_dt = {n}.pred_dt" for n in _others)}),
  main AS (SELECT * FROM filled WHERE tenure <> 0)"""


@query("assemble_main", f"WITH {MAIN_SQL} SELECT * FROM main")
def assemble_main(spark, sf):
    return main_table(spark, sf)


@query("temporal_split_counts", f"""WITH {q.BASE}, {q.labelled(12)}, split AS (SELECT label,
    CASE WHEN year(pred_dt) = 1996 THEN 'calibration' WHEN year(pred_dt) BETWEEN 1997 AND 1999 THEN 'train'
         WHEN year(pred_dt) BETWEEN 2000 AND 2001 THEN 'test' END AS split FROM labelled)
  SELECT split, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS ratio
  FROM split WHERE split IS NOT NULL GROUP BY split""")
def temporal_split_counts(spark, sf):
    parts = assemble.split_by_year(
        b.labelled(spark, sf, 12), train=(1997, 1999), test=(2000, 2001), calibration=(1996, 1996)
    )
    stacked = reduce(
        lambda a, c: a.unionByName(c), [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    )
    return assemble.split_ratios(stacked)


@query("hash_split", """SELECT c_custkey AS ent, CASE WHEN CAST(concat('0x',
  substr(md5(concat(CAST(c_custkey AS VARCHAR), '626')), 1, 8)) AS BIGINT) % 100 < 75 THEN 'train' ELSE 'test' END AS split
  FROM customer""")
def hash_split(spark, sf):
    customers = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("ent"))
    train, test = assemble.hash_split(customers, "ent")
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("rows_not_in", """SELECT o_custkey AS ent, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, o_orderpriority AS priority
  FROM orders EXCEPT SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, o_orderpriority FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01'""")
def rows_not_in(spark, sf):
    rows = b.orders(spark, sf).select(
        "ent", F.when(F.col("status") != "P", F.col("status")).alias("status"), "priority", "dt"
    )
    early = rows.filter(F.col("dt") < "2000-01-01").drop("dt")
    return assemble.rows_not_in(rows.drop("dt").distinct(), early)


@query("backtest_counts", f"""WITH {q.BASE}, {q.labelled(6)}, {BACKTEST_SQL}
  SELECT test_dt, COUNT(*) FILTER (WHERE pred_dt < test_dt) AS n_train, COUNT(*) FILTER (WHERE pred_dt = test_dt) AS n_test,
    COUNT(*) FILTER (WHERE pred_dt < test_dt AND label = 1) AS train_positive FROM bt JOIN labelled ON pred_dt <= test_dt
  GROUP BY test_dt""")
def backtest_counts(spark, sf):
    train, test = assemble.backtest_rows(b.labelled(spark, sf), BACKTESTS)
    seen = train.groupBy("test_dt").agg(
        F.count("*").alias("n_train"), F.count_if(F.col("label") == 1).alias("train_positive")
    )
    return seen.join(test.groupBy("test_dt").agg(F.count("*").alias("n_test")), "test_dt")


# --- survey -----------------------------------------------------------------


@query("survey_cohort", f"""WITH {q.ORD}, {q.SPAN}, {q.FIRST}, {q.ITEMS},
  answers AS (SELECT c_custkey AS ent, CASE WHEN c_nationkey < 8 THEN 'Male' WHEN c_nationkey < 16 THEN 'Female' END AS gender,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS race, c_acctbal AS answer FROM customer),
  lab AS (SELECT a.*, CASE WHEN f.ent IS NOT NULL THEN 1 ELSE 0 END AS depressive_disorder FROM answers a
    LEFT JOIN (SELECT * FROM firsts WHERE year(condition_start) > 1997) f ON a.ent = f.ent),
  demo AS (SELECT c_custkey AS ent, CASE WHEN c_nationkey % 3 = 0 THEN 'Brown' END AS code,
    CASE WHEN c_nationkey % 4 = 0 THEN 'F' END AS g2,
    CASE c_nationkey % 3 WHEN 0 THEN 'English' WHEN 1 THEN 'Spanish' END AS lang FROM customer),
  known AS (SELECT l.ent, answer, depressive_disorder, COALESCE(race, code) AS race,
    COALESCE(g2, CASE gender WHEN 'Male' THEN 'M' WHEN 'Female' THEN 'F' ELSE gender END) AS gender,
    CASE WHEN lang IS NULL THEN 'not_recorded' WHEN lang = 'English' THEN 'English' ELSE 'other' END AS language
    FROM lab l LEFT JOIN demo d ON l.ent = d.ent
    WHERE NOT (race IS NULL AND code IS NULL) AND NOT (gender IS NULL AND g2 IS NULL)),
  stat AS (SELECT ent, MAX(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS "F", MAX(CASE WHEN status = 'O' THEN 1 ELSE 0 END) AS "O"
    FROM ord WHERE year(dt) = 1999 GROUP BY ent),
  att AS (SELECT ent, COUNT(*) FILTER (WHERE ls = 'F') AS excused, COUNT(*) FILTER (WHERE ls <> 'F') AS unexcused
    FROM items WHERE year(dt) = 1999 AND code = 'A' GROUP BY ent),
  gr AS (SELECT ent, COUNT(*) AS total_courses, COUNT(*) FILTER (WHERE qty > 40) AS a_grades,
    COUNT(*) FILTER (WHERE qty > 20 AND qty <= 40) AS b_grades,
    COUNT(*) FILTER (WHERE NOT qty > 20 AND NOT qty <= 10) AS other_grades FROM items WHERE year(dt) = 1999 GROUP BY ent
    HAVING COUNT(*) FILTER (WHERE qty > 10) > 0)
  SELECT k.*, COALESCE("F", 0) AS "F", COALESCE("O", 0) AS "O", COALESCE(excused, 0) AS excused,
    COALESCE(unexcused, 0) AS unexcused, COALESCE(total_courses, 0) AS total_courses, COALESCE(a_grades, 0) AS a_grades,
    COALESCE(b_grades, 0) AS b_grades, COALESCE(other_grades, 0) AS other_grades FROM known k LEFT JOIN stat s ON k.ent = s.ent LEFT JOIN att a ON k.ent = a.ent
    LEFT JOIN gr g ON k.ent = g.ent""")
def survey_cohort(spark, sf):
    return survey_table(spark, sf)


def survey_table(spark, sf):
    nation = F.col("c_nationkey")
    customers = b.table(spark, sf, "customer")
    answers = customers.select(
        F.col("c_custkey").alias("ent"),
        F.when(nation < 8, "Male").when(nation < 16, "Female").alias("gender"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("race"),
        F.col("c_acctbal").alias("answer"),
    )
    demographics = customers.select(
        F.col("c_custkey").alias("ent"),
        F.when(nation % 3 == 0, "Brown").alias("race_ethnicity_code"),
        F.when(nation % 4 == 0, "F").alias("gender"),
        F.when(nation % 3 == 0, "English").when(nation % 3 == 1, "Spanish").alias("language"),
    )
    base = survey.respondent_demographics(
        survey.label_respondents(answers, b.first_positive(spark, sf), "ent", 1997), demographics, "ent"
    )
    lines = b.items(spark, sf)
    in_1999 = F.year("event_dt") == 1999
    attendance = lines.withColumns(
        {"status": F.col("category"), "excuse": F.when(F.col("line_status") == "F", "E").otherwise("U")}
    )
    scores = lines.withColumn(
        "score", F.when(F.col("qty") > 40, "A").when(F.col("qty") > 20, "B").when(F.col("qty") > 10, "D").otherwise("P")
    )
    return survey.survey_cohort(
        base,
        [
            survey.status_in_year(b.orders(spark, sf), "ent", F.year("dt") == 1999, ["F", "O"], "status"),
            survey.absences_in_year(attendance, "ent", in_1999),
            survey.grade_summary(scores, "ent", in_1999, families={"a_grades": ["A"], "b_grades": ["B"]}),
        ],
        "ent",
    )


# --- sources ----------------------------------------------------------------


@query("csv_round_trip", f"""WITH {q.ORD} SELECT o_orderkey AS order_key, ent AS entity, status AS order_status,
  CASE WHEN status <> 'O' THEN dt END AS order_date FROM ord""")
def csv_round_trip(spark, sf):
    """Order dates written as m/d/y text with spaced headers, read back typed and cleaned."""
    out = b.orders(spark, sf).select(
        F.col("o_orderkey").alias("Order Key"), F.col("ent").alias("Entity"), F.col("status").alias("orderStatus"),
        F.when(F.col("status") == "O", "no date").otherwise(F.date_format("dt", "M/d/yyyy")).alias("Order date"),
    )
    path = scratch_path(spark, "csv")
    tables.write_table(out, path, "csv")
    schema = "`Order Key` long, Entity long, orderStatus string, `Order date` string"
    back = tables.clean_names(tables.read_csv(spark, path, schema))
    return back.withColumn("order_date", dates.mdy("order_date"))


@query("sql_tables", f"""WITH {q.BASE} SELECT pred_dt, COUNT(*) AS n FROM spine GROUP BY pred_dt""")
def sql_tables(spark, sf):
    tables.as_tables({"spine_rows": b.spine(spark, sf)})
    return spark.sql("SELECT pred_dt, COUNT(*) AS n FROM spine_rows GROUP BY pred_dt")


@query("feature_catalogue", "SELECT column_name AS feature FROM (DESCRIBE SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem)")
def feature_catalogue(spark, sf):
    return tables.catalogue(assemble.without_pattern(b.table(spark, sf, "lineitem"), "tax|discount"))


@query("zero_fill_and_means", f"""WITH {q.SCORED} SELECT ROUND(AVG(days_a), 6) AS days_a, ROUND(AVG(days_r), 6) AS days_r,
  ROUND(AVG(score), 6) AS score, 15.0::DOUBLE AS age FROM scored WHERE label = 1""")
def zero_fill_and_means(spark, sf):
    from cohortlens.causal.scm import case_study

    rows = assemble.zero_fill(b.scored_spine(spark, sf))
    means = case_study(rows, F.col("label") == 1, ["days_a", "days_r", "score"], {"age": 15})
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


#: Lines whose windows one task keeps apart, however many lines there are.
LINES_A_TASK = 500_000


@query("lookback_share_rows", f"""WITH {q.BASE}, {q.ITEMS} SELECT ent, pred_dt,
  CAST(COUNT(*) FILTER (WHERE code = 'A') AS DOUBLE) / COUNT(*) AS share_a FROM (
  SELECT DISTINCT s.ent, s.pred_dt, code, l_orderkey, l_linenumber FROM spine s JOIN items i ON s.ent = i.ent
    AND i.dt BETWEEN s.pred_dt - INTERVAL 12 MONTH AND s.pred_dt) GROUP BY ent, pred_dt""")
def lookback_share_rows(spark, sf):
    """A window twice as long as the grid step."""
    lines = b.table(spark, sf, "lineitem").count()  # read from the file footers
    return windows.window_shares(
        b.spine(spark, sf), b.items(spark, sf), b.GRID, b.ENT, {"A": "share_a"}, "event_dt", "category",
        ["l_orderkey", "l_linenumber"], length=12, tasks=lines // LINES_A_TASK + 1,
    )
