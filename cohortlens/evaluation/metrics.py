"""Confusion cells, metrics, boards, fairness, tests and report tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.evaluation import curves
from cohortlens.session import materialise

CELLS = ("tn", "fp", "fn", "tp")
# clipping constant of hard predictions: the spacing of doubles at 1
EPSILON = 2.220446049250313e-16


def confusion(df: DataFrame, label: str, predict: str, keys: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(predict)
    return df.groupBy(*keys).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _or_empty(value: Column, empty: float | None) -> Column:
    return value if empty is None else F.coalesce(value, F.lit(empty))


def rates(empty: float | None = 0.0) -> dict[str, Column]:
    """Metrics of confusion columns. ``empty`` replaces a 0 / 0 (None keeps it null)."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    return {
        "accuracy": _or_empty(F.try_divide(tp + tn, tn + fp + fn + tp), empty),
        "precision": _or_empty(F.try_divide(tp, tp + fp), empty),
        "recall": _or_empty(F.try_divide(tp, tp + fn), empty),
        "f1": _or_empty(F.try_divide(2 * tp, 2 * tp + fp + fn), empty),
    }


def hard_log_loss(eps: float = EPSILON) -> Column:
    """Log loss of 0/1 predictions from confusion columns."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    wrong, right = -math.log(eps), -math.log1p(-eps)
    return F.try_divide((fp + fn) * F.lit(wrong) + (tp + tn) * F.lit(right), tn + fp + fn + tp)


def log_loss(df: DataFrame, label: str, probability: str, keys: Sequence[str] = (), eps: float = EPSILON) -> DataFrame:
    """Log loss of probabilities, clipped to ``[eps, 1 - eps]``."""
    p = F.least(F.greatest(F.col(probability).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    return df.groupBy(*keys).agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def metric_board(
    df: DataFrame, score: str, label: str, predict: str, keys: Sequence[str], empty: float | None = 0.0
) -> DataFrame:
    """One row per group: cells, rates, hard log loss, AUROC, AUPRC.

    Rows are read once, into counts per (group, score, prediction); cells and
    curve both come from the counts.
    """
    is_one, is_zero = F.col(label) == 1, F.col(label) == 0
    counts = materialise(
        df.groupBy(*keys, F.col(score).cast("double").alias("score"), F.col(predict).alias("_predict")).agg(
            F.count_if(is_one).alias("pos"), F.count_if(is_zero).alias("neg")
        ),
        "counts",
    )

    def cell(n: str, p: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_predict") == p, F.col(n))), F.lit(0))

    cells = counts.groupBy(*keys).agg(
        cell("neg", 0).alias("tn"), cell("neg", 1).alias("fp"), cell("pos", 0).alias("fn"), cell("pos", 1).alias("tp")
    )
    scores = counts.filter(F.col("score").isNotNull()).groupBy(*keys, "score").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    area = curves.areas(curves.curve_of_counts(scores, keys), keys)
    board = cells.withColumns({**rates(empty), "logloss": hard_log_loss()})
    return curves.attach_by_key(board, area, keys)


def best_f1_board(df: DataFrame, score: str, label: str, keys: Sequence[str], scale: bool = True,
                  strict: bool = True) -> DataFrame:
    """The whole evaluation of one run: scale, pick the best-F1 threshold, binarise, report.

    Cells follow from the curve itself, so the rows are read once.
    """
    curve = curves.score_curve(df, score, label, keys, scale)
    best = curves.best_f1(curve, keys).withColumnRenamed("threshold", "_t")
    above = F.col("threshold") > F.col("_t") if strict else F.col("threshold") >= F.col("_t")
    tp = F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0))
    fp = F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0))
    cells = (
        curves.attach_by_key(curve, best, keys)
        .groupBy(*keys)
        .agg(
            F.first("_t").alias("threshold"),
            F.first("max_f1").alias("max_f1"),
            (F.first("n") - fp).alias("tn"),
            fp.alias("fp"),
            (F.first("p") - tp).alias("fn"),
            tp.alias("tp"),
        )
        .withColumns({**rates(), "logloss": hard_log_loss()})
    )
    return curves.attach_by_key(cells, curves.areas(curve, keys), keys)


# --- fairness ---------------------------------------------------------------


def group_cells(df: DataFrame, label: str, predict: str, features: Sequence[str]) -> DataFrame:
    """Confusion cells per (feature, group).

    Rows shrink to one per combination of groups before they are unpivoted.
    """
    joint = confusion(df.select(label, predict, *[F.col(f).cast("string").alias(f) for f in features]),
                      label, predict, features)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("group")) for f in features])
    ).alias("_pair")
    return (
        joint.select(pairs, *CELLS)
        .groupBy("_pair.feature", "_pair.group")
        .agg(*[F.sum(c).alias(c) for c in CELLS])
    )


def metrics_by_group(df: DataFrame, label: str, predict: str, features: Sequence[str]) -> DataFrame:
    """F1, recall and precision per (feature, group)."""
    r = rates()
    return group_cells(df, label, predict, features).select(
        "feature", "group", r["f1"].alias("f1"), r["recall"].alias("recall"), r["precision"].alias("precision")
    )


def fairness_gaps(df: DataFrame, label: str, predict: str, features: Sequence[str]) -> DataFrame:
    """Differences and ratios between the groups of each feature."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    r = rates()
    measured = group_cells(df, label, predict, features).select(
        "feature",
        F.try_divide(tp + fp, tn + fp + fn + tp).alias("selected"),
        F.coalesce(F.try_divide(fp, fp + tn), F.lit(0.0)).alias("fpr"),
        *[r[m].alias(m) for m in ("f1", "recall", "precision")],
    )

    def gap(m: str) -> Column:
        return F.max(m) - F.min(m)

    def ratio(m: str) -> Column:
        return F.try_divide(F.min(m), F.max(m))

    return measured.groupBy("feature").agg(
        gap("selected").alias("demographic_parity_diff"),
        F.greatest(gap("recall"), gap("fpr")).alias("eq_odds_diff"),
        F.least(ratio("recall"), ratio("fpr")).alias("eq_odds_ratio"),
        F.min("f1").alias("f1_min"),
        F.max("recall").alias("recall_max"),
        gap("recall").alias("recall_diff"),
        ratio("recall").alias("recall_ratio"),
        F.min("precision").alias("precision_min"),
    )


# --- back-test summaries ----------------------------------------------------


def season_summary(
    board: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("model_id",), test: str = "test_dt"
) -> DataFrame:
    """Mean, min and max of each metric over the back-tests of a season (month of the test date)."""
    long = board.withColumn("season_month", F.month(test)).unpivot(
        [*keys, "season_month"], list(metrics), "metric", "value"
    )
    return long.groupBy(*keys, "season_month", "metric").agg(
        F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count("value").alias("n"),
    )


def score_history(
    df: DataFrame, keys: Sequence[str], score: str, label: str, test: str = "test_dt"
) -> DataFrame:
    """Each scored row with the entity's previous score, next label and ever-positive flag.

    An entity has one row per test date, so its window is a handful of rows.
    """
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy(test)
    return df.withColumns(
        {
            "ever_positive": F.max(label).over(whole),
            "previous_score": F.lag(score).over(ordered),
            "next_label": F.lead(label).over(ordered),
        }
    )


def before_or_at_event(history: DataFrame, label: str) -> DataFrame:
    """Rows that are positive or whose next row is."""
    return history.filter((F.col(label) == 1) | (F.col("next_label") == 1))


def entity_history(df: DataFrame, key: str, entity: object, test: str = "test_dt") -> DataFrame:
    """One entity's rows across back-tests."""
    return df.filter(F.col(key) == entity).orderBy(test)


def caught_positives(df: DataFrame, test_dt: object, label: str, predict: str, test: str = "test_dt") -> DataFrame:
    """True positives of one back-test."""
    return df.filter((F.col(test) == F.lit(test_dt).cast("date")) & (F.col(label) == 1) & (F.col(predict) == 1))


# --- concordance ------------------------------------------------------------


def _at_risk(
    df: DataFrame, score: str, event: str, keep: Sequence[str], step: int, tstart: str, tstop: str
) -> DataFrame:
    """Each row once per step it spans: score ``_s``, time ``_t``, and ``_y``, whether its event is there."""
    times = F.sequence(F.col(tstart) + step, F.col(tstop), F.lit(step))
    return df.select(
        *keep, F.col(score).cast("double").alias("_s"), F.col(event).alias("_e"),
        F.col(tstop).alias("_stop"), F.explode(times).alias("_t"),
    ).withColumn("_y", F.when(F.col("_t") == F.col("_stop"), F.col("_e")).otherwise(0))


def concordance(
    df: DataFrame, score: str, event: str, keys: Sequence[str] = (), step: int = 6,
    tstart: str = "tstart", tstop: str = "tstop",
) -> DataFrame:
    """Concordance of risk scores on ``(tstart, tstop]`` rows per group.

    At each event time an event is compared with the rows at risk that have no
    event there. Rows count once per step they span; per (group, time) the pairs
    follow from running totals over distinct scores.
    """
    at_risk = _at_risk(df, score, event, keys, step, tstart, tstop)
    curve = curves.score_curve(at_risk, "_s", "_y", [*keys, "_t"])
    pos = F.col("pos").cast("double")
    below = F.col("n") - F.col("fp")
    return (
        curve.groupBy(*keys)
        .agg(
            F.sum(pos * below).alias("concordant"),
            F.sum(pos * F.col("neg")).alias("tied"),
            F.sum(pos * F.col("n")).alias("pairs"),
        )
        .withColumn("concordance", F.try_divide(F.col("concordant") + F.col("tied") / 2, F.col("pairs")))
    )


def concordance_error(
    df: DataFrame, score: str, event: str, entity: str, keys: Sequence[str] = (), step: int = 6,
    tstart: str = "tstart", tstop: str = "tstop",
) -> DataFrame:
    """Concordance per group with a standard error that allows for several rows of one entity.

    The error is the root of the summed squares of the entities' influences. The
    influence of an entity is the derivative of the concordance in its weight:
    (its concordant pairs - concordance x its pairs) / all pairs, where a pair
    belongs to both of its sides. What a row adds follows from the running totals
    at its score, so no pair is built. Rows are reduced to (group, time, score,
    entity) and written once; the totals are one row per (group, time, score).

    Rows without a score are left out, rows with an unknown event count neither as event nor as
    compared at that time, and rows without an entity are one entity together.
    Without pairs, concordance and error are null.
    """
    own = [F.count_if(F.col("_y") == y).cast("double") for y in (1, 0)]
    at_risk = _at_risk(df, score, event, [*keys, F.col(entity).alias("_entity")], step, tstart, tstop)
    cells = materialise(
        at_risk.filter(F.col("_s").isNotNull())
        .groupBy(*keys, "_t", "_s", "_entity")
        .agg(own[0].alias("_events"), own[1].alias("_others")),
        "risk_cells",
    )
    groups = [*keys, "_t"]
    counts = cells.groupBy(*groups, F.col("_s").alias("score")).agg(
        F.sum("_events").alias("pos"), F.sum("_others").alias("neg")
    )
    totals = curves.curve_of_counts(counts, groups).select(
        *groups, F.col("threshold").alias("_s"), "p", "n",
        (F.col("n") - F.col("fp") + F.col("neg") / 2).alias("_beaten"),
        (F.col("tp") - F.col("pos") / 2).alias("_beating"),
    )
    sides = (
        cells.join(totals, [*groups, "_s"])
        .groupBy(*keys, "_entity")
        .agg(
            F.sum(F.col("_events") * F.col("_beaten") + F.col("_others") * F.col("_beating")).alias("_won"),
            F.sum(F.col("_events") * F.col("n") + F.col("_others") * F.col("p")).alias("_all"),
        )
    )
    won, every, c = F.col("_won"), F.col("_all"), F.col("concordance")
    squares = F.col("_ww") - 2 * c * F.col("_wa") + c * c * F.col("_aa")
    return (
        sides.groupBy(*keys)
        .agg(
            F.count_if(every > 0).alias("entities"),
            (F.sum(every) / 2).alias("pairs"),
            F.try_divide(F.sum(won), F.sum(every)).alias("concordance"),
            F.sum(won * won).alias("_ww"), F.sum(won * every).alias("_wa"), F.sum(every * every).alias("_aa"),
        )
        .withColumn("std_error", F.try_divide(F.sqrt(F.greatest(squares, F.lit(0.0))), F.col("pairs")))
        .drop("_ww", "_wa", "_aa")
    )


# --- Welch test -------------------------------------------------------------


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1))
    total = d
    for m in range(1, 500):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / ((1.0 + top * d) or tiny)
            c = (1.0 + top / c) or tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return front * total
    raise ArithmeticError(f"no convergence for a={a}, b={b}, x={x}")


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of a t statistic and its degrees of freedom; used on result rows only."""
    return pd.Series(
        [None if pd.isna(x) or pd.isna(n) else _incomplete_beta(n / 2, 0.5, n / (n + x * x)) for x, n in zip(t, df)]
    )


def welch_t(df: DataFrame, value: str, label: str, p_value: bool = True) -> DataFrame:
    """Two-sample Welch test of ``value`` between label 0 and label 1, as one row."""

    def part(y: int) -> list[Column]:
        v = F.when(F.col(label) == y, F.col(value))
        return [
            F.count(v).alias(f"n{y}"), F.avg(v).alias(f"mean{y}"), F.var_samp(v).alias(f"var{y}")
        ]

    moments = df.agg(*part(0), *part(1))
    se0, se1 = F.col("var0") / F.col("n0"), F.col("var1") / F.col("n1")
    t = F.try_divide(F.col("mean0") - F.col("mean1"), F.sqrt(se0 + se1))
    freedom = F.try_divide(
        F.pow(se0 + se1, 2), F.pow(se0, 2) / (F.col("n0") - 1) + F.pow(se1, 2) / (F.col("n1") - 1)
    )
    out = moments.select("n0", "n1", "mean0", "mean1", t.alias("t"), freedom.alias("df"))
    return out.withColumn("p_value", t_p_value("t", "df")) if p_value else out


# --- report tables ----------------------------------------------------------


def importance_summary(
    wide: DataFrame, features: Sequence[str], keys: Sequence[str] = (), population: bool = False
) -> DataFrame:
    """Mean and standard deviation of each feature's repeats, one column per feature given."""
    sd = F.stddev_pop if population else F.stddev_samp
    return (
        wide.unpivot(list(keys), list(features), "feature", "importance")
        .groupBy(*keys, "feature")
        .agg(F.avg("importance").alias("mean_imp"), sd("importance").alias("sd_imp"))
    )


def family_name(prefix: str, test: str = "test_dt") -> Column:
    """``PREFIX-15-01`` from a test date."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.col(test).cast("string"), 3, 5))


def model_type(model_id: str = "model_id") -> Column:
    return F.get(F.split(model_id, "_"), F.lit(0))


def experiment_id(project: str) -> Column:
    """Last two parts of a project name."""
    return F.concat_ws("_", F.slice(F.split(project, "_"), -2, 2))


def contender_name(model_id: str, types: str, numbers: str, names: Mapping[tuple[str, str], str],
                   alone: Sequence[str] = ()) -> Column:
    """Display name from a model id: family and number pulled out by pattern.

    ``names`` overrides (family, number) pairs; families in ``alone`` need no number.
    """
    family = F.regexp_extract(model_id, types, 0)
    number = F.regexp_extract(model_id, numbers, 0)
    arms = [((family == f) & (number == n), F.lit(name)) for (f, n), name in names.items()]
    arms += [(family == f, F.lit(f)) for f in alone]
    default = F.concat(family, F.regexp_replace(number, "_", "-"))
    out = default
    for test, name in reversed(arms):
        out = F.when(test, name).otherwise(out)
    return out


def stacked_roc(tables: Mapping[str, DataFrame], champion: str, others: str = "others") -> DataFrame:
    """ROC tables of several model families under (tpr, fpr, model_name), with a champion mark and a label.

    Tables carry ``fpr`` or ``specificity``, ``tpr`` or ``sensitivity``, and
    ``model_name`` or ``test_dt``.
    """
    parts = []
    for prefix, table in tables.items():
        has = set(table.columns)
        parts.append(
            table.select(
                F.col("tpr" if "tpr" in has else "sensitivity").alias("tpr"),
                (F.col("fpr") if "fpr" in has else 1 - F.col("specificity")).alias("fpr"),
                (F.col("model_name") if "model_name" in has else family_name(prefix)).alias("model_name"),
            )
        )
    is_champion = F.substring("model_name", 1, len(champion)) == champion
    return reduce(lambda a, b: a.unionByName(b), parts).withColumns(
        {
            "is_champion": is_champion,
            "shown_as": F.when(is_champion, F.col("model_name")).otherwise(others),
        }
    )
