"""ROC and precision-recall curves, areas, thresholds.

Everything starts from one row per (group, distinct score): ties are exact, and
rows shrink before they are ordered. Groups are given by ``keys``, usually the
model and the test date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.evaluation.running import running_totals
from cohortlens.session import materialise

_ALL = "_all"


def _grouped(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A constant key stands in when there is none."""
    return (df, list(keys)) if keys else (df.withColumn(_ALL, F.lit(0)), [_ALL])


def distinct_scores(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; rows without score or label are left out."""
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )


def score_curve(
    df: DataFrame, score: str, label: str, keys: Sequence[str] = (), scale: bool = False
) -> DataFrame:
    """``tp`` / ``fp`` at ``score >= threshold`` for each distinct score, with group totals.

    ``scale`` maps the scores of a group to 0..1 first; that is done on the
    distinct scores, the rows are not touched again.
    """
    df, groups = _grouped(df, keys)
    scores = distinct_scores(df, score, label, groups)
    if scale:
        scores = materialise(scores, "scores")
        scores = (
            min_max_scale(scores, "score", groups)
            .groupBy(*groups, "score")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        )
    return curve_of_counts(scores, groups).drop(_ALL)


def curve_of_counts(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The curve of a table that already has one row per (group, score) with ``pos`` and ``neg``.

    ``next_pos`` / ``next_neg`` are those of the next lower score, null at the end.
    """
    scores, groups = _grouped(scores, keys)
    curve = running_totals(scores, groups, "score", ["pos", "neg"])
    return curve.select(
        *keys,
        F.col("score").alias("threshold"),
        "pos",
        "neg",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.col("all_pos").alias("p"),
        F.col("all_neg").alias("n"),
        "next_pos",
        "next_neg",
    )


def _with_start(curve: DataFrame, keys: Sequence[str], point: dict[str, Column], start: dict[str, float]) -> DataFrame:
    """Points of a curve plus its fixed start, emitted beside the group's highest score."""
    none = F.lit(None).cast("double")
    first = (F.col("tp") + F.col("fp")) == (F.col("pos") + F.col("neg"))
    row = F.struct(F.col("threshold").alias("threshold"), *[c.alias(n) for n, c in point.items()])
    origin = F.struct(none.alias("threshold"), *[F.lit(v).alias(n) for n, v in start.items()])
    return curve.select(
        *keys, F.inline(F.when(first, F.array(origin, row)).otherwise(F.array(row)))
    )


def _recall() -> Column:
    return F.try_divide(F.col("tp"), F.col("p"))


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def roc_points(curve: DataFrame, keys: Sequence[str] = (), drop_collinear: bool = False) -> DataFrame:
    """ROC points from (0, 0) on. ``drop_collinear`` leaves out points on the line between their neighbours.

    A point is kept if it is an end of the curve or the next step differs from its own.
    """
    if drop_collinear:
        ends = F.col("tp") + F.col("fp") == F.col("p") + F.col("n")
        first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
        turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        curve = curve.filter(ends | first | turns)
    point = {"fpr": F.try_divide(F.col("fp"), F.col("n")), "tpr": _recall()}
    return _with_start(curve, keys, point, {"fpr": 0.0, "tpr": 0.0})


def pr_points(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return _with_start(
        curve, keys, {"recall": _recall(), "precision": _precision()}, {"recall": 0.0, "precision": 1.0}
    )


def areas(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exact AUROC (ties count half) and trapezoid AUPRC per group, in one aggregation.

    The previous point of a curve is the running total minus the row's own share,
    so no lag is needed. A group with one class only has no AUROC (null).
    """
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    before_tp, before = tp - pos, tp - pos + fp - neg
    previous = F.when(before == 0, F.lit(1.0)).otherwise(F.try_divide(before_tp, before))
    trapezoid = pos * (tp / (tp + fp) + previous) / 2
    n_pos, n_neg = F.first("p").cast("double"), F.first("n").cast("double")
    return curve.groupBy(*keys).agg(
        F.try_divide(F.sum(neg * (tp - pos / 2)), n_pos * n_neg).alias("auroc"),
        F.try_divide(F.sum(trapezoid), n_pos).alias("auprc"),
    )


def f1_at() -> Column:
    """F1 of a curve row: one division of whole numbers, so equal F1 values are equal doubles."""
    return F.try_divide(2 * F.col("tp"), F.col("p") + F.col("tp") + F.col("fp"))


def best_f1(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Threshold of the highest F1 per group; the lowest threshold wins a tie, no-hit rows count 0."""
    f1 = F.coalesce(f1_at(), F.lit(0.0))
    return curve.groupBy(*keys).agg(
        F.max_by("threshold", F.struct(f1, -F.col("threshold"))).alias("threshold"),
        F.max(f1).alias("max_f1"),
    )


# thresholds that one row of a sweep's grid is exploded to
_BLOCK = 65_536


def _at(k: Column, step: float) -> Column:
    return F.col("_min") + k * F.lit(step)


def _hits(df: DataFrame, score: str, label: str, step: float, groups: list[str]) -> tuple[DataFrame, DataFrame]:
    """Positives and negatives at the last threshold that each score reaches, and the bounds of each group."""
    scores = materialise(distinct_scores(df, score, label, groups), "scores")
    bounds = scores.groupBy(*groups).agg(F.min("score").alias("_min"), F.max("score").alias("_max"))
    bounds = bounds.withColumn("_last", F.floor((F.col("_max") - F.col("_min")) / F.lit(step) + F.lit(1e-10)))
    guess = F.floor((F.col("score") - F.col("_min")) / F.lit(step))
    # the division may be off by one at a threshold; the comparison decides
    k = (
        F.when(F.col("score") < _at(F.col("_g"), step), F.col("_g") - 1)
        .when(F.col("score") >= _at(F.col("_g") + 1, step), F.col("_g") + 1)
        .otherwise(F.col("_g"))
    )
    # a score above the last threshold reaches it all the same
    hits = (
        scores.join(bounds, groups)
        .withColumn("_g", guess)
        .withColumn("k", F.least(k, F.col("_last")))
        .groupBy(*groups, "k")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.first("_min").alias("_min"))
    )
    return hits, bounds


def _rates(swept: DataFrame, keys: Sequence[str], thresholds: Sequence[Column]) -> DataFrame:
    sensitivity = F.try_divide(F.col("cum_pos"), F.col("all_pos"))
    specificity = F.try_divide(F.col("all_neg") - F.col("cum_neg"), F.col("all_neg"))
    return swept.select(
        *keys,
        *thresholds,
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        sensitivity.alias("sensitivity"),
        specificity.alias("specificity"),
        (sensitivity + specificity - 1).alias("j_index"),
    )


def threshold_sweep(
    df: DataFrame, score: str, label: str, step: float = 0.0005, keys: Sequence[str] = ()
) -> DataFrame:
    """Sensitivity, specificity and J at ``min, min + step, ... max`` per group.

    Each distinct score is mapped to the last threshold it reaches and counted
    there; running totals over the thresholds do the rest. Scores never meet the
    thresholds row by row. The grid is made in two levels, so no row holds a list
    that grows with the range of the scores.
    """
    df, groups = _grouped(df, keys)
    hits, bounds = _hits(df, score, label, step, groups)
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_last") / _BLOCK))
    first = F.col("_block") * _BLOCK
    grid = bounds.withColumn("_block", F.explode(blocks)).withColumn(
        "k", F.explode(F.sequence(first, F.least(first + _BLOCK - 1, F.col("_last"))))
    )
    per_threshold = (
        grid.withColumn("threshold", _at(F.col("k"), step))
        .select(*groups, "k", "threshold")
        .join(hits.drop("_min"), [*groups, "k"], "left")
        .fillna(0, subset=["pos", "neg"])
    )
    swept = running_totals(per_threshold, groups, "k", ["pos", "neg"], keep=["threshold"])
    return _rates(swept, keys, [F.col("threshold")])


def threshold_runs(
    df: DataFrame, score: str, label: str, step: float = 0.0005, keys: Sequence[str] = ()
) -> DataFrame:
    """The sweep with equal neighbours as one row: its thresholds from ``threshold`` to ``until``.

    The same thresholds and figures as ``threshold_sweep`` has, in as many rows as
    distinct scores at most, whatever the range.
    """
    df, groups = _grouped(df, keys)
    hits, _ = _hits(df, score, label, step, groups)
    # the next row in falling order is the last threshold of the run below
    ordered = running_totals(hits.withColumn("_k", F.col("k")), groups, "k", ["pos", "neg", "_k"], keep=["_min"])
    lowest = _at(F.coalesce(F.col("next__k") + 1, F.lit(0)), step)
    return _rates(ordered, keys, [lowest.alias("threshold"), _at(F.col("k"), step).alias("until")])


def best_threshold(sweep: DataFrame, metric: str = "j_index", keys: Sequence[str] = ()) -> DataFrame:
    """Threshold with the highest metric per group; the lowest threshold wins a tie."""
    return sweep.groupBy(*keys).agg(
        F.max_by("threshold", F.struct(F.col(metric), -F.col("threshold"))).alias("threshold"),
        F.max(metric).alias(metric),
    )


def attach_by_key(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their group's values; ``table`` has one row per group."""
    if keys:
        return df.join(table, list(keys))
    row = table.first()  # no groups: one row, its values become constants
    if row is None:
        raise ValueError("no values to attach")
    return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in table.schema.fields})


def binarise(df: DataFrame, score: str, threshold: Column | str | float, strict: bool = False,
             name: str = "predict") -> DataFrame:
    """0/1 prediction: ``score >= threshold``, or ``>`` with ``strict``."""
    t = F.col(threshold) if isinstance(threshold, str) else threshold
    hit = F.col(score) > t if strict else F.col(score) >= t
    return df.withColumn(name, F.when(hit, 1).otherwise(0))


def min_max_scale(df: DataFrame, score: str, keys: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """Score scaled to 0..1 inside each group; a constant score becomes null -> 0."""
    bounds = df.groupBy(*keys).agg(F.min(score).alias("_min"), F.max(score).alias("_max"))
    scaled = F.try_divide(F.col(score) - F.col("_min"), F.col("_max") - F.col("_min"))
    return (
        attach_by_key(df, bounds, keys)
        .withColumn(name or score, F.when(F.col(score).isNotNull(), F.coalesce(scaled, F.lit(0.0))))
        .drop("_min", "_max")
    )


def first_detection(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per number of true positives found: highest score at which it is reached, and its rank.

    Tied rows share a rank (the first of the tie), so the result does not depend on row order.
    """
    found = F.col("tp").alias("num_tps_at_rank")
    return curve.groupBy(*keys, found).agg(
        F.max("threshold").alias("first_detection"),
        F.min(F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg") + 1).alias("pred_rank"),
        F.sum(F.col("pos") + F.col("neg")).alias("n_rows"),
    )
