"""Forward labels, censoring, survival intervals, label checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.fallback import two_key_join


def first_event(
    events: DataFrame,
    keys: Sequence[str],
    date: str = "event_dt",
    test: Column | None = None,
    name: str = "condition_start",
) -> DataFrame:
    """First date per entity among the events that pass ``test``."""
    if test is not None:
        events = events.filter(test)
    return events.groupBy(*keys).agg(F.min(date).alias(name))


def class_of(events: DataFrame, classes: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Events with the 0/1 columns of their class map; Spark knows the size of a map read from files."""
    return events.join(classes, on, how)


def attach_first(
    spine: DataFrame, first: DataFrame, key: str, other_key: str | None = None
) -> DataFrame:
    """First date of each spine row's entity, by the second key where the first is null."""
    if other_key is None:
        return spine.join(first, key, "left")
    return two_key_join(spine, first, key, other_key)


def forward_label(
    spine: DataFrame,
    first: str = "condition_start",
    horizon: int = 6,
    label: str = "label",
    prior: str = "prior",
    unresolved: bool = False,
    pred: str = "pred_dt",
) -> DataFrame:
    """1 if the first event lies in ``(pred, pred + horizon months]``, plus a prior flag.

    ``unresolved=True`` drops the lower bound: once positive, positive for good.
    """
    end = F.add_months(F.col(pred), horizon)
    hit = F.col(first) <= end
    if not unresolved:
        hit = hit & (F.col(first) > F.col(pred))
    return spine.withColumns(
        {
            "pred_window_end": end,
            label: F.when(hit, 1).otherwise(0),
            prior: F.when(F.col(first) < F.col(pred), 1).otherwise(0),
        }
    )


def censor_after_last_positive(
    df: DataFrame, keys: Sequence[str], label: str = "label", pred: str = "pred_dt"
) -> DataFrame:
    """Drop rows after the entity's last positive row; entities without one keep all rows."""
    positive = F.when(F.col(label) == 1, F.col(pred))
    last = F.max("depress_dt").over(Window.partitionBy(*keys))
    return (
        df.withColumn("depress_dt", positive)
        .withColumn("stop_dt", F.coalesce(last, F.col(pred)))
        .filter(F.col(pred) <= F.col("stop_dt"))
    )


def survival_intervals(
    df: DataFrame,
    keys: Sequence[str],
    label: str = "label",
    step: int = 6,
    pred: str = "pred_dt",
    nonzero: Sequence[str] = (),
) -> DataFrame:
    """Counting-process rows: ``tstop = step * row``, ``tstart = tstop - step``.

    Rows after the last positive date (or, without one, the last date) are dropped
    first, then rows with a zero in ``nonzero``; the rest is numbered.
    """
    whole = Window.partitionBy(*keys)
    last_positive = F.max(F.when(F.col(label) == 1, F.col(pred))).over(whole)
    kept = (
        df.withColumn("stop_dt", F.coalesce(last_positive, F.max(pred).over(whole)))
        .filter(F.col(pred) <= F.col("stop_dt"))
    )
    for column in nonzero:
        kept = kept.filter(F.col(column) != 0)
    row = F.row_number().over(whole.orderBy(pred))
    return kept.withColumn("tstop", row * step).withColumn("tstart", F.col("tstop") - step)


def positives_outside_spine(
    first: DataFrame,
    labelled: DataFrame,
    spine: DataFrame,
    enrolled: DataFrame,
    key: str,
    units: Column,
    grace_days: int = 60,
    name: str = "condition_start",
    start: str = "enrollment_start",
) -> DataFrame:
    """Positives that never got a row although enrolled in ``units`` well before the event.

    Expected to be nearly empty; every row is a finding.
    """
    return (
        first.join(labelled.select(key).distinct(), key, "left_anti")
        .join(spine.select(key, start).distinct(), key, "left")
        .join(enrolled.filter(units).select(key).distinct(), key, "left_semi")
        .filter(F.col(name) > F.date_add(F.col(start), grace_days))
        .select(key, start, name)
        .distinct()
    )


def prior_positive_entities(df: DataFrame, keys: Sequence[str], prior: str = "prior") -> DataFrame:
    """Number of entities already positive at one of their prediction dates."""
    return df.filter(F.col(prior) == 1).agg(F.count_distinct(*keys).alias("n"))
