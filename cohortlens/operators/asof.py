"""As-of features: ever before, current, latest snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import dates
from cohortlens.operators.grid import Grid
from cohortlens.operators.windows import on_spine, spine_keys


def ever_before_flags(
    spine: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    flags: Sequence[str],
    date: str = "event_dt",
    pred: str = "pred_dt",
) -> DataFrame:
    """Max of 0/1 flags over all events strictly before the prediction date.

    Only spine keys with an earlier event appear. Events shrink to one row per
    entity (first date of each flag) before the join.
    """
    first = events.groupBy(*keys).agg(
        F.min(date).alias("_first"),
        *[F.min(F.when(F.col(f) == 1, F.col(date))).alias(f"_first_{f}") for f in flags],
    )
    return (
        spine_keys(spine, keys, pred)
        .join(first, list(keys))
        .filter(F.col("_first") < F.col(pred))
        .select(
            *keys,
            pred,
            *[
                F.coalesce((F.col(f"_first_{f}") < F.col(pred)).cast("int"), F.lit(0)).alias(f)
                for f in flags
            ],
        )
    )


def school_year_flags(
    spine: DataFrame | None,
    status: DataFrame,
    keys: Sequence[str],
    flags: Mapping[str, Column],
    year: str = "year",
    pred: str = "pred_dt",
) -> DataFrame:
    """Yearly status -> flags at 1 July of the start year and the next 1 January.

    ``flags`` maps names to conditions on the status rows.
    """
    dated = (
        status.withColumn(pred, F.explode(dates.season_dates(dates.start_year(year))))
        .groupBy(*keys, pred)
        .agg(*[F.max(F.when(test, 1).otherwise(0)).alias(name) for name, test in flags.items()])
    )
    return on_spine(dated, spine, keys, pred)


def current_and_ever(
    spine: DataFrame | None,
    status: DataFrame,
    keys: Sequence[str],
    test: Column,
    current: str,
    ever: str,
    year: str = "year",
    pred: str = "pred_dt",
) -> DataFrame:
    """Status at the prediction date, and whether it ever held at an earlier status date.

    ``ever`` is null when the entity has no earlier status date.
    """
    for key in keys:
        status = status.filter(F.col(key).isNotNull())
    dated = (
        status.withColumn(pred, F.explode(dates.season_dates(dates.start_year(year))))
        .groupBy(*keys, pred)
        .agg(F.max(F.when(test, 1).otherwise(0)).alias(current))
    )
    # one row per entity and status date by now, so "earlier rows" are "earlier dates"
    earlier = Window.partitionBy(*keys).orderBy(pred).rowsBetween(Window.unboundedPreceding, -1)
    return on_spine(dated.withColumn(ever, F.max(current).over(earlier)), spine, keys, pred)


def snapshot_counts(
    df: DataFrame, keys: Sequence[str], category: str, categories: Sequence[str], year: str = "year"
) -> DataFrame:
    """Members per category of each yearly snapshot, dated 1 July of its start year."""
    start_yr = dates.start_year(year)
    return (
        df.groupBy(*keys, F.make_date(start_yr, F.lit(7), F.lit(1)).alias("start_dt"), year)
        .agg(*[F.count_if(F.col(category) == c).alias(c) for c in categories])
        .drop(year)
    )


def latest_snapshot(
    spine: DataFrame | None,
    snapshots: DataFrame,
    grid: Grid,
    keys: Sequence[str],
    date: str = "start_dt",
    pred: str = "pred_dt",
) -> DataFrame:
    """Every snapshot row of the last snapshot date strictly before the prediction date.

    Ties on the date are all kept. Each snapshot date is valid until the next one,
    so it is exploded to the grid dates in that span and joined by equality;
    nothing is ranked per spine row.
    """
    keys = list(keys)
    # distinct dates first: at most one row per calendar day and entity
    spans = (
        snapshots.select(*keys, date)
        .distinct()
        .withColumn("_until", F.lead(date).over(Window.partitionBy(*keys).orderBy(date)))
    )
    valid = grid.valid_after(spans, date, "_until", pred).drop("_until")
    chosen = on_spine(valid, spine, keys, pred).select(*keys, pred, date)
    return chosen.join(snapshots, [*keys, date])
