"""Spell normalisation, island merging, prediction spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.grid import Grid


def normalise_spells(df: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Add ``calendar_start`` / ``calendar_end``: the school-year frame of a spell.

    Start in August or September -> 1 August; end in May or June -> 31 July;
    open end -> 31 July after the start year.
    """
    s, e = F.col(start), F.col(end)
    calendar_start = F.when(
        F.month(s).isin(8, 9), F.make_date(F.year(s), F.lit(8), F.lit(1))
    ).otherwise(s)
    calendar_end = (
        F.when(e.isNull(), F.make_date(F.year(s) + 1, F.lit(7), F.lit(31)))
        .when(F.month(e).isin(5, 6), F.make_date(F.year(e), F.lit(7), F.lit(31)))
        .otherwise(e)
    )
    return df.withColumns({"calendar_start": calendar_start, "calendar_end": calendar_end})


def _end_of(raw_end, calendar_end, has_open_end):
    """Null-propagating max with fallback: any open end -> the latest inferred end."""
    return F.when(has_open_end, calendar_end).otherwise(raw_end)


def merge_spells(
    df: DataFrame,
    keys: Sequence[str],
    start: str = "start_date",
    end: str = "end_date",
    split_on_gap: bool = True,
) -> DataFrame:
    """Contiguous normalised spells -> one row of raw dates per island.

    ``split_on_gap=False`` keeps one island per entity, which is what an
    overwritten gap test yields.

    Spells are first reduced to one row per (entity, calendar start). The ordered
    pass then sees at most one row per calendar day and entity, however many
    spells a hot entity has.
    """
    keys = list(keys)
    spells = normalise_spells(df.filter(F.col(start).isNotNull()), start, end)
    if not split_on_gap:
        return spells.groupBy(*keys).agg(
            F.min(start).alias("enrollment_start"),
            _end_of(
                F.max(end), F.max("calendar_end"), F.max(F.col(end).isNull())
            ).alias("enrollment_end"),
        )
    daily = spells.groupBy(*keys, "calendar_start").agg(
        F.min(start).alias("_start"),
        F.max(end).alias("_end"),
        F.max("calendar_end").alias("_calendar_end"),
        F.max(F.col(end).isNull()).alias("_open"),
    )
    by_start = Window.partitionBy(*keys).orderBy("calendar_start")
    earlier = by_start.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("_calendar_end").over(earlier)
    # a start on the day after the furthest end so far is contiguous; nested spells never break
    opens = (F.col("calendar_start") > F.date_add(reach, 1)) | reach.isNull()
    return (
        daily.withColumn("_opens", opens.cast("int"))
        .withColumn("_island", F.sum("_opens").over(by_start))
        .groupBy(*keys, "_island")
        .agg(
            F.min("_start").alias("enrollment_start"),
            _end_of(F.max("_end"), F.max("_calendar_end"), F.max("_open")).alias("enrollment_end"),
        )
        .drop("_island")
    )


def prediction_spine(
    spells: DataFrame,
    grid: Grid,
    start: str = "enrollment_start",
    end: str = "enrollment_end",
    required: Sequence[str] = (),
) -> DataFrame:
    """One row per spell and grid date inside it (both ends closed), with ``pred_yr``.

    ``required`` names key columns that must not be null.
    """
    for key in required:
        spells = spells.filter(F.col(key).isNotNull())
    return grid.inside(spells, start, end).withColumn("pred_yr", F.year("pred_dt"))
