"""Trailing-window features.

One engine for all variants: reduce events per entity and day, explode each to
the grid dates whose window holds it, aggregate per (entity, prediction date),
and only then meet the spine, with one row per key on both sides. A hot entity
is therefore spread over its days and dates, or summed up where it is read,
before anything is joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import fixed_values as fixed
from cohortlens.functions import recode
from cohortlens.operators.grid import Grid


def spine_keys(spine: DataFrame, keys: Sequence[str], pred: str = "pred_dt") -> DataFrame:
    """The distinct (entity, prediction date) pairs of a spine."""
    return spine.select(*keys, pred).distinct()


def on_spine(df: DataFrame, spine: DataFrame | None, keys: Sequence[str], pred: str = "pred_dt") -> DataFrame:
    """The rows whose (entity, prediction date) is on the spine; all rows without one, for tables that meet it later."""
    return df if spine is None else df.join(spine_keys(spine, keys, pred), [*keys, pred])


def _day_counts(events, keys, date, category, categories, grid, length, pred):
    """Distinct event days per (entity, prediction date), one column per category.

    A day is a bit of the window's days, so the rows of a key are joined by ``or`` before they are shuffled, once: no
    DISTINCT over events. A month has 31 days at most.
    """
    known = events.filter(F.col(category).isin(list(categories))).select(*keys, date, category)
    back = F.datediff(F.col(pred), F.col(date))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), back % 64)
    words = range((length if grid.unit == "day" else 31 * length) // 64 + 1)
    masks = {
        f"_{i}_{w}": F.bit_or(F.when((F.col(category) == c) & (F.shiftright(back, 6) == w), bit))
        for i, c in enumerate(categories)
        for w in words
    }
    seen = (
        grid.windows_over(known, date, length, pred)
        .groupBy(*keys, pred)
        .agg(*[mask.alias(name) for name, mask in masks.items()])
    )
    days = [sum((F.coalesce(F.bit_count(F.col(f"_{i}_{w}")), F.lit(0)) for w in words), F.lit(0)) for i in range(len(categories))]
    return seen.select(*keys, pred, *[n.cast("long").alias(c) for c, n in zip(categories, days, strict=True)])


def window_distinct_days(
    spine: DataFrame | None,
    events: DataFrame,
    grid: Grid,
    keys: Sequence[str],
    categories: Sequence[str],
    date: str = "event_dt",
    category: str = "category",
    length: int = 6,
    pred: str = "pred_dt",
) -> DataFrame:
    """Distinct event days per category in ``[pred - length, pred]``.

    Every spine key stays; keys without events get zeros. Without a spine only
    keys with events appear, to be joined and filled by ``assemble``.
    """
    counts = _day_counts(events, keys, date, category, categories, grid, length, pred)
    if spine is None:
        return counts
    return (
        spine_keys(spine, keys, pred)
        .join(counts, [*keys, pred], "left")
        .fillna(0, subset=list(categories))
    )


def bucketed_one_hot(
    counts: DataFrame,
    keys: Sequence[str],
    categories: Sequence[str],
    default: str = "other",
    suffix: str = "_6mo",
    pred: str = "pred_dt",
    buckets: Sequence[tuple] = tuple(fixed.COUNT_BUCKETS),
) -> DataFrame:
    """Day counts -> one 0/1 column per category and count range.

    A category without events sets none of its columns. A key without any event
    sets the zero range of ``default``, the category an event-less row falls into.
    """
    no_event = F.lit(True)
    for c in categories:
        no_event = no_event & (F.col(c) == 0)
    columns = []
    for c in categories:
        for label, _, _ in buckets:
            here = (F.col(c) > 0) & (recode.count_bucket(c, buckets) == label)
            if c == default and label == buckets[0][0]:
                here = no_event
            columns.append(here.cast("int").alias(f"{c}{label}{suffix}"))
    return counts.select(*keys, pred, *columns)


def row_lags(
    df: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, Sequence[str]],
    pred: str = "pred_dt",
    default: object = 0,
) -> DataFrame:
    """Previous rows of an entity: ``{column: [name of lag 1, lag 2, ...]}``.

    A lag is a row, not a period; an entity has at most one row per grid date.
    """
    w = Window.partitionBy(*keys).orderBy(pred)
    lags = {
        name: F.lag(column, n, default).over(w)
        for column, names in columns.items()
        for n, name in enumerate(names, start=1)
    }
    return df.withColumns(lags)


def calendar_lags(
    df: DataFrame,
    grid: Grid,
    keys: Sequence[str],
    columns: Mapping[str, Sequence[str]],
    pred: str = "pred_dt",
    default: object = 0,
) -> DataFrame:
    """Same names as ``row_lags``, but lag n is the grid date n steps earlier, or ``default``.

    The window is still ordered by rows; the offset is checked against the
    calendar, so no self-join is needed. Up to n rows back can hold the date.
    """
    w = Window.partitionBy(*keys).orderBy(pred)
    out = {}
    for column, names in columns.items():
        for n, name in enumerate(names, start=1):
            wanted = grid.shift(F.col(pred), -n * grid.step)
            hits = [
                F.when(F.lag(pred, back).over(w) == wanted, F.lag(column, back).over(w))
                for back in range(1, n + 1)
            ]
            out[name] = F.coalesce(*hits, F.lit(default))
    return df.withColumns(out)


def lag_names(columns: Sequence[str], old: str, new: Sequence[str]) -> dict[str, list[str]]:
    """Regular lag names: the suffix ``old`` replaced by each suffix in ``new``."""
    return {c: [c.removesuffix(old) + suffix for suffix in new] for c in columns}


def window_flags(
    spine: DataFrame | None,
    events: DataFrame,
    grid: Grid,
    keys: Sequence[str],
    flags: Sequence[str],
    date: str = "event_dt",
    length: int = 6,
    pred: str = "pred_dt",
) -> DataFrame:
    """Max of stored 0/1 flags over the window; only spine keys with an event in it."""
    seen = (
        grid.windows_over(events.select(*keys, date, *flags), date, length, pred)
        .groupBy(*keys, pred)
        .agg(*[F.max(f).alias(f) for f in flags])
    )
    return on_spine(seen, spine, keys, pred)


def window_category_counts(
    spine: DataFrame | None,
    events: DataFrame,
    grid: Grid,
    keys: Sequence[str],
    categories: Sequence[str],
    date: str = "event_dt",
    category: str = "category",
    length: int = 6,
    pred: str = "pred_dt",
) -> DataFrame:
    """Number of events per category in the window; only spine keys with an event in it."""
    # one row per entity, day and category before the explode
    daily = events.groupBy(*keys, date, category).agg(F.count("*").alias("_n"))
    counts = (
        grid.windows_over(daily, date, length, pred)
        .groupBy(*keys, pred)
        .agg(*[
            F.coalesce(F.sum(F.when(F.col(category) == c, F.col("_n"))), F.lit(0)).alias(c)
            for c in categories
        ])
    )
    return on_spine(counts, spine, keys, pred)


def window_shares(
    spine: DataFrame | None,
    rows: DataFrame,
    grid: Grid,
    keys: Sequence[str],
    buckets: Mapping[object, str],
    date: str = "end_dt",
    bucket: str = "score_bucket",
    distinct_on: Sequence[str] | None = None,
    length: int = 6,
    pred: str = "pred_dt",
    tasks: int | None = None,
) -> DataFrame:
    """Share of the window's rows per bucket; only spine keys with a row in it.

    With ``distinct_on``, rows equal in (entity, prediction date, bucket) and
    these columns count once. Where most rows differ, ``tasks`` deals them out by
    what tells them apart before they meet their dates; a task then holds its part
    only, and each row is shuffled once and not once for each date.
    """
    rows = rows.select(*keys, date, bucket, *distinct_on or ())
    if tasks is not None:
        rows = rows.repartition(tasks, *keys, bucket, *distinct_on or ())
    in_window = grid.windows_over(rows, date, length, pred)
    if distinct_on is not None:
        in_window = in_window.select(*keys, pred, bucket, *distinct_on).distinct()
    total = F.count("*").cast("double")
    shares = in_window.groupBy(*keys, pred).agg(
        *[
            (F.count_if(F.col(bucket) == value).cast("double") / total).alias(name)
            for value, name in buckets.items()
        ]
    )
    return on_spine(shares, spine, keys, pred)


def share_of_total(
    df: DataFrame, keys: Sequence[str], bucket: str, share: str = "share"
) -> DataFrame:
    """Long form of a share: one row per (keys, bucket) with its part of the group."""
    counts = df.groupBy(*keys, bucket).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counts.withColumn(share, F.col("n").cast("double") / total.cast("double"))


def with_group_size(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Group size on every row, by a count per key joined back, not a window over raw rows.

    The counted side has one row per key, so a hot key is split by the skew join.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias(name))
    return df.join(sizes, list(keys), "left")
