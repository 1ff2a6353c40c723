"""Wide assembly, temporal and hash splits, back-tests, feature selection."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohortlens.operators.grid import Grid


def zero_fill(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls to 0 in the numeric columns, or in the listed ones."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(0, subset=list(columns))


def assemble(
    spine: DataFrame,
    features: Iterable[DataFrame],
    required: Iterable[DataFrame] = (),
    keys: Sequence[str] = ("student_id",),
    pred: str = "pred_dt",
    nonzero: Sequence[str] = (),
) -> DataFrame:
    """Feature tables joined to the spine on (entity, prediction date).

    Optional tables join left, ``required`` ones inner. Then nulls become 0 and
    rows whose ``nonzero`` columns are 0 are dropped, in this order. All tables
    share the join keys, so each is shuffled at most once and the spine once;
    the required tables go first because they shrink the spine.
    """
    on = [*keys, pred]
    features, required = list(features), list(required)
    names = [c for table in (spine, *required, *features) for c in table.columns if c not in on]
    if len(set(names)) < len(names):
        raise ValueError(f"feature names clash: {sorted({n for n in names if names.count(n) > 1})}")
    out = spine
    for key in keys:
        out = out.filter(F.col(key).isNotNull())
    for table in required:
        out = out.join(table, on)
    for table in features:
        out = out.join(table, on, "left")
    out = zero_fill(out)
    for column in nonzero:
        out = out.filter(F.col(column) != 0)
    return out


def left_join_by_entity(base: DataFrame, tables: Iterable[DataFrame], key: str) -> DataFrame:
    """One-to-one tables joined by entity only."""
    for table in tables:
        base = base.join(table, key, "left")
    return base


def split_by_year(
    df: DataFrame, pred: str = "pred_dt", train=(2010, 2017), test=(2018, 2019), calibration=(2009, 2009)
) -> dict[str, DataFrame]:
    """Calibration, training and test rows by prediction year (closed ranges).

    Written as date ranges, so a scan or partition filter can use them.
    """

    def rows(first: int, last: int) -> DataFrame:
        return df.filter(
            (F.col(pred) >= F.make_date(F.lit(first), F.lit(1), F.lit(1)))
            & (F.col(pred) < F.make_date(F.lit(last + 1), F.lit(1), F.lit(1)))
        )

    return {"calibration": rows(*calibration), "train": rows(*train), "test": rows(*test)}


def hash_percent(key: Column | str, seed: int) -> Column:
    """0..99 from the key alone: the same rows at any partitioning, in any engine with md5."""
    text = F.concat(F.col(key).cast("string") if isinstance(key, str) else key, F.lit(str(seed)))
    head = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("long") % 100


def hash_split(df: DataFrame, key: str, seed: int = 626, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Repeatable random split by entity, and its complement."""
    inside = hash_percent(key, seed) < percent
    return df.filter(inside), df.filter(~inside | F.col(key).isNull())


def rows_not_in(df: DataFrame, other: DataFrame) -> DataFrame:
    """Anti-join on all columns, null-safe: rows of ``df`` without an equal row in ``other``."""
    a, b = df.alias("a"), other.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in df.columns]
    return a.join(b, same, "left_anti")


def backtest_rows(
    df: DataFrame, grid: Grid, inclusive: bool = False, pred: str = "pred_dt", name: str = "test_dt"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of every expanding back-test, keyed by ``test_dt``.

    Train: all rows before the test date (or up to it with ``inclusive``). Each
    row is exploded to the test dates that see it; no join with a date table.
    """
    since = F.col(pred) if not inclusive else F.date_sub(F.col(pred), 1)
    train = (
        df.withColumns({"_since": since, "_until": F.lit(None).cast("date")})
        .transform(lambda d: grid.valid_after(d, "_since", "_until", name))
        .drop("_since", "_until")
    )
    test = grid.inside(df.withColumn("_on", F.col(pred)), "_on", "_on", name).drop("_on")
    return train, test


def backtest_lists(
    df: DataFrame, grid: Grid, inclusive: bool = False, pred: str = "pred_dt", name: str = "test_dt"
) -> DataFrame:
    """Training rows as in ``backtest_rows``, each once, with the list of the test dates that see it."""
    days = F.array(*[grid.at(F.lit(k)) for k in range(grid.size)])
    later = F.filter(days, lambda day: F.col(pred) <= day if inclusive else F.col(pred) < day)
    return df.withColumn(name, later).filter(F.size(name) > 0)


def backtest_splits(
    df: DataFrame, grid: Grid, inclusive: bool = False, pred: str = "pred_dt"
) -> list[tuple[str, DataFrame, DataFrame]]:
    """``(test date, train, test)`` as lazy filters on one table, for jobs that fit one model each."""
    out = []
    for k in range(grid.size):
        day = grid.at(F.lit(k))
        seen = F.col(pred) <= day if inclusive else F.col(pred) < day
        out.append((_grid_day(grid, k), df.filter(seen), df.filter(F.col(pred) == day)))
    return out


def _grid_day(grid: Grid, k: int) -> str:
    if grid.unit == "day":
        return (grid.start + dt.timedelta(days=k * grid.step)).isoformat()
    months = grid.start.month - 1 + k * grid.step
    return grid.start.replace(year=grid.start.year + months // 12, month=months % 12 + 1).isoformat()


def without_pattern(df: DataFrame, pattern: str) -> DataFrame:
    """Drop columns whose name matches, e.g. ``12m|18m|24m``."""
    return df.select(*[c for c in df.columns if not re.search(pattern, c)])


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def class_counts(df: DataFrame, label: str, pred: str | None = "pred_dt") -> DataFrame:
    """Rows per label, per prediction year when ``pred`` is given."""
    keys = ([F.year(pred).alias("pred_yr")] if pred else []) + [F.col(label)]
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def split_ratios(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share per split. The total runs over one counted row per split."""
    counts = df.groupBy(split).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("ratio", F.col("n").cast("double") / total)
