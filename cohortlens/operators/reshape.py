"""Pivots with fixed value lists, unpivots, stacks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _elsewhere(category: str, values: Sequence[object]) -> Column:
    """Rows of none of the values; a missing category is one of them."""
    return ~F.coalesce(F.col(category).isin(list(values)), F.lit(False))


def pivot_counts(
    df: DataFrame, keys: Sequence[str], category: str, values: Sequence[object], names: Sequence[str] | None = None,
    other: str | None = "other",
) -> DataFrame:
    """Row counts per category as columns, missing ones 0. One aggregation, no value discovery.

    Rows of a category that is not listed are counted in ``other``; None leaves it out.
    """
    names = names or [str(v) for v in values]
    rest = [F.count_if(_elsewhere(category, values)).alias(other)] if other else []
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(category) == v).alias(n) for v, n in zip(values, names)], *rest
    )


def pivot_values(
    df: DataFrame, keys: Sequence[str], category: str, values: Sequence[object], value: str,
    names: Sequence[str] | None = None, fill: object = 0, other: str | None = "other",
) -> DataFrame:
    """The value stored per (keys, category) as columns; ``other`` has the largest of the categories not listed."""
    names = names or [str(v) for v in values]
    tests = [(F.col(category) == v, n) for v, n in zip(values, names)]
    if other:
        tests.append((_elsewhere(category, values), other))
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.max(F.when(test, F.col(value))), F.lit(fill)).alias(n) for test, n in tests]
    )


def pivot_presence(
    df: DataFrame, keys: Sequence[str], category: str, values: Sequence[object], names: Sequence[str] | None = None,
    other: str | None = "other",
) -> DataFrame:
    """1 where the category occurs for the keys, else 0; ``other`` for a category that is not listed."""
    names = names or [str(v) for v in values]
    tests = [(F.col(category) == v, n) for v, n in zip(values, names)]
    if other:
        tests.append((_elsewhere(category, values), other))
    return df.groupBy(*keys).agg(*[F.max(F.when(test, 1).otherwise(0)).alias(n) for test, n in tests])


def unpivot_dates(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One row per date column; other columns repeat."""
    rest = [c for c in df.columns if c not in set(columns)]
    return df.select(*rest, F.explode(F.array(*columns)).alias(name))


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "feature", value: str = "value"
) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows under common names; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
