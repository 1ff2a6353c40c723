"""De-duplication of bucketed rows and dating them by their term."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cohortlens.functions import dates


def dedup_keep_max(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str = "score_bucket",
    final: Column | None = None,
    keep: str = "max",
    literal: Column | None = None,
) -> DataFrame:
    """One row per key: the kept bucket where a key has several, else its only one.

    Keys with one bucket must also pass ``final`` (the final-term test); keys with
    several pass regardless. A key with a missing part equals no other key, so its
    buckets stay apart. ``literal`` is a test for rows that an unbracketed OR lets
    through: their keys keep every bucket besides the kept one.

    Duplicates are seen as min <> max in one partially aggregated pass; no
    self-join, no window, no DISTINCT.
    """
    keys = list(keys)
    final = F.lit(True) if final is None else final
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    aggregates = [
        F.min(bucket).alias("_min"),
        F.max(bucket).alias("_max"),
        F.max(F.coalesce(final, F.lit(False))).alias("_final"),
    ]
    if literal is not None:
        aggregates.append(F.max(F.coalesce(literal, F.lit(False))).alias("_literal"))
        # as many values as there are buckets, not rows
        aggregates.append(F.collect_set(bucket).alias("_all"))
    grouped = df.withColumn("_apart", F.when(incomplete, F.col(bucket))).groupBy(*keys, "_apart").agg(*aggregates)
    several = F.col("_min") != F.col("_max")
    kept = F.col("_max") if keep == "max" else F.col("_min")
    if literal is None:
        return grouped.filter(several | F.col("_final")).select(*keys, kept.alias(bucket))
    emitted = (
        F.when(several & F.col("_literal"), F.concat("_all", F.array(kept)))
        .when(several | F.col("_final"), F.array(kept))
    )
    return grouped.select(*keys, F.explode(emitted).alias(bucket))


def duplicate_buckets(df: DataFrame, keys: Sequence[str], bucket: str = "score_bucket") -> DataFrame:
    """Keys with more than one distinct bucket, with their number of buckets."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.filter(complete)
        .groupBy(*keys)
        .agg(F.count_distinct(bucket).alias("n_course_ids"))
        .filter(F.col("n_course_ids") > 1)
    )


def term_dates(
    rows: DataFrame,
    terms: DataFrame,
    year: str = "year",
    term: str = "term_name",
    name: str = "name",
    start: str = "start_dt",
    end: str = "end_dt",
) -> DataFrame:
    """Start and end date of each row's term: school year and term name looked up, left.

    ``terms`` holds dates; a term belongs to the school year its start lies in. ``year`` is a text like 2017-2018 or the
    first year as a whole number.
    """
    lookup = terms.select(
        dates.school_year_of(start).alias("start_yr"),
        F.col(name).alias(term),
        F.col(start).alias("start_dt"),
        F.col(end).alias("end_dt"),
    ).distinct()
    whole = isinstance(rows.schema[year].dataType, IntegralType)
    first, second = (F.col(year).cast("int"), F.col(year).cast("int") + 1) if whole else dates.year_pair(year)
    dated = rows.withColumns({"start_yr": first, "end_yr": second}).drop(year)
    return dated.join(lookup, ["start_yr", term], "left")
