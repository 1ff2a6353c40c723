"""Two-key fallback and static one-hot attributes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import dates
from cohortlens.functions import fixed_values as fixed


def two_key_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    other_key: str,
    how: str = "left",
    distinct: bool = False,
) -> DataFrame:
    """Rows with ``key`` join on it, rows without join on ``other_key``.

    ``right`` carries both keys and must have one row per join key in either
    branch, or be reduced by the caller (``reduce_by``). Two equality joins, so
    neither branch shuffles null keys or degenerates to an OR condition.
    """
    payload = [c for c in right.columns if c not in (key, other_key)]
    with_key = left.filter(F.col(key).isNotNull()).join(
        right.filter(F.col(key).isNotNull()).select(key, *payload), key, how
    )
    without = left.filter(F.col(key).isNull()).join(
        right.filter(F.col(other_key).isNotNull()).select(other_key, *payload), other_key, how
    )
    columns = [*left.columns, *payload]
    both = with_key.select(*columns).unionByName(without.select(*columns))
    return both.distinct() if distinct else both


def _per_key(enrolled: DataFrame, key: str, one_birth_date: bool, race: str, birth: str,
             home_language: str) -> DataFrame:
    keys = [key] if one_birth_date else [key, birth]
    aggregates = [
        F.max(F.when(F.col(race) == code, 1).otherwise(0)).alias(name)
        for code, name in fixed.RACE_FLAGS.items()
    ]
    aggregates += [
        F.max(F.when(F.col(home_language) == code, 1).otherwise(0)).alias(f"_{name}")
        for name, (code, _) in fixed.LANGUAGE_FLAGS.items()
    ]
    aggregates.append(F.max(F.col(home_language).isNull().cast("int")).alias("_no_language"))
    if one_birth_date:
        aggregates.append(F.min(birth).alias(birth))
    return enrolled.filter(F.col(key).isNotNull()).groupBy(*keys).agg(*aggregates)


def static_one_hot(
    spine: DataFrame,
    enrolled: DataFrame,
    demographics: DataFrame,
    key: str = "student_id",
    other_key: str = "person_id",
    one_birth_date: bool = True,
    race: str = "race_ethnicity_fed",
    birth: str = "birth_date",
    home_language: str = "home_primary_language",
    gender: str = "gender",
    language: str = "language",
) -> DataFrame:
    """Race, gender and language flags of each spine row.

    Enrolment rows join on ``key``, or on ``other_key`` where ``key`` is null;
    demographics join on ``key`` only. The home language of the enrolment wins;
    the demographic language counts only beside a missing one. Both sides shrink
    to one row per key first, which gives the flags of the full product without
    building it. ``one_birth_date=False`` keeps one row per recorded birth date.
    The spine has distinct rows, so the result has.
    """
    demo = (
        demographics.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.max(F.when(F.col(gender) == "F", 1).otherwise(0)).alias("genderf"),
            F.max(F.when(F.col(gender) == "M", 1).otherwise(0)).alias("genderm"),
            *[
                F.max(F.when(F.col(language) == word, 1).otherwise(0)).alias(f"_demo_{name}")
                for name, (_, word) in fixed.LANGUAGE_FLAGS.items()
            ],
        )
    )

    def branch(rows: DataFrame, on: str) -> DataFrame:
        reduced = _per_key(enrolled, on, one_birth_date, race, birth, home_language)
        return rows.join(reduced, on, "left")

    with_key = branch(spine.filter(F.col(key).isNotNull()), key).join(demo, key, "left")
    # no key, hence no demographics row either
    without = branch(spine.filter(F.col(key).isNull()), other_key)
    joined = with_key.unionByName(without, allowMissingColumns=True)

    zero = F.lit(0)
    # no enrolment row at all is a missing home language too
    language_missing = F.coalesce(F.col("_no_language"), F.lit(1)) == 1
    flags = {name: F.coalesce(F.col(name), zero) for name in fixed.RACE_FLAGS.values()}
    flags |= {name: F.coalesce(F.col(name), zero) for name in ("genderf", "genderm")}
    for name in fixed.LANGUAGE_FLAGS:
        flags[name] = (
            F.when(F.col(f"_{name}") == 1, 1)
            .when(language_missing & (F.col(f"_demo_{name}") == 1), 1)
            .otherwise(0)
        )
    return joined.select(
        *spine.columns, birth, *[value.alias(name) for name, value in flags.items()]
    )


def age_and_tenure(
    df: DataFrame,
    birth: str = "birth_date",
    start: str = "enrollment_start",
    pred: str = "pred_dt",
) -> DataFrame:
    """Fractional and whole age at the prediction date, and years since the spell began."""
    age = dates.years_between(birth, pred)
    return df.withColumns(
        {
            "age_at_pred": age,
            "age_at_pred_natural": age.cast("int"),
            "yrs_enrolled": dates.years_between(start, pred),
        }
    )


def null_pattern(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row counts per combination of missing columns."""
    return df.groupBy(*[F.col(c).isNull().cast("int").alias(c) for c in columns]).agg(
        F.count("*").alias("n_rows")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def exclusive_violations(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows on which two or more flags are 1 that should exclude each other."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f), F.lit(0)) for f in flags])
    return df.filter(total > 1)
