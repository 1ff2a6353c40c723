"""Recode expressions: first-match maps, pattern flags, buckets, reverse one-hot."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.functions import fixed_values as fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(arms: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first arm that holds, else ``default``."""
    arms = list(arms)
    out = F.when(arms[0][0], arms[0][1])
    for condition, value in arms[1:]:
        out = out.when(condition, value)
    return out.otherwise(default)


def members(c: Column | str, groups: Mapping[object, Sequence[object]], default: object = None) -> Column:
    """Map code lists to labels: ``{label: [codes]}``."""
    return first_match(((_col(c).isin(list(codes)), label) for label, codes in groups.items()), default)


def attendance_category(
    code: Column | str, status: Column | str, excuse: Column | str, default: str = "other"
) -> Column:
    """Special codes first, then status x excuse; a missing excuse is unknown."""
    code, status, excuse = _col(code), _col(status), _col(excuse)
    arms = [
        (code.isin(fixed.DETENTION_CODES), "detention"),
        (code.isin(fixed.RESTITUTION_CODES), "restitution"),
        (code.isin(fixed.SUSPENSION_CODES), "suspension"),
    ]
    excuses = {
        "exc": excuse.isin(fixed.EXCUSED),
        "unexc": excuse.isin(fixed.UNEXCUSED),
        "unkn": excuse.isin(fixed.UNKNOWN_EXCUSE) | excuse.isNull(),
    }
    for kind, statuses in fixed.ATTENDANCE_STATUSES.items():
        for prefix, excused in excuses.items():
            arms.append((status.isin(statuses) & excused, f"{prefix}_{kind}"))
    return first_match(arms, default)


def _text_test(c: Column, kind: str, text: str) -> Column:
    return c == text if kind == "equals" else c.ilike(f"%{text}%")


def pattern_category(
    c: Column | str,
    patterns: Sequence[tuple[str, str, str]] = tuple(fixed.RESOLUTIONS),
    default: str = fixed.RESOLUTION_DEFAULT,
) -> Column:
    """Exclusive category of a text: first pattern that matches, else ``default`` (also for null)."""
    return first_match(((_text_test(_col(c), kind, text), name) for name, kind, text in patterns), default)


def pattern_flags(
    c: Column | str,
    patterns: Sequence[tuple[str, str, str]] = tuple(fixed.RESOLUTIONS),
    rest: str = fixed.RESOLUTION_DEFAULT,
    prefix: str = "",
    suffix: str = "",
) -> list[Column]:
    """One 0/1 column per pattern (several may be 1) and ``rest`` = none of them; null text gives 0."""
    tests = {name: _text_test(_col(c), kind, text) for name, kind, text in patterns}
    flags = dict(tests)
    flags[rest] = ~reduce(lambda a, b: a | b, tests.values())
    return [F.when(t, 1).otherwise(0).alias(f"{prefix}{n}{suffix}") for n, t in flags.items()]


def grade_bucket(
    list_name: Column | str,
    score: Column | str,
    buckets: Mapping[int, Sequence[str]] | None = None,
    missing: int = fixed.GRADE_BUCKET_MISSING,
    default: int = fixed.GRADE_BUCKET_DEFAULT,
) -> Column:
    """Ordinal bucket of ``coalesce(list_name, score)``.

    A row without a list name that no bucket before ``missing`` catches falls into ``missing``.
    """
    buckets = buckets or fixed.GRADE_BUCKETS
    name = _col(list_name)
    value = F.coalesce(name, _col(score))
    arms = []
    for bucket, values in buckets.items():
        test = value.isin(list(values))
        arms.append((test | name.isNull() if bucket == missing else test, bucket))
    return first_match(arms, default)


def count_bucket(n: Column | str, buckets: Sequence[tuple] = tuple(fixed.COUNT_BUCKETS)) -> Column:
    """Label of the range a count lies in; a null count takes the open last range, as ELSE does."""
    n = _col(n)
    closed = [(n.between(lo, hi), label) for label, lo, hi in buckets if hi is not None]
    last = [label for label, _, hi in buckets if hi is None]
    return first_match(closed, last[0] if last else None)


def relation_name(
    relation: Column | str, gender: Column | str, known: Sequence[str] = tuple(fixed.RELATIONS)
) -> Column:
    """Sibling by gender, known relations by normalised name, everything else ``other``.

    Only the sibling test trims; the name test does not, so a leading blank gives ``other``.
    """
    relation, gender = _col(relation), _col(gender)
    name = F.translate(F.lower(relation), "- ", "__")
    sibling = F.trim(F.lower(relation)) == "sibling"
    return first_match(
        [
            (sibling & (gender == "M"), "brother"),
            (sibling & (gender == "F"), "sister"),
            (name.isin(list(known)), name),
        ],
        "other",
    )


def any_flag(*flags: Column | str) -> Column:
    """1 if one of the flags is 1, else 0."""
    return F.when(reduce(lambda a, b: a | b, [_col(f) == 1 for f in flags]), 1).otherwise(0)


def one_hot(c: Column | str, labels: Mapping[object, str]) -> list[Column]:
    """0/1 column per code."""
    return [F.when(_col(c) == code, 1).otherwise(0).alias(name) for code, name in labels.items()]


def label_of_flags(flags: Mapping[str, str], default: str) -> Column:
    """Reverse one-hot: label of the first flag column that is 1."""
    return first_match(((F.col(flag) == 1, label) for flag, label in flags.items()), default)


def label_of_values(c: Column | str, values: Sequence[int], default: str = "other") -> Column:
    """Listed whole numbers as text, everything else ``default``."""
    return F.when(_col(c).isin(list(values)), _col(c).cast("int").cast("string")).otherwise(default)


def missing_in_all(*columns: Column | str) -> Column:
    """1 if every column is null."""
    return reduce(lambda a, b: a & b, [_col(c).isNull() for c in columns]).cast("int")


def present(c: Column | str) -> Column:
    """1 if the value is there, else 0."""
    return _col(c).isNotNull().cast("int")


def prefer(*columns: Column | str) -> Column:
    """First source that has a value."""
    return F.coalesce(*[_col(c) for c in columns])


def relabel(c: Column | str, old: str, new: str) -> Column:
    return F.when(_col(c) == old, new).otherwise(_col(c))
