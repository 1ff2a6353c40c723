"""Date expressions. All stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mdy(c: Column | str) -> Column:
    """``m/d/y`` text to a date; text that is no date becomes null."""
    text = F.translate(F.trim(_col(c)), "-.", "//")
    return F.coalesce(F.try_to_date(text, "M/d/yyyy"), F.try_to_date(text, "M/d/yy"))


def mdy_hm(c: Column | str) -> Column:
    """``m/d/y h:m`` text to the date part; text that is no date becomes null."""
    text = F.translate(F.trim(_col(c)), "-.", "//")
    stamp = F.coalesce(
        F.try_to_timestamp(text, F.lit("M/d/yyyy H:mm")),
        F.try_to_timestamp(text, F.lit("M/d/yy H:mm")),
    )
    return stamp.cast("date")


def start_year(c: Column | str) -> Column:
    """First year of ``"2019-2020"`` or ``"2019-20"`` as int; null if it is no number."""
    return F.substring(_col(c), 1, 4).try_cast("int")


def year_pair(c: Column | str) -> tuple[Column, Column]:
    """``"2019-2020"`` split into its two numbers."""
    parts = F.split(_col(c), "-")
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")


def season_dates(year: Column | str) -> Column:
    """The two prediction dates of a school year: 1 July and the next 1 January."""
    y = _col(year)
    return F.array(
        F.make_date(y, F.lit(7), F.lit(1)),
        F.make_date(y + 1, F.lit(1), F.lit(1)),
    )


def school_year_of(c: Column | str, first_month: int = 8) -> Column:
    """Start year of the school year a date lies in."""
    d = _col(c)
    return F.when(F.month(d) >= first_month, F.year(d)).otherwise(F.year(d) - 1)


def years_between(earlier: Column | str, later: Column | str) -> Column:
    """Fractional calendar years: whole birthdays passed plus the part of the running year."""
    a, b = _col(earlier), _col(later)
    whole = F.floor(F.months_between(b, a) / 12).cast("int")
    last = F.add_months(a, whole * 12)
    following = F.add_months(a, (whole + 1) * 12)
    return whole + F.datediff(b, last) / F.datediff(following, last)
