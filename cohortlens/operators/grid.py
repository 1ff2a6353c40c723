"""Regular prediction dates.

A grid is three numbers, so no operator ever joins against a table of dates: the
grid dates a spell or an event touches follow from index arithmetic, and
``explode`` turns one source row into one row per touched date. Everything after
that is an equality join on (entity, prediction date).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Dates ``start, start + step, ...`` not after ``stop``; ``unit`` is ``month`` or ``day``."""

    start: dt.date
    stop: dt.date
    step: int = 6
    unit: str = "month"

    def __post_init__(self) -> None:
        if self.unit not in ("month", "day"):
            raise ValueError("unit is 'month' or 'day'")
        if self.unit == "month" and self.start.day > 28:
            raise ValueError("a month grid starts on day 1..28")

    @property
    def size(self) -> int:
        if self.unit == "day":
            return (self.stop - self.start).days // self.step + 1
        months = (self.stop.year - self.start.year) * 12 + self.stop.month - self.start.month
        return (months - (self.stop.day < self.start.day)) // self.step + 1

    def shift(self, date: Column, n: Column | int) -> Column:
        """``date`` moved by ``n`` units."""
        return F.add_months(date, n) if self.unit == "month" else F.date_add(date, n)

    def at(self, index: Column) -> Column:
        """The date with this 0-based index."""
        return self.shift(F.lit(self.start), (index * self.step).cast("int"))

    def floor_index(self, date: Column) -> Column:
        """Index of the last grid date not after ``date`` (may lie outside the grid)."""
        if self.unit == "day":
            passed = F.datediff(date, F.lit(self.start))
        else:
            passed = (
                (F.year(date) - self.start.year) * 12
                + F.month(date) - self.start.month
                - (F.dayofmonth(date) < self.start.day).cast("int")
            )
        return F.floor(passed / self.step).cast("int")

    def ceil_index(self, date: Column) -> Column:
        """Index of the first grid date not before ``date`` (may lie outside the grid)."""
        return self.floor_index(F.date_sub(date, 1)) + 1

    def _explode(self, df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
        first = F.greatest(first, F.lit(0))
        last = F.least(last, F.lit(self.size - 1))
        # greatest / least skip nulls, so null dates are excluded by the bounds below
        indexes = F.when(F.col("_lo") <= F.col("_hi"), F.sequence("_lo", "_hi"))
        return (
            df.withColumns({"_lo": first, "_hi": last})
            .withColumn("_k", F.explode(indexes))
            .withColumn(name, self.at(F.col("_k")))
            .drop("_lo", "_hi", "_k")
        )

    def dates(self, spark: SparkSession, name: str = "pred_dt") -> DataFrame:
        """The grid as a table."""
        return spark.range(self.size, numPartitions=1).select(self.at(F.col("id").cast("int")).alias(name))

    def inside(self, df: DataFrame, start: str, end: str, name: str = "pred_dt") -> DataFrame:
        """One row per grid date in ``[start, end]``; rows without one vanish."""
        kept = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
        return self._explode(kept, self.ceil_index(F.col(start)), self.floor_index(F.col(end)), name)

    def windows_over(self, df: DataFrame, event: str, length: int, name: str = "pred_dt") -> DataFrame:
        """One row per grid date whose closed window ``[date - length, date]`` holds the event.

        With ``length == step`` that is one date, or two for an event on a grid date.
        """
        kept = df.filter(F.col(event).isNotNull())
        first = self.ceil_index(F.col(event))
        out = self._explode(kept, first, first + length // self.step, name)
        return out.filter(F.col(event) >= self.shift(F.col(name), -length))

    def valid_after(
        self, df: DataFrame, since: str, until: str, name: str = "pred_dt"
    ) -> DataFrame:
        """One row per grid date in ``(since, until]``; a null ``until`` means the end of the grid."""
        kept = df.filter(F.col(since).isNotNull())
        first = self.floor_index(F.col(since)) + 1
        last = F.coalesce(self.floor_index(F.col(until)), F.lit(self.size - 1))
        return self._explode(kept, first, last, name)


SEMESTERS = Grid(dt.date(2004, 7, 1), dt.date(2023, 7, 30), 6)
BACKTESTS = Grid(dt.date(2015, 1, 1), dt.date(2019, 7, 1), 6)
