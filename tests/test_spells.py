import datetime as dt

from conftest import day, rows
from pyspark.sql import functions as F

from cohortlens.operators import spells
from cohortlens.operators.grid import BACKTESTS, SEMESTERS, Grid

SCHEMA = "ent long, start_date date, end_date date"


def frame(spark, *data):
    return spark.createDataFrame([(e, day(s), day(t)) for e, s, t in data], SCHEMA)


def test_grid_sizes():
    assert SEMESTERS.size == 39
    assert BACKTESTS.size == 10


def test_grid_dates(spark):
    grid = Grid(dt.date(2004, 7, 1), dt.date(2006, 1, 1))
    assert [r[0] for r in rows(grid.dates(spark))] == [
        day("2004-07-01"), day("2005-01-01"), day("2005-07-01"), day("2006-01-01")
    ]


def test_normalise(spark):
    df = frame(spark, (1, "2018-09-03", "2019-06-07"), (2, "2018-10-01", None), (3, "2018-08-20", "2018-12-01"))
    got = rows(spells.normalise_spells(df), "ent", "calendar_start", "calendar_end")
    assert got == [
        (1, day("2018-08-01"), day("2019-07-31")),
        (2, day("2018-10-01"), day("2019-07-31")),
        (3, day("2018-08-01"), day("2018-12-01")),
    ]


ISLANDS = [
    (1, "2016-09-05", "2017-06-09"),  # 31 July -> 1 August: contiguous
    (1, "2017-09-04", "2018-06-08"),
    (1, "2017-11-01", "2017-12-01"),  # nested, must not break the next one
    (1, "2018-09-03", None),
    (1, "2020-09-01", "2021-06-01"),  # after a year's gap
    (2, "2018-09-10", "2018-09-14"),  # too short for any date
    (3, "2018-09-03", "2019-06-01"),
    (3, "2018-09-03", "2018-10-01"),  # same start twice
]


def test_merge_true_islands(spark):
    assert rows(spells.merge_spells(frame(spark, *ISLANDS), ["ent"])) == [
        (1, day("2016-09-05"), day("2019-07-31")),
        (1, day("2020-09-01"), day("2021-06-01")),
        (2, day("2018-09-10"), day("2018-09-14")),
        (3, day("2018-09-03"), day("2019-06-01")),
    ]


def test_merge_literal_has_one_island(spark):
    got = rows(spells.merge_spells(frame(spark, *ISLANDS), ["ent"], split_on_gap=False))
    assert got[0] == (1, day("2016-09-05"), day("2021-07-31"))
    assert len(got) == 3


def test_merge_ignores_partitioning(spark):
    df = frame(spark, *ISLANDS)
    one = rows(spells.merge_spells(df.repartition(1), ["ent"]))
    many = rows(spells.merge_spells(df.repartition(13), ["ent"]))
    assert one == many


def test_spine_ends_are_closed_and_null_keys_go(spark):
    df = spark.createDataFrame(
        [(1, day("2018-07-01"), day("2019-07-01")), (2, day("2018-09-10"), day("2018-09-14")),
         (None, day("2018-07-01"), day("2019-07-01")), (3, None, day("2019-07-01"))],
        "ent long, enrollment_start date, enrollment_end date",
    )
    got = rows(spells.prediction_spine(df, SEMESTERS, required=["ent"]), "ent", "pred_dt", "pred_yr")
    assert got == [
        (1, day("2018-07-01"), 2018), (1, day("2019-01-01"), 2019), (1, day("2019-07-01"), 2019)
    ]


def test_spine_equals_range_join(spark):
    """Index arithmetic against the plain range join, on a grid that starts mid-month."""
    for grid in (Grid(dt.date(2010, 3, 15), dt.date(2013, 3, 20), 4), Grid(dt.date(2010, 1, 2), dt.date(2010, 3, 1), 5, "day")):
        df = spark.range(400).select(
            F.col("id").alias("ent"),
            F.date_add(F.lit(dt.date(2009, 6, 1)), (F.col("id") * 7 % 1500).cast("int")).alias("s"),
        ).withColumn("e", F.date_add("s", (F.col("ent") % 300).cast("int")))
        got = rows(grid.inside(df, "s", "e"), "ent", "pred_dt")
        dates = [r[0] for r in grid.dates(spark).collect()]
        want = sorted((r.ent, d) for r in df.collect() for d in dates if r.s <= d <= r.e)
        assert sorted(got) == want


def test_windows_over_equals_range_join(spark):
    for grid, length in ((Grid(dt.date(2010, 1, 1), dt.date(2013, 1, 1), 6), 6), (Grid(dt.date(2010, 1, 1), dt.date(2012, 1, 1), 3), 8),
                         (Grid(dt.date(2010, 1, 2), dt.date(2010, 3, 1), 1, "day"), 7)):
        df = spark.range(1300).select(F.date_add(F.lit(dt.date(2009, 5, 1)), F.col("id").cast("int")).alias("d"))
        got = sorted(tuple(r) for r in grid.windows_over(df, "d", length).select("d", "pred_dt").collect())
        dates = grid.dates(spark)
        want = sorted(
            tuple(r) for r in df.join(
                dates, (F.col("d") <= F.col("pred_dt")) & (F.col("d") >= grid.shift(F.col("pred_dt"), -length))
            ).select("d", "pred_dt").collect()
        )
        assert got == want
