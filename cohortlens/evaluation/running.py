"""Running totals and row numbers over an order no single task could hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import materialise


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    descending: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``cum_v`` (running, inclusive), ``all_v`` (whole group) and ``next_v`` (following row) of each value.

    ``df`` has one row per (keys, order); keys are not null. The rows are range
    partitioned on (keys, order) and written once together with the id of their
    range, so all later passes see the same ranges. Each range adds up its own
    rows; the sums of the ranges before it come from a table with one row per
    (keys, range). A single group holding everything is thus spread over all
    ranges.
    """
    keys = list(keys)
    by = F.col(order).desc() if descending else F.col(order).asc()
    ranged = materialise(
        df.select(*keys, order, *values, *keep)
        .repartitionByRange(*keys, by)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    leading = F.max_by if descending else F.min_by
    totals = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(v).alias(f"_sum_{v}") for v in values],
        *[leading(v, order).alias(f"_first_{v}") for v in values],
    )
    group = Window.partitionBy(*keys)
    by_range = group.orderBy("_range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(group).alias(f"all_{v}") for v in values],
        *[F.lead(f"_first_{v}").over(by_range).alias(f"_after_{v}") for v in values],
    )
    in_order = Window.partitionBy(*keys, "_range").orderBy(by)
    inside = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(offsets, [*keys, "_range"]).select(
        *keys,
        order,
        *keep,
        *values,
        *[(F.sum(v).over(inside) + F.col(f"_before_{v}")).alias(f"cum_{v}") for v in values],
        *[f"all_{v}" for v in values],
        *[F.coalesce(F.lead(v).over(in_order), F.col(f"_after_{v}")).alias(f"next_{v}") for v in values],
    )


def hash_index(df: DataFrame, key: Sequence[str], seed: int, name: str = "idx", buckets: int = 65_536) -> DataFrame:
    """Dense 0-based index of the rows in the order of a seeded hash of their unique key.

    The bucket is the remainder of the hash, so it depends on the key alone and
    every pass agrees on it; unique keys spread evenly over the buckets.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *key)).withColumn(
        "_bucket", F.pmod("_hash", F.lit(buckets))
    )
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # at most ``buckets`` rows
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", *key)
    return (
        hashed.join(offsets, "_bucket")
        .withColumn(name, F.row_number().over(inside) - 1 + F.col("_before"))
        .drop("_hash", "_bucket", "_before")
    )
