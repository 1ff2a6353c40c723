"""Structural model with a mechanism chosen for every node, and counterfactual rows that keep each row's noise.

A node with other values than 0 and 1 is a mean of its parents plus noise; the mean is linear or boosted, whichever has
the smaller squared error on held-out rows. A 0/1 node has a probability given its parents: the share of each
combination if they are 0/1 as well, else logistic or boosted by held-out log loss. Its noise is a quantile: the row's
hash, placed inside the interval that gives the value that was seen. A 0/1 node therefore stays 0/1, and a row whose
probability does not change keeps its value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.models.fits import together
from cohortlens.operators.assemble import hash_percent
from cohortlens.session import materialise

#: 0/1 parents up to which a 0/1 node has a share for each of their combinations.
TABLE_PARENTS = 10
#: Probabilities are kept this far from 0 and 1 in the log loss.
SURE = 1e-6
#: Bins in which boosted trees meet a parent, as many as Spark's trees make.
BINS = 32


def hash_unit(key: Sequence[str], salt: str) -> Column:
    """A number from 0 to below 1 from the row's key and a salt."""
    digest = F.md5(F.concat_ws("/", *[F.col(k).cast("string") for k in key], F.lit(salt)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


@dataclass
class Mechanism:
    """``expected`` adds a column to a frame: the node's mean or probability from the named parent columns."""

    binary: bool
    shape: str  # root, table, linear, boosted
    expected: Callable[[DataFrame, list[str], str], DataFrame] | None = None
    errors: dict[str, float] = field(default_factory=dict)


@dataclass
class Scm:
    """A mechanism for each node, in topological order."""

    order: list[str]
    parents: dict[str, list[str]]
    mechanisms: dict[str, Mechanism]

    def table(self, spark: SparkSession) -> DataFrame:
        """(node, kind, shape, error_linear, error_boosted): what was chosen, and the held-out errors behind it."""
        rows = [
            (n, "binary" if m.binary else "value", m.shape, m.errors.get("linear"), m.errors.get("boosted"))
            for n, m in ((n, self.mechanisms[n]) for n in self.order)
        ]
        return spark.createDataFrame(rows, "node string, kind string, shape string, error_linear double, error_boosted double")


def _by_model(model, binary: bool) -> Callable[[DataFrame, list[str], str], DataFrame]:
    def expected(df: DataFrame, columns: list[str], name: str) -> DataFrame:
        out = model.transform(VectorAssembler(inputCols=columns, outputCol="_in").transform(df))
        value = F.get(vector_to_array("_p"), F.lit(1)) if binary else F.col("_mean")
        return out.withColumn(name, value).drop("_in", "_p", "_raw", "_mean")

    return expected


def _bin(x: Column, cuts: Sequence[float]) -> Column:
    """How many of the cuts a value is above."""
    return reduce(lambda a, b: a + b, [(x > c).cast("double") for c in cuts], F.lit(0.0))


def _by_bins(model, binary: bool, cuts: Sequence[Sequence[float]]) -> Callable[[DataFrame, list[str], str], DataFrame]:
    def expected(df: DataFrame, columns: list[str], name: str) -> DataFrame:
        bins = {f"_bin{i}": _bin(F.col(c), own) for i, (c, own) in enumerate(zip(columns, cuts, strict=True))}
        return _by_model(model, binary)(df.withColumns(bins), list(bins), name).drop(*bins)

    return expected


def _by_table(shares: Mapping[tuple, float], overall: float) -> Callable[[DataFrame, list[str], str], DataFrame]:
    """Combinations that were never seen have the overall share."""

    def expected(df: DataFrame, columns: list[str], name: str) -> DataFrame:
        at = F.concat_ws("", *[F.col(c).cast("int").cast("string") for c in columns])
        known = F.create_map(*[v for cell, share in shares.items() for v in (F.lit("".join(map(str, cell))), F.lit(share))])
        return df.withColumn(name, F.coalesce(F.try_element_at(known, at), F.lit(overall)))

    return expected


def fit_mechanisms(
    df: DataFrame, edges: Sequence[tuple[str, str]], key: Sequence[str], hold_out_percent: int = 20, seed: int = 626,
    threads: int = 4,
) -> Scm:
    """Rows with a null in a node are left out of the fits.

    Kinds of all nodes and the shares of 0/1 nodes are one aggregation each; linear and boosted candidates of all nodes
    are fitted side by side, and their held-out errors are one aggregation over one written table. Boosted trees see a
    parent only through its bins, so rows with equal bins are added up before they are fitted: see ``_cells``.
    """
    nodes = sorted({n for edge in edges for n in edge})
    parents = {n: sorted({a for a, b in edges if b == n}) for n in nodes}
    order = list(TopologicalSorter(parents).static_order())
    held = hash_percent(F.concat_ws("/", *[F.col(k).cast("string") for k in key]), seed) < hold_out_percent
    rows = df.select(held.alias("_held"), *[F.col(n).cast("double").alias(n) for n in nodes]).dropna()
    rows = materialise(rows, "scm")
    kinds = rows.agg(*[F.coalesce(F.bool_and(F.col(n).isin(0.0, 1.0)), F.lit(False)).alias(n) for n in nodes]).first()
    mechanisms: dict[str, Mechanism] = {}
    open_nodes = []
    for n in order:
        above = parents[n]
        if not above:
            mechanisms[n] = Mechanism(kinds[n], "root")
        elif kinds[n] and len(above) <= TABLE_PARENTS and all(kinds[a] for a in above):
            cells = rows.groupBy(*above).agg(F.sum(n).alias("_ones"), F.count("*").alias("_n")).collect()
            shares = {tuple(int(c[a]) for a in above): c["_ones"] / c["_n"] for c in cells}
            overall = sum(c["_ones"] for c in cells) / max(1, sum(c["_n"] for c in cells))
            mechanisms[n] = Mechanism(True, "table", _by_table(shares, overall))
        else:
            open_nodes.append(n)

    kept, tested = rows.filter(~F.col("_held")), rows.filter("_held")
    cuts = _cuts(rows, sorted({a for n in open_nodes for a in parents[n]}))
    cells = together({n: lambda n=n: _cells(rows, parents[n], n, kinds[n], cuts) for n in open_nodes}, threads)

    def fit(n: str, shape: str, whole: bool) -> Callable[[DataFrame, list[str], str], DataFrame]:
        if shape == "linear":
            return _fit_linear(rows if whole else kept, parents[n], n, kinds[n])
        own, ends = cells[n]
        return _fit_boosted(own if whole else own.filter(~F.col("_held")), ends, kinds[n], seed)

    fits = together({(n, s): lambda n=n, s=s: fit(n, s, False) for n in open_nodes for s in ("linear", "boosted")}, threads)
    scored = tested
    for (n, s), expected in fits.items():
        scored = expected(scored, parents[n], f"_{s}_{n}")
    scored_by = [_loss(F.col(n), F.col(f"_{s}_{n}"), kinds[n]).alias(f"{s}/{n}") for n, s in fits]
    errors = scored.agg(F.count("*").alias("n"), *scored_by).first()
    for n in open_nodes:
        own = {s: errors[f"{s}/{n}"] for s in ("linear", "boosted")}
        better = errors["n"] and own["boosted"] < own["linear"]
        shape = "boosted" if better else "linear"
        mechanisms[n] = Mechanism(kinds[n], shape, None, own)
    last = together({n: lambda n=n: fit(n, mechanisms[n].shape, True) for n in open_nodes}, threads)
    for n, expected in last.items():
        mechanisms[n].expected = expected
    return Scm(order, parents, mechanisms)


def _fit_linear(rows: DataFrame, above: list[str], node: str, binary: bool):
    columns = {"featuresCol": "_in", "labelCol": node, "predictionCol": "_mean"}
    if binary:
        estimator = LogisticRegression(**columns, regParam=0.0, tol=1e-9, probabilityCol="_p", rawPredictionCol="_raw")
    else:
        estimator = LinearRegression(**columns, solver="normal")
    return _by_model(estimator.fit(VectorAssembler(inputCols=above, outputCol="_in").transform(rows)), binary)


def _cuts(rows: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """The last value of each bin but the highest: every value if there are ``BINS`` at most, else quantiles of all rows."""
    if not columns:
        return {}
    marks = [i / BINS for i in range(1, BINS)]
    measures = [(F.approx_count_distinct(c), F.percentile_approx(c, marks, F.lit(10_000))) for c in columns]
    seen = rows.agg(*[m for pair in measures for m in pair]).first()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(set(seen[2 * i + 1] or []))
        if seen[2 * i] <= 2 * BINS:  # an estimate: count the values themselves
            few = sorted(r[c] for r in rows.select(c).distinct().limit(BINS + 1).collect())
            values = few[:-1] if len(few) <= BINS else values
        out[c] = values
    return out


def _cells(
    rows: DataFrame, above: list[str], node: str, binary: bool, cuts: Mapping[str, list[float]]
) -> tuple[DataFrame, list[list[float]]]:
    """One row for each combination of the parents' bins (a 0/1 node: and its value), and the cuts between the bins.

    A tree chooses its splits by sums over bins, and a leaf is a mean, so number and mean of the rows of a cell say all
    that the rows do: at most ``BINS`` to the power of the parents, however many rows there are. Cuts lie midway
    between the values on both sides, as in Spark's trees.
    """
    bins = [_bin(F.col(a), cuts[a]).alias(f"_b{i}") for i, a in enumerate(above)]
    value = [F.col(node).alias("_y")] if binary else []
    ends = [f(a).alias(f"_{f.__name__}{i}") for i, a in enumerate(above) for f in (F.min, F.max)]
    cells = rows.groupBy("_held", *bins, *value).agg(
        F.count("*").cast("double").alias("_n"), *([] if binary else [F.avg(node).alias("_y")]), *ends
    )
    cells = materialise(cells, "cells")
    between = []
    for i, a in enumerate(above):
        sides = cells.groupBy(f"_b{i}").agg(F.min(f"_min{i}").alias("low"), F.max(f"_max{i}").alias("high")).collect()
        low, high = ({int(r[f"_b{i}"]): r[side] for r in sides} for side in ("low", "high"))
        middle = [(high.get(k, c) + low.get(k + 1, c)) / 2 for k, c in enumerate(cuts[a])]
        between.append([m if c < m < low.get(k + 1, c) else c for k, (c, m) in enumerate(zip(cuts[a], middle, strict=True))])
    return cells, between


def _fit_boosted(cells: DataFrame, cuts: list[list[float]], binary: bool, seed: int):
    columns = {"featuresCol": "_in", "labelCol": "_y", "predictionCol": "_mean", "weightCol": "_n", "maxBins": BINS, "seed": seed}
    if binary:
        estimator = GBTClassifier(**columns).setProbabilityCol("_p").setRawPredictionCol("_raw")
    else:
        estimator = GBTRegressor(**columns)
    bins = VectorAssembler(inputCols=[f"_b{i}" for i in range(len(cuts))], outputCol="_in").transform(cells)
    return _by_bins(estimator.fit(bins), binary, cuts)


def _loss(value: Column, expected: Column, binary: bool) -> Column:
    if not binary:
        return F.avg((value - expected) * (value - expected))
    p = F.greatest(F.lit(SURE), F.least(F.lit(1 - SURE), expected))
    return F.avg(-F.log(F.when(value == 1, p).otherwise(1 - p)))


def counterfactual_rows(
    model: Scm, df: DataFrame, key: Sequence[str], change: Mapping[str, Column | float], suffix: str = "_cf", salt: str = "noise"
) -> DataFrame:
    """Each row's values had the ``change`` nodes been set: ``<node>_cf`` columns, made in topological order.

    A row with a null in a node or its parents has a null there and below. ``key`` names the row whose hash is its
    noise; equal rows of one key get equal values.
    """
    given, out = df.columns, df
    for node in model.order:
        mechanism, above = model.mechanisms[node], model.parents[node]
        name, value = node + suffix, F.col(node).cast("double")
        if node in change:
            new = change[node]
            out = out.withColumn(name, new if isinstance(new, Column) else F.lit(float(new)))
            continue
        if mechanism.expected is None:
            out = out.withColumn(name, value)
            continue
        known = F.lit(True)
        for a in above:
            known = known & F.col(a).isNotNull() & F.col(a + suffix).isNotNull()
        filled = {f"_a_{a}": F.coalesce(F.col(a).cast("double"), F.lit(0.0)) for a in above}
        filled |= {f"_b_{a}": F.coalesce(F.col(a + suffix).cast("double"), F.lit(0.0)) for a in above}
        out = out.withColumns(filled)
        out = mechanism.expected(out, [f"_a_{a}" for a in above], "_before")
        out = mechanism.expected(out, [f"_b_{a}" for a in above], "_after")
        if mechanism.binary:
            at = hash_unit(key, f"{salt}/{node}")
            noise = F.when(value == 1, at * F.col("_before")).otherwise(F.col("_before") + at * (1 - F.col("_before")))
            new = F.when(value.isNotNull(), (noise < F.col("_after")).cast("double"))
        else:
            new = value - F.col("_before") + F.col("_after")
        out = out.withColumn(name, F.when(known, new)).drop(*filled, "_before", "_after")
    return out.select(*given, *[n + suffix for n in model.order])
