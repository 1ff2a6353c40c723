"""Linear structural model over a given graph, and counterfactual rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class LinearScm:
    """Intercept and parent slopes per node, nodes in topological order."""

    order: list[str]
    parents: dict[str, list[str]]
    intercepts: dict[str, float]
    slopes: dict[str, dict[str, float]]

    def mean_of(self, node: str, values: Mapping[str, Column] | None = None) -> Column:
        """The node's equation without its residual."""
        out = F.lit(self.intercepts[node])
        for parent in self.parents[node]:
            x = values[parent] if values else F.col(parent)
            out = out + F.lit(self.slopes[node][parent]) * x
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([
            T.StructField("node", T.StringType()),
            T.StructField("parent", T.StringType()),
            T.StructField("slope", T.DoubleType()),
            T.StructField("intercept", T.DoubleType()),
        ])
        rows = [
            (n, p, self.slopes[n][p], self.intercepts[n]) for n in self.order for p in self.parents[n]
        ]
        return spark.createDataFrame(rows, schema)


def fit_scm(df: DataFrame, edges: Sequence[tuple[str, str]]) -> LinearScm:
    """Least squares of every node on its parents.

    All means and covariances any node needs come from one pass over the rows;
    the normal equations are parent-sized.
    """
    nodes = sorted({n for edge in edges for n in edge})
    parents = {n: sorted({a for a, b in edges if b == n}) for n in nodes}
    order = list(TopologicalSorter(parents).static_order())
    pairs = set()
    for node, above in parents.items():
        pairs |= {tuple(sorted((a, node))) for a in above}
        pairs |= {tuple(sorted((a, b))) for a in above for b in above}
    pairs = sorted(pairs)
    complete = df.select(*[F.col(n).cast("double").alias(n) for n in nodes]).dropna()
    row = complete.agg(
        *[F.avg(n).alias(f"m{i}") for i, n in enumerate(nodes)],
        *[F.covar_pop(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
    ).first()
    mean = {n: row[f"m{i}"] for i, n in enumerate(nodes)}
    cov = {pair: row[f"c{i}"] for i, pair in enumerate(pairs)}

    def c(a: str, b: str) -> float:
        return cov[tuple(sorted((a, b)))]

    intercepts, slopes = {}, {}
    for node in order:
        above = parents[node]
        matrix = np.array([[c(a, b) for b in above] for a in above]).reshape(len(above), len(above))
        beta = np.linalg.pinv(matrix, hermitian=True) @ np.array([c(a, node) for a in above]) if above else []
        slopes[node] = {a: float(v) for a, v in zip(above, beta)}
        intercepts[node] = float(mean[node] - sum(slopes[node][a] * mean[a] for a in above))
    return LinearScm(order, parents, intercepts, slopes)


def counterfactual(
    model: LinearScm, df: DataFrame, change: Mapping[str, Column | float], suffix: str = "_cf"
) -> DataFrame:
    """Each row's values had the ``change`` nodes been set: ``<node>_cf`` columns.

    The row keeps its residuals; nodes are recomputed in topological order, all
    as expressions of one projection chain.
    """
    residual = {n: F.col(n).cast("double") - model.mean_of(n) for n in model.order}
    out = df.withColumns({f"_r_{n}": r for n, r in residual.items()})
    for node in model.order:
        if node in change:
            value = change[node]
            new = value if isinstance(value, Column) else F.lit(float(value))
        else:
            new = model.mean_of(node, {p: F.col(p + suffix) for p in model.parents[node]}) + F.col(f"_r_{node}")
        out = out.withColumn(node + suffix, new)
    return out.drop(*[f"_r_{n}" for n in model.order])


def case_study(
    df: DataFrame, positive: Column, columns: Sequence[str], overrides: Mapping[str, float]
) -> DataFrame:
    """One row: means of the positive rows with chosen values overridden."""
    base = df.filter(positive).agg(*[F.avg(c).alias(c) for c in columns])
    return base.withColumns({c: F.lit(float(v)) for c, v in overrides.items()}) if overrides else base
