"""Boosted trees with a share of the columns per tree, a falling step, shares per class, folds and staged scores.

Spark's own boosted trees have none of these. Each round fits one regression tree of Spark ML to the gradients of the log
loss and gives every leaf the Newton step of its rows. Rows stay in Spark; the driver holds the trees and one value for
each leaf.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.evaluation import curves
from cohortlens.models.board import assembler, fold_rows
from cohortlens.models.fits import together
from cohortlens.operators.assemble import hash_percent
from cohortlens.session import materialise


@dataclass(frozen=True)
class Settings:
    """What a fit is told. Shares of rows count in whole percents.

    ``class_shares`` are the shares of rows with label 0 and 1 that a round sees; ``annealing`` multiplies the step after
    every round; ``leaf_limit`` bounds the absolute value of a leaf; after every ``cut`` rounds the scores are written.
    """

    rounds: int = 50
    depth: int = 5
    step: float = 0.1
    annealing: float = 1.0
    tree_columns: float = 1.0
    split_columns: float = 1.0
    class_shares: tuple[float, float] = (1.0, 1.0)
    min_rows: int = 1
    min_gain: float = 0.0
    bins: int = 32
    leaf_limit: float | None = None
    seed: int = 23
    cut: int = 10

    def __post_init__(self):
        shares = (self.tree_columns, self.split_columns, *self.class_shares)
        if any(not 0 < s <= 1 for s in shares) or any(round(100 * s) < 1 for s in self.class_shares):
            raise ValueError("a share is above 0, at least one percent for rows, and at most 1")


#: Name in a parameter file -> field of ``Settings`` (fixed correspondence).
NAMES = {
    "ntrees": "rounds", "max_depth": "depth", "learn_rate": "step", "learn_rate_annealing": "annealing",
    "col_sample_rate_per_tree": "tree_columns", "col_sample_rate": "split_columns", "min_rows": "min_rows",
    "min_split_improvement": "min_gain", "nbins": "bins", "max_abs_leafnode_pred": "leaf_limit", "seed": "seed",
}


def from_params(params: Mapping[str, object] | str, leave: Sequence[str] = ()) -> tuple[Settings, int]:
    """Settings and number of folds (0: none) from a parameter file (JSON text or ``{name: value | {"actual": value}}``).

    ``sample_rate_per_class`` goes before ``sample_rate``. A parameter without counterpart is an error unless it is named
    in ``leave`` or has no value.
    """
    if isinstance(params, str):
        params = json.loads(params)
    read = {k: v["actual"] if isinstance(v, Mapping) else v for k, v in params.items()}
    given = {k: v for k, v in read.items() if v is not None and v is not False}
    folds = int(given.pop("nfolds", 0))
    both, single = given.pop("sample_rate_per_class", None), given.pop("sample_rate", None)
    other = sorted(set(given) - set(NAMES) - set(leave))
    if other:
        raise ValueError(f"no counterpart for {', '.join(other)}")
    known = {NAMES[k]: v for k, v in given.items() if k in NAMES}
    known |= {k: int(known[k]) for k in ("rounds", "depth", "min_rows", "bins", "seed") if k in known}
    if both is not None or single is not None:
        known["class_shares"] = tuple(float(s) for s in (both or (single, single)))
    return Settings(**known), folds


def tree_features(features: Sequence[str], settings: Settings, at: int) -> list[int]:
    """The columns that tree ``at`` (from 1) may use: the first by a hash of name, seed and round, in their own order."""
    count = math.ceil(round(settings.tree_columns * len(features), 9))
    digest = lambda i: hashlib.md5(f"{features[i]}/{settings.seed}/{at}".encode()).hexdigest()
    return sorted(sorted(range(len(features)), key=digest)[:count])


def feature_values(features: Sequence[str]) -> dict[str, Column]:
    """The columns ``_f0``... that trees read; a null is NaN, which goes to the right."""
    return {f"_f{i}": F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for i, f in enumerate(features)}


@dataclass
class Tree:
    """A fitted tree over some columns, and what it adds to the log odds at each leaf.

    It is read from its description, so rows meet it as nested conditions on ``_f0``...: no vector is made or cut for
    them. Leaves count from the left.
    """

    columns: list[int]
    model: RandomForestRegressionModel
    adds: list[float]

    def __post_init__(self):
        lines = iter(self.model.trees[0].toDebugString.splitlines()[1:])
        self.leaves = 0
        self.root = self._read(lines)

    def _read(self, lines: Iterator[str]) -> int | tuple:
        line = next(lines).strip()
        if line.startswith("Predict:"):
            self.leaves += 1
            return self.leaves - 1
        feature, edge = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        left = self._read(lines)
        next(lines)  # Else
        return self.columns[int(feature)], float(edge), left, self._read(lines)

    def _at(self, values: Sequence[float | int], node: int | tuple) -> Column:
        if isinstance(node, int):
            return F.lit(values[node])
        column, edge, left, right = node
        return F.when(F.col(f"_f{column}") <= edge, self._at(values, left)).otherwise(self._at(values, right))

    def leaf(self) -> Column:
        return self._at(range(self.leaves), self.root)

    def added(self) -> Column:
        return self._at(self.adds, self.root)


def probability(score: str) -> Column:
    return 1 / (1 + F.exp(-F.col(score)))


@dataclass
class Boosted:
    """A fitted model: log odds at the start, and its trees in order."""

    features: list[str]
    start: float
    trees: list[Tree] = field(default_factory=list)

    def cut_at(self, stage: int) -> Boosted:
        """The model after its first ``stage`` trees."""
        return Boosted(self.features, self.start, self.trees[:stage])

    def score(self, df: DataFrame, keys: Sequence[str], label: str | None = None, name: str = "p1") -> DataFrame:
        """Keys, label, probability and hard prediction (1 above one half) of every row."""
        columns = dict.fromkeys([*keys, *([label] if label else [])])
        out = df.withColumns(feature_values(self.features)).withColumn("_score", F.lit(self.start))
        for tree in self.trees:
            out = out.withColumn("_score", F.col("_score") + tree.added())
        out = out.withColumn(name, probability("_score"))
        return out.select(*columns, name, (F.col(name) > 0.5).cast("int").alias("predict"))

    def staged(self, df: DataFrame, keys: Sequence[str], label: str, every: int = 1) -> DataFrame:
        """Keys, label, stage and probability after each ``every`` trees and after the last, from one pass over the rows."""
        columns = dict.fromkeys([*keys, label])
        out = df.withColumns(feature_values(self.features)).withColumn("_score", F.lit(self.start))
        stages = sorted({*range(every, len(self.trees) + 1, every), len(self.trees)})
        for at, tree in enumerate(self.trees, 1):
            out = out.withColumn("_score", F.col("_score") + tree.added())
            if at in stages:
                out = out.withColumn(f"_p{at}", probability("_score"))
        if not self.trees:
            out = out.withColumn("_p0", probability("_score"))
        each = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"_p{s}").alias("p1")) for s in stages])
        return out.select(*columns, F.inline(each))


def fit(df: DataFrame, features: Sequence[str], label: str, key: str, settings: Settings = Settings()) -> Boosted:
    """Boosted trees on the rows whose label is 0 or 1.

    A round leaves rows out by a hash of ``key``, so a key is drawn as a whole and equal at any partitioning. With one
    class only, or without rows, there are no trees: every row gets the share of positives (0.5 without rows), kept within
    one millionth of 0 and 1. Null features are NaN, which trees send to the right.
    """
    s, features = settings, list(features)
    values = feature_values(features)
    rows = df.filter(F.col(label).isin(0, 1)).select(
        F.col(key).alias("_key"), F.col(label).cast("double").alias("_y"), *[v.alias(n) for n, v in values.items()]
    )
    rows = materialise(rows, "boost")
    seen = rows.agg(F.count("*").alias("n"), F.sum("_y").alias("p")).first()
    mean = min(max(seen["p"] / seen["n"], 1e-6), 1 - 1e-6) if seen["n"] else 0.5
    model = Boosted(features, math.log(mean / (1 - mean)))
    if not seen["n"] or seen["p"] in (0, seen["n"]):
        return model
    rows = rows.withColumn("_score", F.lit(model.start))
    for at in range(1, s.rounds + 1):
        percent = F.when(F.col("_y") == 1, round(100 * s.class_shares[1])).otherwise(round(100 * s.class_shares[0]))
        picked = rows if s.class_shares == (1.0, 1.0) else rows.filter(hash_percent("_key", s.seed + at) < percent)
        p = probability("_score")
        picked = picked.select(*values, (F.col("_y") - p).alias("_g"), (p * (1 - p)).alias("_h"))
        columns = tree_features(features, s, at)
        sliced = assembler([f"_f{i}" for i in columns]).setOutputCol("_slice").transform(picked).select("_slice", "_g")
        # one tree of a forest is a plain tree, with a share of the columns at each split
        single = RandomForestRegressor(
            featuresCol="_slice", labelCol="_g", numTrees=1, bootstrap=False, maxDepth=s.depth, maxBins=s.bins,
            minInstancesPerNode=s.min_rows, minInfoGain=s.min_gain, seed=s.seed + at,
            featureSubsetStrategy="all" if s.split_columns >= 1 else str(s.split_columns),
        )
        tree = Tree(columns, single.fit(sliced), [])
        sums = picked.groupBy(tree.leaf().alias("_leaf")).agg(F.sum("_g").alias("g"), F.sum("_h").alias("h")).collect()
        step = s.step * s.annealing ** (at - 1)
        leaf = {r["_leaf"]: r["g"] / max(r["h"], 1e-12) for r in sums}
        bound = math.inf if s.leaf_limit is None else s.leaf_limit
        tree.adds = [step * min(max(leaf.get(i, 0.0), -bound), bound) for i in range(tree.leaves)]
        model.trees.append(tree)
        if at < s.rounds:
            rows = rows.withColumn("_score", F.col("_score") + tree.added())
            if at % s.cut == 0:
                rows = materialise(rows, "boost")
    return model


def stage_areas(model: Boosted, df: DataFrame, label: str, every: int = 1) -> DataFrame:
    """Areas under the curve of every stage on ``df``, all stages together."""
    staged = materialise(model.staged(df, [], label, every), "stages")
    return curves.areas(curves.score_curve(staged, "p1", label, ["stage"]), ["stage"])


def stop_by_area(
    model: Boosted, df: DataFrame, label: str, tolerance: float = 0.001, every: int = 1
) -> tuple[Boosted, DataFrame]:
    """The model cut at the smallest stage whose area on ``df`` is within ``tolerance`` of the largest, and all areas.

    Without both classes in ``df`` no stage has an area, and the model stays whole.
    """
    board = materialise(stage_areas(model, df, label, every).select("stage", "auroc", "auprc"), "areas")
    best = board.agg(F.max("auroc").alias("m")).first()["m"]
    if best is None:
        return model, board
    stage = board.filter(F.col("auroc") >= best - tolerance).agg(F.min("stage").alias("s")).first()["s"]
    return model.cut_at(stage), board


def out_of_fold(
    df: DataFrame, features: Sequence[str], label: str, key: str, settings: Settings = Settings(), folds: int = 3,
    keep: Sequence[str] = (), threads: int = 4,
) -> DataFrame:
    """Every row scored by the model of the other folds; folds by a hash of ``key``, fits side by side."""
    rows = materialise(fold_rows(df, key, folds, settings.seed), "boost_folds")
    models = together(
        {k: lambda k=k: fit(rows.filter(F.col("fold") != k), features, label, key, settings) for k in range(folds)}, threads
    )
    columns = ["fold", *dict.fromkeys([key, *keep])]
    parts = [m.score(rows.filter(F.col("fold") == k), columns, label) for k, m in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
