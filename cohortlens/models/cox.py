"""Proportional hazards on ``(tstart, tstop]`` rows, Breslow ties, many back-tests at once."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.evaluation.running import running_totals
from cohortlens.session import materialise


@dataclass
class CoxModel:
    """One coefficient vector per group; ``baseline`` has the hazard steps of every group."""

    features: list[str]
    group: str
    means: np.ndarray
    coefficients: dict[object, np.ndarray]
    loglik: dict[object, float]
    iterations: int
    converged: dict[object, bool]
    baseline: DataFrame

    def table(self) -> DataFrame:
        """(group, feature, coefficient, converged) rows; a column without variation has a null coefficient."""
        spark = self.baseline.sparkSession
        kind = self.baseline.schema[self.group].dataType
        schema = T.StructType([
            T.StructField(self.group, kind),
            T.StructField("feature", T.StringType()),
            T.StructField("coefficient", T.DoubleType()),
            T.StructField("converged", T.BooleanType()),
        ])
        rows = [
            (g, f, None if np.isnan(b) else float(b), self.converged[g])
            for g, beta in self.coefficients.items()
            for f, b in zip(self.features, beta)
        ]
        return spark.createDataFrame(rows, schema)


def _linear(columns: Sequence[Column], group: str, betas: dict) -> Column:
    """``x b`` with the coefficients of the row's group.

    The coefficients are one literal map (a vector per back-test), so the rows
    meet them without a join and every step reuses the same compiled code.
    """
    vectors = []
    for g, b in betas.items():
        vectors += [F.lit(g), F.lit([float(v) for v in np.nan_to_num(b)])]
    b = F.element_at(F.create_map(*vectors), F.col(group))
    out = F.lit(0.0)
    for i, x in enumerate(columns):
        out = out + F.get(b, F.lit(i)) * x
    return out


def _listed(df: DataFrame, group: str) -> bool:
    return isinstance(df.schema[group].dataType, T.ArrayType)


def _one_group(df: DataFrame, group: str) -> DataFrame:
    """One row for each group of a row that has a list of them."""
    return df.withColumn(group, F.explode(group)) if _listed(df, group) else df


def _sums(rows: DataFrame, group: str, betas: dict, p: int) -> DataFrame:
    """Log-likelihood, gradient and information per group, from one pass over the rows.

    ``group`` is a row's group or the list of its groups; a row of several groups goes to its task once. A task adds up
    its rows per (group, event time) by matrix products and gives one row for each. Those of a group meet in one task,
    which holds a sum for each of its times and gives one row. Rows with a missing covariate are left out.
    """
    groups, matrix = list(betas), np.array([np.nan_to_num(b) for b in betas.values()]).reshape(len(betas), p)
    upper = np.triu_indices(p)
    place = F.create_map(*[v for i, g in enumerate(groups) for v in (F.lit(g), F.lit(i))])
    own = F.filter(group, lambda g: g.isin(groups)) if _listed(rows, group) else F.array(group)
    x = [F.col(f"_x{i}") for i in range(p)]
    given = rows.withColumn("_g", own) if _listed(rows, group) else rows.filter(F.col(group).isin(groups)).withColumn("_g", own)
    given = given.filter(F.size("_g") > 0).dropna(subset=[f"_x{i}" for i in range(p)])
    given = given.select(
        F.transform("_g", lambda g: F.element_at(place, g)).alias("_g"),
        F.col("_t").cast("long").alias("_t"), F.col("_e").cast("double").alias("_e"), F.array(*x).alias("_x"),
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            place_of = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            row_of = np.repeat(np.arange(n), batch.column(0).value_lengths().to_numpy(zero_copy_only=False))
            seen = np.bincount(row_of * len(groups) + place_of, minlength=n * len(groups)).reshape(n, len(groups))
            t, e = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            values = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            linear = np.where(seen > 0, values @ matrix.T, 0.0)
            weight, events = np.exp(linear) * seen, e[:, None] * seen
            order = np.argsort(t, kind="stable")
            times, first = np.unique(t[order], return_index=True)
            for time, at in zip(times.tolist(), np.split(order, first[1:]), strict=True):
                v, w, d = values[at], weight[at], events[at]
                head = [d.sum(axis=0), (d * linear[at]).sum(axis=0), w.sum(axis=0)]
                for g in np.flatnonzero(seen[at].any(axis=0)).tolist():
                    square = ((v * w[:, g : g + 1]).T @ v)[upper]
                    part = np.concatenate([[h[g] for h in head], d[:, g] @ v, w[:, g] @ v, square])
                    sums[g, time] = sums.get((g, time), 0.0) + part
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in sums], pa.int32()),
                pa.array([k[1] for k in sums], pa.int64()),
                pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64())),
            ],
            ["_g", "_t", "_sums"],
        )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            for g, t, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                times = sums.setdefault(g, {})
                times[t] = times.get(t, 0.0) + part.values.to_numpy()
        out = []
        for g, times in sums.items():
            at = np.array([v for v in times.values() if v[0] > 0]).reshape(-1, 3 + 2 * p + len(upper[0]))
            if not len(at):
                continue
            d, exb, s0 = at[:, 0], at[:, 1], at[:, 2]
            events, mean = at[:, 3 : 3 + p], at[:, 3 + p : 3 + 2 * p] / s0[:, None]
            square = at[:, 3 + 2 * p :] / s0[:, None] - mean[:, upper[0]] * mean[:, upper[1]]
            out.append((g, exb.sum() - d @ np.log(s0), (events - d[:, None] * mean).sum(axis=0), d @ square))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in out], pa.int32()),
                pa.array([r[1] for r in out], pa.float64()),
                *[pa.array([r[k].tolist() for r in out], pa.list_(pa.float64())) for k in (2, 3)],
            ],
            ["_g", "loglik", "grad", "info"],
        )

    parts = given.mapInArrow(add_up, "_g int, _t long, _sums array<double>").repartition("_g")
    found = parts.mapInArrow(finish, "_g int, loglik double, grad array<double>, info array<double>")
    return found.select(F.get(F.array(*[F.lit(g) for g in groups]), F.col("_g")).alias(group), "loglik", "grad", "info")


def hazard_steps(rows: DataFrame, group: str, betas: dict, p: int) -> DataFrame:
    """(group, time, hazard): Breslow steps of the baseline hazard at the given coefficients."""
    weight = F.exp(_linear([F.col(f"_x{i}") for i in range(p)], group, betas))
    steps = rows.withColumn("_w", weight).groupBy(group, "_t").agg((F.sum("_e") / F.sum("_w")).alias("hazard"))
    return steps.filter(F.col("hazard") > 0).withColumnRenamed("_t", "time")


def given_model(
    train: DataFrame, features: Sequence[str], event: str, coefficients: dict, group: str = "test_dt", step: int = 6
) -> CoxModel:
    """A model with coefficients from elsewhere (a file, another fit); its baseline hazard is that of ``train``."""
    features, p = list(features), len(features)
    betas = {g: np.asarray(b, float) for g, b in coefficients.items()}
    x = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    rows = at_risk_rows(train.filter(F.col(group).isin(list(betas))), event, step).select(group, "_t", "_e", *x)
    return CoxModel(
        features, group, np.zeros(p), betas, {g: float("nan") for g in betas}, 0, {g: False for g in betas},
        materialise(hazard_steps(rows, group, betas, p), "hazard"),
    )


def at_risk_rows(
    df: DataFrame, event: str, step: int, tstart: str = "tstart", tstop: str = "tstop"
) -> DataFrame:
    """One row per step a row is at risk in (``_t``), with its event in the last one (``_e``)."""
    times = F.sequence(F.col(tstart) + step, F.col(tstop), F.lit(step))
    return df.withColumn("_t", F.explode(times)).withColumn(
        "_e", F.when(F.col("_t") == F.col(tstop), F.col(event)).otherwise(0)
    )


def partial_likelihood(
    train: DataFrame, features: Sequence[str], event: str, coefficients: dict, group: str = "test_dt", step: int = 6
) -> DataFrame:
    """(group, loglik, grad, info) of each back-test at its given coefficients.

    ``grad`` has one value per feature, ``info`` the upper triangle row by row. At
    the coefficients of a fit the gradient is zero.
    """
    x = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    rows = at_risk_rows(train.filter(F.col(group).isin(list(coefficients))), event, step).select(group, "_t", "_e", *x)
    return _sums(rows, group, coefficients, len(features))


def score_products(rows: DataFrame, group: str, entity: str, betas: dict, p: int) -> DataFrame:
    """(group, meat): sums over entities of the products of their score residuals, upper triangle row by row.

    ``rows`` come from ``at_risk_rows``, with covariates ``_x0``... A row's residual at a time is its distance from the
    weighted mean of the risk set, times its event less its expected events there. The means are one row for each
    (group, time); an entity's residuals are added up before any product is made.
    """
    names = [f"_x{i}" for i in range(p)]
    given = rows.filter(F.col(group).isin(list(betas))).dropna(subset=names)
    given = given.withColumn("_w", F.exp(_linear([F.col(n) for n in names], group, betas)))
    sets = given.groupBy(group, "_t").agg(
        (F.sum("_e") / F.sum("_w")).alias("_hazard"),
        *[(F.sum(F.col("_w") * F.col(n)) / F.sum("_w")).alias(f"_m{i}") for i, n in enumerate(names)],
    )
    excess = F.col("_e") - F.col("_w") * F.col("_hazard")
    residuals = given.join(sets.filter(F.col("_hazard") > 0), [group, "_t"]).groupBy(group, entity).agg(
        *[F.sum((F.col(n) - F.col(f"_m{i}")) * excess).alias(f"_u{i}") for i, n in enumerate(names)]
    )
    products = [F.sum(F.col(f"_u{i}") * F.col(f"_u{j}")) for i in range(p) for j in range(i, p)]
    return residuals.groupBy(group).agg(F.array(*products).alias("meat"))


def coefficient_errors(
    model: CoxModel, train: DataFrame, event: str, entity: str, step: int = 6
) -> DataFrame:
    """(group, feature, coefficient, std_error, robust_error) of every back-test.

    ``std_error`` is that of the information, ``robust_error`` that of the sandwich with the residuals of an entity
    added up, for entities whose rows aren't independent. Null for a column without variation. A back-test without an
    event has no rows.
    """
    features, group, p = model.features, model.group, len(model.features)
    betas = {g: np.nan_to_num(b) for g, b in model.coefficients.items()}
    x = [(F.col(f).cast("double") - F.lit(float(m))).alias(f"_x{i}") for i, (f, m) in enumerate(zip(features, model.means, strict=True))]
    own = train.withColumn("_entity", F.col(entity))
    rows = at_risk_rows(own, event, step).select(group, "_entity", "_t", "_e", *x)
    upper = np.triu_indices(p)

    def square(values: Sequence[float]) -> np.ndarray:
        out = np.zeros((p, p))
        out[upper] = values
        return out + np.triu(out, 1).T

    # one row for each back-test
    info = {r[group]: square(r["info"]) for r in _sums(rows, group, betas, p).collect()}
    meat = {r[group]: square(r["meat"]) for r in score_products(rows, group, "_entity", betas, p).collect()}
    out = []
    for g, matrix in info.items():
        inverse = np.linalg.pinv(matrix, rcond=1e-10, hermitian=True)
        plain, robust = np.diag(inverse), np.diag(inverse @ meat[g] @ inverse)
        fixed = np.isnan(model.coefficients[g]) | (np.diag(matrix) <= 1e-9 * max(1.0, np.max(np.diag(matrix))))
        for i, f in enumerate(features):
            known = None if fixed[i] else (float(betas[g][i]), float(np.sqrt(plain[i])), float(np.sqrt(robust[i])))
            out.append((g, f, *(known or (None, None, None))))
    schema = T.StructType([
        T.StructField(group, train.schema[group].dataType),
        T.StructField("feature", T.StringType()),
        *[T.StructField(n, T.DoubleType()) for n in ("coefficient", "std_error", "robust_error")],
    ])
    return train.sparkSession.createDataFrame(out, schema)


def fit_cox(
    train: DataFrame,
    features: Sequence[str],
    event: str,
    group: str = "test_dt",
    step: int = 6,
    max_iterations: int = 25,
    tolerance: float = 1e-9,
) -> CoxModel:
    """Newton steps with halving, all back-tests in the same pass.

    ``train`` is keyed by ``group`` (see ``backtest_rows``), or ``group`` is the list
    of a row's groups (see ``backtest_lists``), which spares a copy of the row for
    each. It is read once per step: give it as a plan over a written table. One Spark
    job per step, however many back-tests; the 12 x 12 solves run on the driver. A
    back-test that is still open after ``max_iterations`` is marked and warned about.
    """
    features = list(features)
    p = len(features)
    # centre and scale: the same model, better conditioned
    sums = {"n": F.count("*")}
    for i, f in enumerate(features):
        value = F.col(f).cast("double")
        sums |= {f"k{i}": F.count(f), f"m{i}": F.sum(value), f"q{i}": F.sum(value * value)}
    moments = train.groupBy(group).agg(*[v.alias(n) for n, v in sums.items()])
    if _listed(train, group):
        # as many rows as there are different lists
        moments = _one_group(moments, group).groupBy(group).agg(*[F.sum(n).alias(n) for n in sums])
    moments = moments.collect()
    groups = [r[group] for r in moments]
    if not groups:
        raise ValueError("no training rows")
    share = np.array([r["n"] for r in moments], dtype=float) / sum(r["n"] for r in moments)
    means = np.array([sum(s * (r[f"m{i}"] or 0.0) / max(r[f"k{i}"], 1) for s, r in zip(share, moments)) for i in range(p)])
    squares = np.array([sum(s * (r[f"q{i}"] or 0.0) / max(r[f"k{i}"], 1) for s, r in zip(share, moments)) for i in range(p)])
    scale = np.sqrt(np.maximum(squares - means**2, 0.0))
    scale[scale < 1e-9 * (1.0 + np.abs(means))] = 1.0
    rows = at_risk_rows(train, event, step).select(
        group, "_t", "_e",
        *[
            ((F.col(f).cast("double") - F.lit(float(means[i]))) / F.lit(float(scale[i]))).alias(f"_x{i}")
            for i, f in enumerate(features)
        ],
    )
    best = {g: (-np.inf, np.zeros(p)) for g in groups}
    trial = {g: np.zeros(p) for g in groups}
    direction: dict = {}
    open_groups = set(groups)
    fixed: dict = {g: np.zeros(p, dtype=bool) for g in groups}
    iterations = 0
    while open_groups and iterations < max_iterations:
        iterations += 1
        answers = {r[group]: r for r in _sums(rows, group, {g: trial[g] for g in open_groups}, p).collect()}
        for g in list(open_groups):
            row = answers.get(g)
            if row is None:  # no event in this back-test's past
                open_groups.discard(g)
                continue
            value, before = row["loglik"], best[g][0]
            if np.isfinite(before) and value < before - 1e-10 * abs(before):
                direction[g] = direction[g] / 2
                trial[g] = best[g][1] + direction[g]
                if np.max(np.abs(direction[g])) < 1e-10:
                    open_groups.discard(g)
                continue
            best[g] = (value, trial[g])
            if np.isfinite(before) and abs(value - before) <= tolerance * (abs(value) + tolerance):
                open_groups.discard(g)
                continue
            info = np.zeros((p, p))
            info[np.triu_indices(p)] = row["info"]
            info = info + np.triu(info, 1).T
            # a column that does not vary inside the risk sets carries no information
            fixed[g] = np.diag(info) <= 1e-9 * max(1.0, np.max(np.diag(info)))
            direction[g] = np.linalg.pinv(info, rcond=1e-10, hermitian=True) @ np.array(row["grad"])
            direction[g][fixed[g]] = 0.0
            trial[g] = best[g][1] + direction[g]
    if open_groups:
        warnings.warn(f"not converged after {max_iterations} steps: {sorted(map(str, open_groups))}", stacklevel=2)
    scaled = {g: b for g, (_, b) in best.items()}
    coefficients = {g: np.where(fixed[g], np.nan, b / scale) for g, b in scaled.items()}
    return CoxModel(
        features, group, means, coefficients, {g: best[g][0] for g in groups}, iterations,
        {g: g not in open_groups for g in groups},
        materialise(hazard_steps(_one_group(rows, group), group, scaled, p), "hazard"),
    )


def predict_expected(
    model: CoxModel, df: DataFrame, tstart: str = "tstart", tstop: str = "tstop"
) -> DataFrame:
    """Add ``predict`` (expected events in the row's interval) and ``event_prob`` = 1 - exp(-predict).

    The cumulative hazard is made once for every (back-test, time) at which an
    interval starts or ends, and is met by equality on both ends.
    """
    g = model.group
    rows = df.filter(F.col(g).isin(list(model.coefficients)))
    times = rows.select(g, F.explode(F.array(F.col(tstart).cast("double"), F.col(tstop).cast("double"))).alias("time")).filter("time is not null").distinct()
    steps = (
        times.withColumn("hazard", F.lit(0.0))
        .unionByName(model.baseline.select(g, F.col("time").cast("double"), "hazard"))
        .groupBy(g, "time")
        .agg(F.sum("hazard").alias("hazard"))
    )
    reached = running_totals(steps, [g], "time", ["hazard"], descending=False).select(g, "time", "cum_hazard")
    x = [F.col(f).cast("double") - F.lit(float(m)) for f, m in zip(model.features, model.means)]
    for end, name in ((tstart, "_before"), (tstop, "_after")):
        at = reached.select(g, F.col("time").alias(f"{name}_t"), F.col("cum_hazard").alias(name))
        rows = rows.withColumn(f"{name}_t", F.col(end).cast("double")).join(at, [g, f"{name}_t"], "left").drop(f"{name}_t")
    total = F.greatest(F.col("_after") - F.col("_before"), F.lit(0.0))
    return (
        rows.withColumn("risk", F.exp(_linear(x, g, model.coefficients)))
        .withColumn("predict", F.col("risk") * F.when(F.col("_after").isNull() | F.col("_before").isNull(), 0.0).otherwise(total))
        .withColumn("event_prob", 1 - F.exp(-F.col("predict")))
        .select(*df.columns, "risk", "predict", "event_prob")
    )
