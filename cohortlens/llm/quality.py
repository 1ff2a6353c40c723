"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each class has a mean and a covariance of the transformed statistics, both from
sums over all training rows. A covariance is shrunk towards the pooled one and
towards a multiple of the identity, and its Cholesky factor is kept: the squared
Mahalanobis distance is the squared length of a triangular solution. The score is
the posterior of the difference of the two log densities.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import per_text, remainder
from cohortlens.session import materialise


class Settings(NamedTuple):
    pooled: float = 0.2  # share of the pooled covariance in that of a class
    ridge: float = 0.05  # share of the mean variance times the identity
    threshold: float = 0.7


NAMES = (
    "log_words", "word_length", "word_spread", "distinct_words", "distinct_pairs", "distinct_lines", "line_words",
    "symbols", "punctuation", "upper", "digits", "sentence_ends",
)
LETTER, UPPER, DIGIT, SPACE, STOP, SYMBOL, MARK = range(7)
CLASSES = np.full(128, MARK, np.uint8)
for kind, chars in ((LETTER, "abcdefghijklmnopqrstuvwxyz"), (UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (DIGIT, "0123456789"), (SPACE, " \t\n\v\f\r"), (STOP, ".!?"), (SYMBOL, "#*$%&|<>@^~=_\\{}[]+")):
    CLASSES[[ord(c) for c in chars]] = kind


def logit(share: float) -> float:
    """Shares are spread at both ends, so that few and none differ."""
    share = min(max(share, 0.0), 1.0)
    return float(np.log((share + 0.002) / (1.002 - share)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text; null is the empty text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n, chars = len(words), max(1, len(text))
    kinds = np.bincount(CLASSES[np.frombuffer(data, np.uint8) & 127][np.frombuffer(data, np.uint8) < 128], minlength=7)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
    lines = [line for line in text.split("\n") if line.strip()]
    letters = max(1, chars - int(kinds[DIGIT:].sum()))
    return [
        float(np.log1p(n)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        logit(len(set(words)) / max(1, n)),
        logit(len(set(zip(words, words[1:]))) / max(1, n - 1)),
        logit(len(set(lines)) / max(1, len(lines))),
        float(np.log1p(n / max(1, len(lines)))),
        logit(int(kinds[SYMBOL]) / chars),
        logit(int(kinds[MARK]) / chars),
        logit(int(kinds[UPPER]) / letters),
        logit(int(kinds[DIGIT]) / chars),
        logit(int(kinds[STOP]) / max(1, n)),
    ]


class Model(NamedTuple):
    prior: float  # log odds of the classes
    means: np.ndarray
    factors: np.ndarray  # inverse Cholesky factors of the covariances
    log_volumes: np.ndarray


def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray, settings: Settings) -> Model | float:
    """From the sums of each class; with one class only, its share with one row added to each class."""
    if (counts < 2).any():
        return float((counts[1] + 1) / (counts.sum() + 2))
    means = sums / counts[:, None]
    own = [p / n - np.outer(m, m) for p, n, m in zip(products, counts, means, strict=True)]
    pooled = (counts[0] * own[0] + counts[1] * own[1]) / counts.sum()
    factors, volumes = [], []
    for covariance in own:
        shrunk = (1 - settings.pooled) * covariance + settings.pooled * pooled
        d = len(shrunk)
        shrunk = (1 - settings.ridge) * shrunk + (settings.ridge * np.trace(shrunk) / d + 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        volumes.append(2 * np.log(np.diag(lower)).sum())
    return Model(float(np.log(counts[1] / counts[0])), means, np.array(factors), np.array(volumes))


def scorer(model: Model | float) -> Callable[[list[float]], float]:
    if isinstance(model, float):
        return lambda _: model

    def score(x: list[float]) -> float:
        away = [f @ (np.array(x) - m) for f, m in zip(model.factors, model.means, strict=True)]
        density = [-0.5 * (float(z @ z) + v) for z, v in zip(away, model.log_volumes, strict=True)]
        odds = density[1] - density[0] + model.prior
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))

    return score


def class_sums(train: DataFrame, label: str, values: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row count, sums and sums of products of each class: one row for each class, added up by Spark."""
    d = len(NAMES)
    at = lambda i: F.col(values)[i]
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    found = train.groupBy(label).agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(at(i)) for i in range(d)]).alias("sums"),
        F.array(*[F.sum(at(i) * at(j)) for i, j in upper]).alias("products"),
    )
    counts, sums, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in found.collect():
        k = int(r[label])
        counts[k], sums[k] = r["n"], r["sums"]
        for (i, j), v in zip(upper, r["products"], strict=True):
            products[k, i, j] = products[k, j, i] = v
    return counts, sums, products


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    settings: Settings = Settings(),
) -> DataFrame:
    """Score of each document, learned from the labels of rows that are not held out.

    Null and empty texts have the statistics of an empty text. Labels other than 0
    and 1 are left out; every row of a repeated label and of a repeated document
    counts. If a class has fewer than two rows, all scores are the share of class 1
    with one row added to each class (0.5 without labels). Rows with a null id are
    scored, but match no label. Other columns are not looked at.
    """
    held = F.coalesce(remainder("id") == 2, F.lit(False))
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    rows = materialise(
        per_text(named, ["id"], "body", lambda: lambda v: (statistics(v),), "x array<double>").withColumn("held_out", held),
        "statistics",
    )
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    model = fit(*class_sums(rows.filter("not held_out").join(marked, "id"), "label", "x"), settings)
    return _scored(rows, model, settings.threshold).withColumnRenamed("id", doc_id)


def _scored(rows: DataFrame, model: Model | float, threshold: float) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql import types as T

    def run(batches):
        score = scorer(model)
        for batch in batches:
            values = [score(v) for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(values, pa.float64()), pa.array([int(v >= threshold) for v in values], pa.int32())],
                ["id", "held_out", "score", "predicted"],
            )

    given = rows.select("id", "held_out", "x")
    fields = [*given.schema.fields[:2], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return given.mapInArrow(run, T.StructType(fields))
