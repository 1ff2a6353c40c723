"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels stand on documents, the field needs them on words. In a bounded sample of labelled
documents, a form (a word or the beginning of one) is offensive if toxic documents hold it
far more often than clean ones, by a ratio and by a bound on chance over all forms. The
words of toxic documents that have such a form are the labelled tokens.

The field has two states. A word's evidence is a sum of weights of its hashed features
(the word, its beginnings, its end), and four moves between states have weights. All are
fitted to the likelihood of the labelled tokens by a quasi-Newton method; each evaluation
is one Spark job over the written sample, which returns a gradient for each task.

With two states, forward and backward vectors are one number each, their log odds. Their
sum is the marginal of a word. The largest marginal and the expected number of toxic words
make the document's score; words over one half are the offending offsets.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from math import exp, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import per_text, remainder
from cohortlens.session import materialise

WORD = re.compile(r"[^\W_]+")
BEGINNINGS = (3, 4, 5, 6)
HASH = xxhash.xxh32_intdigest


class Settings(NamedTuple):
    sample: int = 2000  # labelled documents drawn from each class, by a hash of id and text
    lexicon: int = 20_000  # offensive forms kept, the surest first
    ratio: float = 20.0  # times as frequent in toxic documents
    buckets: int = 1 << 16  # hashed features
    ridge: float = 0.3
    iterations: int = 25
    tasks: int = 8  # of one evaluation
    threshold: float = 0.5


class Field(NamedTuple):
    """Weights of the features in log odds of the toxic state, the first being of every word, and of the moves."""

    weights: np.ndarray
    moves: np.ndarray  # clean to toxic, toxic to clean, toxic to toxic; clean to clean is 0


class Model(NamedTuple):
    field: Field | None
    score: np.ndarray  # intercept, largest marginal, expected number of toxic words; or a constant


def folded(text: str) -> str:
    """Lower case, one character for each."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def forms(word: str) -> set[str]:
    return {word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) >= k)}


def features(word: str, buckets: int) -> list[int]:
    """As many for each word, so that arrays of them have a row for each word."""
    parts = [f"w{word}", f"e{word[-3:]}", *[f"b{word[:k]}" for k in (2, *BEGINNINGS)]]
    return [1 + HASH(p.encode("utf-8", "replace")) % (buckets - 1) for p in parts]


WIDTH = len(features("word", 2))


def chain(evidence: list[float], moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the forward and of the backward vectors. Their sum is that of the marginals."""
    into, out, stay = np.exp(moves).tolist()
    forward, x = [], 0.0
    for k, own in enumerate(evidence):
        if k:
            g = exp(x)
            x = own + log((into + g * stay) / (1 + g * out))
        else:
            x = own
        forward.append(x)
    backward, x = [0.0] * len(evidence), 0.0
    for k in range(len(evidence) - 2, -1, -1):
        g = exp(x + evidence[k + 1])
        x = log((out + g * stay) / (1 + g * into))
        backward[k] = x
    return np.array(forward), np.array(backward)


def loss(field: Field, found: np.ndarray, marks: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log likelihood of the marks of one text with the features ``found``, and its gradient."""
    into, out, stay = field.moves
    evidence = np.clip(field.weights[0] + field.weights[found].sum(axis=1), -300, 300)
    forward, backward = chain(evidence.tolist(), field.moves)
    ahead = (evidence + backward)[1:]
    before, after = marks[:-1], marks[1:]
    normal = np.logaddexp(0, forward[:-1] + out).sum() + np.logaddexp(0, forward[-1])
    counts = [((1 - before) * after).sum(), (before * (1 - after)).sum(), (before * after).sum()]
    value = normal - (evidence * marks).sum() - float(np.dot(field.moves, counts))
    pairs = np.stack([np.zeros(len(ahead)), into + ahead, forward[:-1] + out, forward[:-1] + stay + ahead])
    pairs = np.exp(pairs - np.logaddexp.reduce(pairs, axis=0)) if len(ahead) else pairs
    away = 1 / (1 + np.exp(-np.clip(forward + backward, -500, 500))) - marks
    slope = np.bincount(found.ravel(), np.repeat(away, found.shape[1]), minlength=len(field.weights))
    slope[0] += away.sum()
    return float(value), np.concatenate([slope, pairs[1:].sum(axis=1) - counts])


def minimised(start: np.ndarray, evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], iterations: int) -> np.ndarray:
    """Limited-memory quasi-Newton steps, each halved until it descends."""
    x, past = start, []
    value, slope = evaluate(x)
    for _ in range(iterations):
        way, used = slope.copy(), []
        for s, y in reversed(past):
            used.append(s @ way / (s @ y))
            way -= used[-1] * y
        way *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(slope).max())
        for (s, y), a in zip(past, reversed(used), strict=True):
            way += (a - y @ way / (s @ y)) * s
        step, drop = 1.0, slope @ way
        for _ in range(12):
            trial = x - step * way
            new, new_slope = evaluate(trial)
            if new <= value - 1e-4 * step * drop:
                break
            step /= 2
        else:
            return x
        s, y = trial - x, new_slope - slope
        if s @ y > 1e-10:
            past = [*past[-7:], (s, y)]
        done = value - new < 1e-5 * max(1.0, abs(new))
        x, value, slope = trial, new, new_slope
        if done:
            return x
    return x


def drawn(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(body, label) of at most ``sample`` rows of each class, written. ``docs`` has id and body, ``labels`` id and label.

    Ids are chosen first, so that texts are only read where they are needed.
    """
    known = labels.join(docs.select("id").filter("id is not null"), "id", "left_semi").distinct()
    lots = [
        known.filter(F.col("label") == k).orderBy(F.xxhash64(F.lit(7), "id"), "id").limit(settings.sample) for k in (0, 1)
    ]
    chosen = materialise(lots[0].unionByName(lots[1]), "drawn_ids")
    rows = docs.join(chosen, "id").select("body", "label", F.xxhash64("id", "body").alias("lot"))
    lots = [rows.filter(F.col("label") == k).orderBy("lot", "body").limit(settings.sample) for k in (0, 1)]
    return materialise(lots[0].unionByName(lots[1]).select("body", "label").repartition(settings.tasks), "drawn")


def offensive_forms(sample: DataFrame, toxic: int, clean: int, settings: Settings) -> set[str]:
    """Forms that stand for toxic documents: ``ratio`` times as frequent, and beyond chance over all forms."""
    listed = per_text(
        sample, ["label"], "body", lambda: lambda v: (sorted(set().union(*map(forms, set(WORD.findall(folded(v or "")))))),),
        "forms array<string>",
    )
    counts = listed.select("label", F.explode("forms").alias("form")).groupBy("form")
    counts = materialise(counts.agg(F.sum("label").alias("k"), F.count("*").alias("n")).filter("n > 1"), "forms")
    k, n, share = F.col("k"), F.col("n"), toxic / (toxic + clean)
    often = k / toxic >= settings.ratio * (n - k + 0.5) / clean
    surprise = k * F.log(k / n / share) + F.when(n > k, (n - k) * F.log((n - k) / n / (1 - share))).otherwise(0)
    sure = counts.filter(often & (surprise >= F.lit(log(max(1, counts.count())))))
    return {r["form"] for r in sure.orderBy(surprise.desc(), "form").limit(settings.lexicon).collect()}


def tokens_of(sample: DataFrame, lexicon: set[str], buckets: int) -> DataFrame:
    """(found, marks) of each text with a word: the features of its words, and 1 for the labelled tokens."""

    def make() -> Callable[[str | None, int], tuple]:
        marked, known = {}, {}

        def one(value: str | None) -> tuple:
            words = WORD.findall(folded(value or ""))
            for w in set(words):
                if w not in known:
                    known[w], marked[w] = features(w, buckets), int(not lexicon.isdisjoint(forms(w)))
            return [i for w in words for i in known[w]], [marked[w] for w in words]

        return one

    found = per_text(sample, ["label"], "body", make, "found array<int>, marks array<int>")
    marks = F.when(F.col("label") == 1, F.col("marks")).otherwise(F.transform("marks", lambda m: m * 0))
    return found.filter(F.size("found") > 0).select("found", marks.alias("marks"), "label")


def fit_field(tokens: DataFrame, settings: Settings) -> Field:
    """``tokens`` is written and bounded. Each evaluation is one job; each of its tasks sends one gradient."""

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        field = Field(x[: settings.buckets], x[settings.buckets :])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, slope = 0.0, np.zeros(len(x))
            for batch in batches:
                for found, marks in zip(batch.column(0), batch.column(1), strict=True):
                    part = loss(field, found.values.to_numpy().reshape(-1, WIDTH), marks.values.to_numpy().astype(float))
                    value, slope = value + part[0], slope + part[1]
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([slope.tobytes()])], ["value", "slope"])

        parts = tokens.select("found", "marks").mapInArrow(run, "value double, slope binary").collect()
        ridge = settings.ridge * x
        ridge[0] = 0
        value = sum(p["value"] for p in parts) + 0.5 * float(ridge @ x)
        return value, ridge + sum(np.frombuffer(p["slope"]) for p in parts)

    start = np.zeros(settings.buckets + 3)
    start[0], start[-3], start[-1] = -3.0, -1.0, 1.0
    found = minimised(start, evaluate, settings.iterations)
    return Field(found[: settings.buckets], found[settings.buckets :])


def tagger(field: Field) -> Callable[[str | None], tuple[float, float, list[tuple[int, int]]]]:
    """Gives the log odds of the likeliest toxic word, the expected number, and the offsets of the likely ones."""
    known: dict[str, float] = {}

    def one(value: str | None) -> tuple[float, float, list[tuple[int, int]]]:
        low = folded(value or "")
        words = WORD.findall(low)
        if not words:
            return -15.0, 0.0, []
        if len(known) > 500_000:
            known.clear()
        evidence = list(map(known.get, words))
        if None in evidence:
            new = list({w for w, e in zip(words, evidence, strict=True) if e is None})
            found = np.array([i for w in new for i in features(w, len(field.weights))]).reshape(-1, WIDTH)
            own = np.clip(field.weights[0] + field.weights[found].sum(axis=1), -300, 300)
            known.update(zip(new, own.tolist(), strict=True))
            evidence = [known[w] for w in words]
        forward, backward = chain(evidence, field.moves)
        odds = forward + backward
        expected = float((1 / (1 + np.exp(-np.clip(odds, -500, 500)))).sum())
        top = float(np.clip(odds.max(), -15, 15))
        spans = []
        if top >= 0:
            spans = [m.span() for m, likely in zip(WORD.finditer(low), (odds >= 0).tolist(), strict=True) if likely]
        return top, expected, spans

    return one


def fit_scores(found: np.ndarray, marks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(found)), found])
    at = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        ridge = np.array([1e-6, 1.0, 1.0])
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (weights * (marks - p)) - ridge * at)
        at = at + step
        if np.abs(step).max() < 1e-8:
            break
    return at


def aggregates(top: float, expected: float) -> list[float]:
    return [top, log(1 + expected)]


def learn(docs: DataFrame, labels: DataFrame, settings: Settings) -> Model:
    """From labelled rows that are not held out; ``docs`` has id and body, ``labels`` id and label."""
    sample = drawn(docs, labels, settings)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    shares = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    constant = Model(None, np.array([(shares.get(1, 0) + 1) / (sum(shares.values()) + 2)]))
    if not toxic or not clean:
        return constant
    lexicon = offensive_forms(sample, toxic, clean, settings)
    if not lexicon:
        return constant
    tokens = materialise(tokens_of(sample, lexicon, settings.buckets), "tokens")
    field = fit_field(tokens, settings)
    seen = per_text(sample, ["label"], "body", partial(_aggregated, field), "found array<double>").collect()
    marks = np.array([r["label"] for r in seen], float)
    weights = np.where(marks > 0, shares[1] / toxic, shares[0] / clean)
    return Model(field, fit_scores(np.array([r["found"] for r in seen]), marks, weights * len(marks) / weights.sum()))


def _aggregated(field: Field) -> Callable[[str | None], tuple]:
    tag = tagger(field)
    return lambda value: (aggregates(*tag(value)[:2]),)


def classify_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    settings: Settings = Settings(),
) -> DataFrame:
    """Toxicity of each document, learned from the labels of rows that are not held out.

    `spans` lists the offending words as start:end in code points, `n_toxic` counts them and `n_expected` adds up
    all marginals. Null and empty texts, and texts without a word, have no toxic word. Labels other than 0 and 1 are
    left out. Without labelled rows of both classes, or without an offensive form, all scores are the share of toxic
    labels with one row added to each class. Rows with a null id are scored, but match no label; repeated rows are
    repeated. Other columns are not looked at.
    """
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("body"))
    held = remainder("id", 5) == 0
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    model = learn(named.filter(~held), marked.filter(~held), settings)

    def make() -> Callable[[str | None], tuple]:
        tag = tagger(model.field) if model.field else None

        def one(value: str | None) -> tuple:
            if tag is None:
                score, expected, spans = float(model.score[0]), 0.0, []
            else:
                top, expected, spans = tag(value)
                odds = float(model.score @ [1.0, *aggregates(top, expected)])
                score = 1 / (1 + exp(-max(-500.0, min(500.0, odds))))
            return score, int(score >= settings.threshold), len(spans), expected, ",".join(f"{a}:{b}" for a, b in spans)

        return one

    out = per_text(named, ["id"], "body", make, "score double, predicted int, n_toxic long, n_expected double, spans string")
    return out.select(
        F.col("id").alias(doc_id), held.alias("held_out"), "score", "predicted", "n_toxic", "n_expected", "spans"
    )
