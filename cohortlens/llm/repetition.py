"""Quality rules on repetition: how much of a text lies inside repeated word runs and lines.

Words become numbers, and word runs of each length a rolling hash over those
numbers: the hash of a run of n words is that of the run of n - 1 words times a
base, plus the next word, in 64-bit arithmetic. A run is repeated if its hash
occurs twice in the text. What counts is the share of characters under repeated
runs, so overlapping runs count once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import fresh, per_text

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
BASE = np.uint64(0x9E3779B97F4A7C15)


class Rules(NamedTuple):
    """Limits; a text beyond any of them goes.

    ``runs`` holds, per run length, the largest share of word characters that may
    lie in repeated runs of that length (first occurrence included).
    """

    least_words: int = 50
    repeat_percent: int = 50
    runs: tuple[tuple[int, float], ...] = ((5, 0.40), (6, 0.38), (7, 0.36), (8, 0.34), (9, 0.32), (10, 0.30))
    line_share: float = 0.50
    line_char_share: float = 0.40
    symbols_per_word: float = 0.10


class Measures(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_share: float
    line_char_share: float
    run_shares: list[float]


def covered(codes: np.ndarray, length: int, n_words: int) -> np.ndarray | None:
    """Which words lie in a run whose code occurs at least twice; None if no run does."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return None
    twice = np.zeros(len(codes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n_words + 1, np.int64)
    edge[: len(codes)] += twice
    edge[length : length + len(codes)] -= twice
    return np.cumsum(edge[:-1]) > 0


def triples(ids: np.ndarray, distinct: int) -> np.ndarray:
    """A number for each run of three words, equal only for equal runs."""
    if distinct >= 1 << 21:  # three numbers would not fit into one; number the pairs first
        ids = ids.astype(np.int64)
        pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1].reshape(-1)
        return pairs[:-1] * distinct + ids[2:]
    return (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]


def measure(text: str | None, lengths: tuple[int, ...]) -> Measures:
    """The figures of one whole text; null is the empty text."""
    text = text or ""
    words = text.encode().split()  # bytes split at ASCII white space only
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)

    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    unique = dict.fromkeys(lines)
    dup_lines = len(lines) - len(unique)
    dup_chars = sum(map(len, lines)) - sum(map(len, unique)) if dup_lines else 0
    total = sum(map(len, lines))

    vocabulary = dict.fromkeys(words)
    shares, repeated = [0.0] * len(lengths), 0
    if n >= 3 and len(vocabulary) < n:
        number = dict(zip(vocabulary, range(len(vocabulary))))
        ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
        under = covered(triples(ids, len(vocabulary)), 3, n)
        if under is not None:
            repeated = int(under.sum())
            shares = run_shares(words, ids, lengths)
    return Measures(
        n, chars, symbols, dup_lines, repeated, dup_lines / max(1, len(lines)), dup_chars / max(1, total), shares
    )


def run_shares(words: list[bytes], ids: np.ndarray, lengths: tuple[int, ...]) -> list[float]:
    """Share of word characters under repeated runs of each length."""
    n, shares = len(words), [0.0] * len(lengths)
    widths = None
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        rolled = mixed
        for length in range(2, max(lengths, default=0) + 1):
            if length > n:
                break
            rolled = rolled[:-1] * BASE + mixed[length - 1 :]
            if length not in lengths:
                continue
            under = covered(rolled, length, n)
            if under is None:  # then no longer run is repeated either
                break
            if widths is None:
                widths = np.fromiter((len(w.decode()) for w in words), np.int64, n)
            shares[lengths.index(length)] = float(widths[under].sum() / widths.sum())
    return shares


def broken(m: Measures, rules: Rules) -> list[str]:
    """Names of the rules that the figures break, the two base rules first."""
    out = []
    if m.n_words < rules.least_words:
        out.append("few_words")
    if 100 * m.n_repeat_words > rules.repeat_percent * m.n_words:
        out.append("repeat_words")
    if m.line_share > rules.line_share:
        out.append("dup_lines")
    if m.line_char_share > rules.line_char_share:
        out.append("dup_line_chars")
    if m.n_symbols > rules.symbols_per_word * m.n_words:
        out.append("symbols")
    out += [
        f"run_{length}" for (length, limit), share in zip(rules.runs, m.run_shares, strict=True) if share > limit
    ]
    return out


def repetition_rules(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """The figures and the verdict of each document; one row for each row.

    A null or empty text has zero counts and goes for its few words. Repeated rows
    get equal rows. Columns other than the two named are not looked at. `broken`
    names the rules that a text breaks.
    """
    lengths = tuple(length for length, _ in rules.runs)

    def one(value: str | None) -> tuple:
        m = measure(value, lengths)
        names = broken(m, rules)
        base = "few_words" in names or "repeat_words" in names
        return (*m[:5], m.line_char_share, max(m.run_shares, default=0.0), ",".join(names), base, not names)

    return per_text(
        df,
        [doc_id],
        text,
        lambda: one,
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "dup_line_char_share double, max_run_share double, broken string, base_failed boolean, kept boolean",
    )


def keep_by_rules(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows whose text breaks no rule, with all their columns."""
    lengths, name = tuple(length for length, _ in rules.runs), fresh(df, "kept")
    out = per_text(df, df.columns, text, lambda: lambda v: (not broken(measure(v, lengths), rules),), f"{name} boolean")
    return out.filter(F.col(name)).drop(name)
