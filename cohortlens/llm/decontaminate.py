"""Training documents that hold benchmark items, exact, edited or paraphrased.

Items are read in blocks of bounded size, which every task gets whole. A first
pass counts how often each word run of the items occurs in all documents. Of
every stretch of an item the commonest quarter of its runs is set aside; the
others, the rare ones, are the seeds. A second pass looks the runs of each document
up among the seeds, and where a seed is met, the passage around it is aligned with
the item by Smith-Waterman over words. No document row is shuffled in either
pass, so neither a hot source nor a passage in very many documents matters.

With several blocks the hits of each are written before the next block is read, so
that one block lives at a time; they meet in an aggregation by text digest and item.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cohortlens.llm.common import columns_of, fresh
from cohortlens.session import materialise, scratch_path

#: Digits, ASCII letters and all bytes of other characters make words, after `_apart`.
FOLD = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
BEYOND = re.compile(r"[^\x00-\x7f]+")
#: Scripts written without spaces: each of their characters is a word. CJK, kana, Bopomofo, Yi, Thai, Lao, Burmese,
#: Khmer, Tai, Balinese, Javanese.
UNSEGMENTED = (
    (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3040, 0x30FA), (0x30FC, 0x312F), (0x31A0, 0x31BF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F),
    (0x20000, 0x3FFFF), (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF),
    (0x1B00, 0x1B7F), (0xA980, 0xA9FF), (0xAA60, 0xAADF),
)
MULTIPLIER = 0x9E3779B97F4A7C15


class Settings(NamedTuple):
    """An item counts as held if the alignment reaches ``share`` of the item's own score, or as many matches as
    ``long_match`` words; items shorter than ``seed`` words can't be told from chance within a longer text and are held
    by a document that has just their words."""

    seed: int = 3
    stretch: int = 32
    common: float = 0.25
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    share: float = 0.5
    long_match: int = 40
    block_chars: int = 8 << 20


class Hit(NamedTuple):
    item: int
    score: int
    share: float
    first_word: int
    last_word: int


class _Apart(dict):
    """What stands for a character beyond ASCII: a space for punctuation, spaces and controls, nothing for format marks
    inside words, the character by itself for scripts without spaces."""

    def __missing__(self, code: int) -> str:
        char, kind = chr(code), unicodedata.category(chr(code))
        if kind == "Cf" and code != 0x200B:
            char = ""
        elif kind[0] in "PZC":
            char = " "
        elif any(a <= code <= b for a, b in UNSEGMENTED):
            char = f" {char} "
        self[code] = char
        return char


_apart = _Apart()


def words_of(text: str | None) -> list[bytes]:
    text = (text or "").lower()
    if not text.isascii():
        text = BEYOND.sub(lambda m: m[0].translate(_apart), text)
    return text.encode().translate(FOLD).split()


def runs(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and codes of the runs of n known words; unknown words are negative."""
    if len(ids) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    known = ids >= 0
    ok = known[: len(ids) - n + 1].copy()
    for k in range(1, n):
        ok &= known[k : len(ids) - n + 1 + k]
    at = np.flatnonzero(ok)
    code = np.zeros(len(at), np.uint64)
    for k in range(n):
        code = code * np.uint64(MULTIPLIER) + ids[at + k].astype(np.uint64) + np.uint64(1)
    return at, code


class Block:
    """The items of one block as numbers, with their runs."""

    def __init__(self, items: list[tuple], settings: Settings) -> None:
        self.settings = settings
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary))
        self.words = [np.array([number(w) for w in words_of(text)], np.int64) for _, text in items]
        self.short: dict[bytes, list[int]] = {}
        for i, w in enumerate(self.words):
            if 0 < len(w) < settings.seed:
                self.short.setdefault(w.tobytes(), []).append(i)
        found = [runs(w, settings.seed) for w in self.words]
        self.codes, run = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c for _, c in found)]), return_inverse=True)
        item = np.repeat(np.arange(len(found)), [len(at) for at, _ in found])
        place = np.concatenate([np.zeros(0, np.int64), *(at for at, _ in found)])
        self.rows = np.stack([run.ravel().astype(np.int64), item, place], axis=1)  # run, item, position
        self.seeds = self.rows[np.argsort(self.rows[:, 0], kind="stable")]  # by run; all of them until some are chosen

    def numbers(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))

    def met(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of the items occur, and which."""
        at, code = runs(ids, self.settings.seed)
        if not len(at) or not len(self.codes):
            return at[:0], np.zeros(0, np.int64)
        run = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        same = self.codes[run] == code
        return at[same], run[same]

    def choose(self, counts: np.ndarray) -> None:
        """Keeps as seeds what is left of each stretch of each item without its commonest runs."""
        order = np.lexsort((self.rows[:, 2], counts[self.rows[:, 0]], self.rows[:, 2] // self.settings.stretch, self.rows[:, 1]))
        rows = self.rows[order]
        key = rows[:, 1] * (1 << 32) + rows[:, 2] // self.settings.stretch
        _, first, size = np.unique(key, return_index=True, return_counts=True)  # keys ascend
        rank = np.arange(len(rows)) - np.repeat(first, size)
        kept = np.maximum(1, size - (size * self.settings.common).astype(np.int64))
        seeds = rows[rank < np.repeat(kept, size)]
        self.seeds = seeds[np.argsort(seeds[:, 0], kind="stable")]

    def find(self, text: str | None) -> list[Hit]:
        """The best alignment of each item that the text holds, by item."""
        s, ids = self.settings, self.numbers(text)
        if 0 < len(ids) < s.seed:
            return [Hit(i, s.match * len(ids), 1.0, 0, len(ids) - 1) for i in self.short.get(ids.tobytes(), ())]
        at, run = self.met(ids)
        if not len(at) or not len(self.seeds):
            return []
        low, high = (np.searchsorted(self.seeds[:, 0], run, side=side) for side in ("left", "right"))
        times = high - low
        if not times.any():
            return []
        each = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, diagonal = self.seeds[each, 1], np.repeat(at, times) - self.seeds[each, 2]
        order = np.lexsort((diagonal, item))
        item, diagonal = item[order], diagonal[order]
        best: dict[int, Hit] = {}
        a = 0
        while a < len(item):
            i, query = int(item[a]), self.words[item[a]]
            slack, m = len(query) // 4 + 3, len(query)
            b = a + 1
            while b < len(item) and item[b] == i and diagonal[b] - diagonal[b - 1] <= m + 2 * slack:
                b += 1
            start = max(0, int(diagonal[a]) - slack)
            window = ids[start : int(diagonal[b - 1]) + m + slack]
            a = b
            needed = min(s.share * s.match * m, s.match * s.long_match)
            if s.match * np.isin(window, query).sum() < needed:  # no alignment can reach it
                continue
            score, first, last = align(query, window, s)
            if score >= needed and (i not in best or score > best[i].score):
                best[i] = Hit(i, score, score / (s.match * m), start + first, start + last)
        return list(best.values())


def align(query: np.ndarray, window: np.ndarray, s: Settings) -> tuple[int, int, int]:
    """Smith-Waterman: best local score, and its first and last word in the window."""
    score, last, row = _ends(query, window, s)
    if score <= 0:
        return 0, 0, 0
    _, back, _ = _ends(query[: row + 1][::-1], window[: last + 1][::-1], s)
    return score, last - back, last


def _ends(query: np.ndarray, window: np.ndarray, s: Settings) -> tuple[int, int, int]:
    """Best score and where it is first reached, in the window and the query.

    A row is made at once: with equal gap costs the best way along the row is a
    running maximum of the scores plus what the distance costs.
    """
    along = -s.gap * np.arange(len(window), dtype=np.int64)
    before = np.zeros(len(window) + 1, np.int64)
    best, column, row = 0, 0, 0
    for r, word in enumerate(query):
        now = before[:-1] + np.where(window == word, s.match, s.mismatch)
        np.maximum(now, before[1:] + s.gap, out=now)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + along) - along
        top = int(now.argmax())
        if now[top] > best:
            best, column, row = int(now[top]), top, r
        before[1:] = now
    return best, column, row


def blocks(items: DataFrame, item_id: str, text: str, settings: Settings) -> tuple[int, Callable[[int], list[tuple]]]:
    """How many blocks of about ``block_chars`` there are, and what reads one.

    Rows are dealt by id and text, so an id on very many rows is in many blocks.
    Repeated rows are one; null texts are in none.
    """
    rows = items.select(F.col(item_id).alias("id"), F.col(text).cast("string").alias("body")).filter("body is not null").distinct()
    total = rows.agg(F.sum(F.length("body"))).first()[0] or 0
    n = -(-total // settings.block_chars)
    if n > 1:  # written in the order of the blocks, so that reading one skips the others
        part = F.pmod(F.xxhash64("id", "body"), F.lit(n))
        rows = materialise(rows.withColumn("part", part).repartition("part").sortWithinPartitions("part"), "items")
    return n, lambda k: [(r["id"], r["body"]) for r in (rows.filter(F.col("part") == k) if n > 1 else rows).collect()]


def count_runs(df: DataFrame, text: str, block: Block) -> np.ndarray:
    """How often each run of the block occurs in all texts; summed in each task before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(block.codes), np.int64)
        for batch in batches:
            for value in batch.column(0):
                _, met = block.met(block.numbers(value.as_py()))
                counts += np.bincount(met, minlength=len(counts)) if len(met) else 0
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["run", "n"])

    found = df.select(F.col(text).cast("string")).mapInArrow(run, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
    out = np.zeros(len(block.codes), np.int64)
    sums = found.toArrow()  # 16 bytes for each run of the block, which is bounded
    out[sums["run"].to_numpy()] = sums["n"].to_numpy()
    return out


def contaminated(
    df: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """One row for each document row and item that it holds, with the best alignment.

    ``score`` is the share of the item's own score, ``first_word`` and ``last_word``
    the passage in words of the document. Null and empty texts hold nothing, and
    null and empty items are held by nothing, items shorter than ``seed`` words by documents of just these words. Repeated rows of documents
    are judged each; repeated items count once. Other columns are not looked at.
    """
    docs = df.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("body"))
    kinds = [docs.schema["doc"].dataType, items.schema[item_id].dataType]
    names = [doc_id, item_id if item_id.lower() != doc_id.lower() else f"benchmark_{item_id}"]
    fields = [T.StructField("score", T.DoubleType())] + [T.StructField(c, T.LongType()) for c in ("alignment", "first_word", "last_word")]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)] + fields)
    arrow = pa.schema([("score", pa.float64()), *((c, pa.int64()) for c in ("alignment", "first_word", "last_word"))])
    item_type = to_arrow_type(kinds[1])
    n, read = blocks(items, item_id, item_text, settings)
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    marked = T.StructType([*schema.fields, T.StructField("digest", T.StringType())])

    def hits_of(k: int) -> DataFrame:
        block = Block(read(k), settings)
        block.choose(count_runs(docs, "body", block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                origin, held, hits, digests = [], [], [], []
                for i, value in enumerate(batch.column(1)):
                    best: dict = {}
                    body = value.as_py()
                    for hit in block.find(body):
                        own = block.ids[hit.item]
                        if own not in best or hit.share > best[own][0]:
                            best[own] = (hit.share, hit.score, hit.first_word, hit.last_word)
                    if best:
                        origin += [i] * len(best)
                        held += best
                        hits += best.values()
                        digests += [digest_of(body)] * len(best)
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(origin)),
                            pa.array(held, item_type),
                            *columns_of(hits, arrow),
                            pa.array(digests, pa.string()),
                        ],
                        marked.names,
                    )

        return docs.mapInArrow(run, marked)

    if n == 1:
        return hits_of(0).drop("digest")
    # equal rows have equal hits in a block: one row for each of them is given back
    columns = [F.col(f"`{c}`") for c in names]
    rest = [f.name for f in fields]
    best = F.struct("score", "alignment", (-F.col("first_word")).alias("first"), (-F.col("last_word")).alias("last"))
    each = written(
        n,
        lambda k: hits_of(k).groupBy(*columns, "digest", *rest).agg(F.count("*").alias("n")),
        T.StructType([*schema.fields, T.StructField("digest", T.StringType()), T.StructField("n", T.LongType())]),
        [*names, "digest", *rest, "n"],
        df,
    )
    whole = each.groupBy(*columns, "digest").agg(F.max(best).alias("best"), F.max("n").alias("n"))
    return whole.select(
        *columns,
        F.col("best.score").alias("score"),
        F.col("best.alignment").alias("alignment"),
        (-F.col("best.first")).alias("first_word"),
        (-F.col("best.last")).alias("last_word"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"),
    ).drop("copy")


def digest_of(text: str) -> str:
    """The same as Spark's sha2 of the text."""
    return hashlib.sha256(text.encode()).hexdigest()


def written(n: int, result: Callable[[int], DataFrame], schema: T.StructType, columns: list[str], df: DataFrame) -> DataFrame:
    """The results of all blocks; each is written before the next is begun, into one folder."""
    path = scratch_path(df.sparkSession, "blocks")
    numbered = [f"c{i}" for i in range(len(columns))]  # any name can be written so
    for k in range(n):
        result(k).toDF(*numbered).write.mode("append").parquet(path)
    kinds = {f.name: f.dataType for f in schema.fields}
    read = T.StructType([T.StructField(c, kinds[name]) for c, name in zip(numbered, columns, strict=True)])
    return df.sparkSession.read.schema(read).parquet(path).toDF(*columns)


def drop_contaminated(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """The rows that hold no item, with all their columns.

    With several blocks the digests of the texts that hold an item are written
    block by block, and rows with such a text go at the end.
    """
    n, read = blocks(items, item_id, item_text, settings)
    if not n:
        return df
    if n == 1:
        block = Block(read(0), settings)
        block.choose(count_runs(df, text, block))
        plain = isinstance(df.schema[text].dataType, T.StringType)
        at = df.columns.index(text) if plain else len(df.columns)
        given = df if plain else df.withColumn(fresh(df, "text_in"), F.col(text).cast("string"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not block.find(value.as_py()) for value in batch.column(at)]
                kept = batch.filter(pa.array(clean, pa.bool_()))
                yield kept if plain else kept.select(kept.schema.names[:-1])
                del batch, kept
            pa.default_memory_pool().release_unused()

        return given.mapInArrow(run, df.schema)

    bodies = df.select(F.col(text).cast("string").alias("body"))

    def gone_of(k: int) -> DataFrame:
        block = Block(read(k), settings)
        block.choose(count_runs(bodies, "body", block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t for t in (value.as_py() for value in batch.column(0)) if t and block.find(t)]
                yield pa.RecordBatch.from_arrays([pa.array([*map(digest_of, texts)], pa.string())], ["digest"])

        return bodies.mapInArrow(run, "digest string").distinct()

    name = fresh(df, "digest")
    schema = T.StructType([T.StructField(name, T.StringType())])
    gone = materialise(written(n, gone_of, schema, [name], df).distinct(), "gone")
    own = F.sha2(F.col(text).cast("string").cast("binary"), 256)
    return df.withColumn(name, own).join(gone, name, "left_anti").select(*df.columns)
