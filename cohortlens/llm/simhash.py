"""Near duplicates by 64-bit fingerprints, found through the words of a covering code.

Two fingerprints that differ in at most 4 bits differ in at most 2 bits in one
of their 32-bit halves. In each half, 31 bits are looked at as words around the
code words of the Hamming code of length 31, the anchors. Every word of 31 bits is
within 1 bit of an anchor (the covering radius). Between two halves that differ
in 2 bits lies a word within 1 bit of both (half the threshold), so both are
within 2 bits of the anchor nearest to that word. A half is therefore copied to
every anchor within covering radius plus half the threshold, 16 at most, and
fingerprints are compared where they share an anchor. No link is missed.

Only distinct fingerprints take part. Of the links at an anchor those of a
spanning forest are given on, so a group of n near copies gives n - 1 rows.
Anchors with very many fingerprints are dealt in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import fresh, per_text
from cohortlens.llm.components import components
from cohortlens.session import materialise

THRESHOLD = 4
#: Fingerprints compared in one piece at an anchor; larger anchors are dealt in pairs of such blocks.
BLOCK = 2048


def _masks() -> np.ndarray:
    """Row s: the differences to all anchors within 2 bits of a word with syndrome s (row 0: the word itself)."""
    bit = lambda i: 1 << (i - 1)
    out = np.zeros((32, 16), np.int64)
    for s in range(1, 32):
        pairs = [bit(i) | bit(i ^ s) for i in range(1, 32) if i < (i ^ s)]
        out[s] = [bit(s), *pairs]
    return out


MASKS = _masks()
POSITION_BITS = np.array([sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1) for k in range(5)], np.uint64)


def fingerprint(text: str | None) -> int:
    """SimHash over 4-word runs, repeats included; 0 without words. Null is the empty text."""
    words = (text or "").encode().lower().split()  # ASCII letters and ASCII white space only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if n <= 4:
        hashes = np.array([hashed(joined, 42)], np.uint64)
    else:
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], stops[:-1] + 1))
        hashes = np.fromiter(
            (hashed(joined[a:b], 42) for a, b in zip(starts[: n - 3].tolist(), stops[3:].tolist(), strict=True)),
            np.uint64,
            n - 3,
        )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(df: DataFrame, keep: list[str], text: str, name: str) -> DataFrame:
    """The columns ``keep`` and the fingerprint of the text as a signed long."""
    return per_text(df, keep, text, lambda: lambda v: (_signed(fingerprint(v)),), f"{name} long")


def syndromes(half: np.ndarray) -> np.ndarray:
    """XOR of the positions (1 to 31) of the set bits."""
    out = np.zeros(len(half), np.int64)
    for k, mask in enumerate(POSITION_BITS):
        out |= (np.bitwise_count(half & mask).astype(np.int64) & 1) << k
    return out


def _to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for side in (0, 1):
            half = (prints.view(np.uint64) >> np.uint64(32 * side)) & np.uint64(0x7FFFFFFF)
            sign = syndromes(half)
            for words, masks in ((sign == 0, MASKS[:, :1]), (sign > 0, MASKS)):
                if not words.any():
                    continue
                moved = half[words].astype(np.int64)[:, None] ^ masks[sign[words]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(moved.ravel() | side << 31), pa.array(np.repeat(prints[words], moved.shape[1]))],
                    ["anchor", "print"],
                )


def _forest(prints: np.ndarray, first: int, links: list[tuple[int, int]]) -> None:
    """Adds links that join what is within the threshold.

    With ``first`` over 0 the rows are two blocks, and only the rows before it are
    compared with those from it on.
    """
    bits = prints.view(np.uint64)
    group = np.arange(len(bits))
    for i in range(first or len(bits) - 1):
        start = first or i + 1
        near = start + np.flatnonzero(np.bitwise_count(bits[start:] ^ bits[i]) <= THRESHOLD)
        near = near[group[near] != group[i]]
        if not len(near):
            continue
        labels, at = np.unique(group[near], return_index=True)
        links += [(int(prints[i]), int(prints[near[k]])) for k in at]
        group[np.isin(group, labels)] = group[i]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor, blocks and side; an anchor may go on in the next batch."""
    rest: np.ndarray | None = None

    def links_of(rows: np.ndarray) -> pa.RecordBatch:
        key, prints = rows[:, :3], np.ascontiguousarray(rows[:, 4])
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        starts, sizes = np.concatenate(([0], cuts)), np.diff(np.concatenate(([0], cuts, [len(rows)])))
        across = rows[starts, 1] != rows[starts, 2]
        pairs = starts[(sizes == 2) & ~across]  # most anchors that are shared at all
        pairs = pairs[np.bitwise_count(prints[pairs].view(np.uint64) ^ prints[pairs + 1].view(np.uint64)) <= THRESHOLD]
        found = list(zip(prints[pairs].tolist(), prints[pairs + 1].tolist(), strict=True))
        many = (sizes > 2) | (sizes == 2) & across
        for a, n, two in zip(starts[many].tolist(), sizes[many].tolist(), across[many].tolist(), strict=True):
            first = int((rows[a : a + n, 3] == 0).sum()) if two else 0
            if not two or 0 < first < n:
                _forest(prints[a : a + n], first, found)
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        rows = rows if rest is None else np.concatenate((rest, rows))
        other = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
        if len(other):
            yield links_of(rows[: other[-1] + 1])
        rest = rows[other[-1] + 1 :] if len(other) else rows
    if rest is not None and len(rest):
        yield links_of(rest)


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of distinct values of ``print`` that join everything within the threshold of each other.

    An anchor with more than ``block`` fingerprints is cut by hash into about
    n / block blocks, and each pair of blocks is a group of its own, so no task
    holds more than some two blocks of one anchor, and every pair meets.
    """
    spread = prints.mapInArrow(_to_anchors, "anchor long, print long")
    large = materialise(
        spread.groupBy("anchor")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > block)
        .select("anchor", F.ceil(F.col("n") / block).cast("long").alias("blocks")),
        "large_anchors",
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("print"), F.col("blocks"))
    dealt = (
        spread.join(large, "anchor", "left")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "anchor",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).cast("long").alias("side"),
            "print",
        )
    )
    keys = ["anchor", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(_compare, "a long, b long").distinct()


def _with_representative(named: DataFrame, least: F.Column) -> DataFrame:
    """(print, least) for each distinct ``print``: the minimum of ``least`` over all rows of its component."""
    own = materialise(named.groupBy("print").agg(F.min(least).alias("own")), "classes")
    roots = components(links(own.select("print")), "links").withColumnRenamed("node", "print")
    linked = roots.join(own, "print")
    best = materialise(linked.groupBy("root").agg(F.min("own").alias("least")), "components")
    moved = roots.join(best, "root").select("print", "least")
    return materialise(
        own.join(moved, "print", "left").select("print", F.coalesce("least", "own").alias("least")), "labels"
    )


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row; component_id is the smallest id reachable over links.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows get equal rows. A null id is never the smallest; a component
    with no other has a null component_id. Other columns are not looked at.
    """
    named = materialise(
        fingerprints(df.select(F.col(doc_id).alias("id"), F.col(text).alias("body")), ["id"], "body", "print"),
        "fingerprints",
    )
    labels = _with_representative(named, F.col("id"))
    return named.join(labels, "print").select(
        F.col("id").alias(doc_id),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component stays, with all its columns: that of the smallest id.

    If rows of that id are repeated with the same fingerprint, one of them stays;
    if all ids of a component are null, one of its rows. Ids that stand on several
    rows, and null ids, are told apart by fingerprint; all others by the id alone,
    so texts are not hashed again for them.
    """
    named = materialise(
        fingerprints(df.select(F.col(doc_id).alias("id"), F.col(text).alias("body")), ["id"], "body", "print"),
        "fingerprints",
    )
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "print")
    labels = _with_representative(named, order)
    judged = named.join(labels, "print").select(
        "id", "print", (F.col("least.id").eqNullSafe(F.col("id")) & (F.col("least.print") == F.col("print"))).alias("first")
    )
    ids = materialise(judged.groupBy("id").agg(F.count("*").alias("n"), F.max("first").alias("first")), "ids")
    several = ids.filter((F.col("n") > 1) & F.col("id").isNotNull()).select(F.col("id").alias(doc_id))
    gone = ids.filter((F.col("n") > 1) | ~F.col("first")).filter("id is not null").select(F.col("id").alias(doc_id))
    single = df.filter(F.col(doc_id).isNotNull()).join(materialise(gone, "gone"), doc_id, "left_anti")

    value = fresh(df, "print")
    doubtful = df.filter(F.col(doc_id).isNull()).unionByName(df.join(materialise(several, "several"), doc_id, "left_semi"))
    firsts = labels.select(F.col("least.id").alias("first_id"), F.col("least.print").alias("first_print")).distinct()
    hashed = fingerprints(doubtful, df.columns, text, value)
    repeated = (
        hashed.join(
            firsts, F.col(doc_id).eqNullSafe(F.col("first_id")) & (F.col(value) == F.col("first_print")), "left_semi"
        )
        .dropDuplicates([doc_id, value])
        .select(*df.columns)
    )
    return single.select(*df.columns).unionByName(repeated)
