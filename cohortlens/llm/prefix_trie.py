"""Prefix trie of conversations: how many share each beginning, and what sharing it would save.

A conversation is collapsed to one key before any prefix is made. The key adds up a
digest of each turn together with its place, so it needs no order and no list of turns:
rows of a conversation are summed wherever they are. Conversations of one key are one
sequence with a weight. Only the turns of one conversation for each sequence are then
unrolled to prefixes, by running totals of the same digests.

A sequence that is a proper prefix of another is found by an anti-join; what remains are
the leaves. Weights, leaves and savings are summed over equal prefixes. Each node's own
saving is booked once, on the sequence of its smallest member, and carried up by running
totals from the end, so a path is never paired with its own prefixes.

Texts are digested where they are read and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.evaluation.running import running_totals
from cohortlens.llm.common import ranked
from cohortlens.session import materialise

#: Largest number of turns that a conversation takes from the first one of its hundred, plus one; and that hundred.
BORROWED, FAMILY = 6, 100
#: A key is made of so many sums of 32 bits each; sums of up to 2^31 turns fit a long.
LANES = 8
#: Characters of the list of ids that are joined before they are hashed in order.
CHUNK = 1 << 16
NOBODY = hashlib.sha256(b"").hexdigest()


def body_digest(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def lanes_of(place: Column, body: Column) -> list[Column]:
    whole = F.sha2(F.concat(place.cast("string"), F.lit(":"), body).cast("binary"), 256)
    return [F.conv(F.substring(whole, 8 * k + 1, 8), 16, 10).cast("long").alias(f"lane{k}") for k in range(LANES)]


def key_of(sums: list[Column]) -> Column:
    return F.md5(F.concat_ws(",", *sums).cast("binary"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, place, body, chars) of the rebuilt conversations, and (conv) of all of them, also those left without turns."""
    own = materialise(ranked(turns, ["conv"], ["turn", "body"]).select("conv", "i", "n", "body", "chars"), "turns")
    heads = (
        own.filter((F.col("i") < BORROWED - 1) & (F.col("conv") % FAMILY == 0))
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("i", "body", "chars"))).alias("head"))
        .withColumnRenamed("conv", "family")
    )
    asked = (F.crc32(F.col("conv").cast("string").cast("binary")) % BORROWED).cast("int")
    convs = own.filter("i = 0").select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("family"), asked.alias("asked"))
    convs = convs.join(heads, "family", "left")
    convs = convs.select("conv", "asked", F.when(F.col("head").isNotNull(), F.slice("head", 1, F.col("asked"))).alias("head"))
    convs = materialise(convs.withColumn("taken", F.coalesce(F.size("head"), F.lit(0))), "conversations")
    kept = (
        own.join(convs.select("conv", "asked", "taken"), "conv")
        .filter(F.col("i") >= F.col("asked"))
        .select("conv", (F.col("i") - F.col("asked") + F.col("taken") + 1).alias("place"), "body", "chars")
    )
    lent = convs.select("conv", F.explode("head").alias("turn")).select(
        "conv", (F.col("turn.i") + 1).alias("place"), "turn.body", "turn.chars"
    )
    return materialise(lent.unionByName(kept), "rebuilt"), convs.select("conv")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and id; one row for each key and some 64 KB of its joined ids."""
    key, first, ids, size = None, None, [], 0
    out: list[tuple] = []
    flush = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)],
        ["key", "first", "ids"],
    )
    for batch in batches:
        for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key or size > CHUNK:
                if ids:
                    out.append((key, first, ",".join(ids)))
                key, first, ids, size = k, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if out:
            yield flush()
            out.clear()
    if ids:
        out.append((key, first, ",".join(ids)))
        yield flush()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks come sorted by key and first id; one digest for each key, fed chunk by chunk."""
    key, state = None, None
    for batch in batches:
        keys, digests = [], []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(digests)], ["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def ends_of(convs: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids of each key in ascending order, comma-joined.

    Ids are sorted and joined in ranges, so a key with very many is spread over tasks. A digest must see its bytes in
    order, so the joined pieces of a key pass through one task, one piece in memory at a time.
    """
    pieces = convs.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    pieces = pieces.mapInArrow(_chunks, "key string, first long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key string, ends_sha256 string")


def conversation_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each node: a distinct beginning of rebuilt conversations, the empty one included.

    A null turn is ordered first, null roles and texts are empty. Turns that tie are ordered by the digest of role
    and text; repeated rows are turns of their own. Rows without a conversation id belong to none and are left out. A
    conversation left without turns ends at the root; a negative id belongs to the hundred nearer to zero. An empty table has no nodes. Other columns are not looked at.
    `conv_id` is a node's smallest member; `n_leaves` and `saved_tokens` cover its subtree.
    """
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        body_digest(F.col(role), F.col(text)).alias("body"),
        F.coalesce(F.char_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("chars"),
    )
    rows, convs = rebuilt_turns(turns)
    lanes = [f"lane{k}" for k in range(LANES)]
    rows = rows.select("conv", "place", "chars", *lanes_of(F.col("place"), F.col("body")))
    nothing = F.lit(0).cast("long")

    summed = rows.groupBy("conv").agg(F.count("*").alias("length"), *[F.sum(x).alias(x) for x in lanes])
    ended = convs.join(summed, "conv", "left").select(
        "conv", F.coalesce("length", nothing).alias("length"), key_of([F.coalesce(x, nothing) for x in lanes]).alias("key")
    )
    ended = materialise(ended, "ended")
    sequences = ended.groupBy("key").agg(F.min("conv").alias("conv"), F.count("*").alias("weight"), F.first("length").alias("length"))
    sequences = materialise(sequences, "sequences")

    chosen = rows.join(sequences.select("conv"), "conv", "left_semi")
    unrolled = running_totals(chosen, ["conv"], "place", lanes, descending=False, keep=["chars"]).select(
        "conv",
        F.col("place").alias("depth"),
        "chars",
        key_of([F.col(f"cum_{x}") for x in lanes]).alias("node"),
        key_of([F.col(f"cum_{x}") - F.col(x) for x in lanes]).alias("parent"),
    )
    paths = materialise(unrolled, "paths")

    proper = paths.select(F.col("parent").alias("key")).distinct()
    leaves = sequences.join(proper, "key", "left_anti").select("conv", nothing.alias("none"))
    weighted = materialise(
        sequences.join(leaves, "conv", "left").select("conv", "key", "weight", F.col("none").isNotNull().cast("long").alias("leaf")),
        "weighted",
    )
    begun = [F.min("conv").alias("conv"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves")]
    nodes = paths.join(weighted, "conv").groupBy("node", "parent", "depth").agg(*begun, F.max("chars").alias("chars"))
    root = (
        weighted.groupBy()
        .agg(*begun)
        .filter("n_convs is not null")
        .select(
            key_of([nothing] * LANES).alias("node"), F.lit(None).cast("string").alias("parent"), nothing.alias("depth"),
            "conv", "n_convs", "n_leaves", nothing.alias("chars"),
        )
    )
    nodes = materialise(nodes.unionByName(root), "nodes")

    own = nodes.select("conv", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    booked = paths.join(own, ["conv", "depth"], "left").select("conv", "depth", F.coalesce("saved", nothing).alias("saved"), "node")
    above = running_totals(booked, ["conv"], "depth", ["saved"], keep=["node"]).select("node", "conv", "depth", "cum_saved", "all_saved")
    saved = above.groupBy("node").agg(F.sum("cum_saved").alias("saved_tokens"))
    at_root = above.filter("depth = 1").agg(F.sum("all_saved").alias("saved_tokens"))
    saved = saved.unionByName(at_root.select(key_of([nothing] * LANES).alias("node"), "saved_tokens"))

    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    return (
        nodes.join(parents, "parent", "left")
        .join(children, "node", "left")
        .join(saved, "node", "left")
        .join(ends_of(ended).withColumnRenamed("key", "node"), "node", "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", nothing).alias("n_children"),
            "n_leaves",
            F.coalesce("saved_tokens", nothing).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"),
        )
    )
