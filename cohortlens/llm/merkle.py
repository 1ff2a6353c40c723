"""Merkle manifest of a table: one digest for all rows, and for each row the siblings that prove it.

Every row gets its rank within its tree. The octal digits of the rank say where it
hangs, and the digits are grouped away one after the other: rows that differ in the
last digit only are nested as an array of structs in one node, such nodes in the next.
Three digits are rolled up in one go within a block of 512 ranks, after one shuffle by
block; a block is a bounded row. Block digests are the rows of the next tier.

On the way down each block row unfolds by a transform and an explode per digit; a row's
siblings are its neighbours in the nested array, so rows never meet each other again.
Only blocks, one row for each 512, are joined to the path above them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import ranked
from cohortlens.session import materialise

#: Octal digits of a rank that one block holds.
DIGITS = 3
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_STEPS = "array<struct<left:string,right:string>>"


def leaf_digest(values: list[Column]) -> Column:
    """Of the values in order, each as byte count, colon and text; a null is a dash."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def height_of(rows: Column) -> Column:
    """Levels above ``rows`` leaves: the octal digits of the largest rank; none above a lone leaf."""
    return F.when(rows > 1, F.length(F.conv((rows - 1).cast("string"), 10, 8))).otherwise(0)


def roll_up(nodes: DataFrame, base: int) -> DataFrame:
    """(tree, height, i, digest, kids) of each block of the nodes (tree, height, i, digest, item) at level ``base``.

    A run of eight or fewer becomes the digest of its digests. Above the height of
    its tree a node passes its only child's digest on.
    """
    places = [F.pmod(F.shiftright("i", 3 * k), F.lit(8)).cast("int").alias(f"digit{k}") for k in range(DIGITS)]
    rows = nodes.select("tree", "height", F.shiftright("i", 3 * DIGITS).alias("block"), *places, "digest", "item")
    rows = rows.repartition("tree", "block")
    inner = "item"
    for k in range(DIGITS):
        keys = ["tree", "height", "block", *[f"digit{j}" for j in range(DIGITS - 1, k, -1)]]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"digit{k}").alias("place"), "digest", inner)))
        rows = rows.groupBy(*keys).agg(kids.alias("kids"))
        run = F.sha2(joined(F.transform("kids", lambda kid: kid["digest"])).cast("binary"), 256)
        lone = F.col("kids")[0]["digest"]
        rows = rows.withColumn("digest", F.when(F.col("height") > base + k, run).otherwise(lone))
        inner = "kids"
    return rows.withColumnRenamed("block", "i")


def beside(kid: Column, at: Column, inner: str) -> Column:
    """The child at a place of ``kids`` with the digests left and right of it."""
    digests = lambda start, length: joined(F.transform(F.slice("kids", start, length), lambda other: other["digest"]))
    return F.struct(
        kid["place"].alias("place"),
        kid["digest"].alias("digest"),
        kid[inner].alias(inner),
        digests(F.lit(1), at).alias("left"),
        digests(at + 2, F.lit(8)).alias("right"),
    )


def unfold(blocks: DataFrame, base: int, carried: list[str]) -> DataFrame:
    """(tree, i, digest, item, path, carried) of the nodes in the blocks, whose own ``path`` leads from them to the root.

    A step of the path holds the digests left and right of the node, one text each.
    """
    rows = blocks.select("tree", "height", "i", "path", "kids", *carried)
    for k in range(DIGITS - 1, -1, -1):
        inner = "kids" if k else "item"
        kids = F.transform("kids", lambda kid, at: beside(kid, at, inner))  # noqa: B023  (called at once)
        rows = rows.select("tree", "height", "i", "path", *carried, F.explode(kids).alias("kid"))
        step = F.array(F.struct(F.col("kid.left").alias("left"), F.col("kid.right").alias("right")))
        rows = rows.select(
            "tree",
            "height",
            (F.shiftleft("i", 3) + F.col("kid.place")).alias("i"),
            F.when(F.col("height") > base + k, F.concat(step, "path")).otherwise(F.col("path")).alias("path"),
            *carried,
            F.col("kid.digest").alias("digest"),
            F.col(f"kid.{inner}").alias(inner),
        )
    return rows


def tiers_of(nodes: DataFrame, top: int) -> list[DataFrame]:
    """Written blocks, tier by tier, until each tree is one block; ``top`` is the largest height."""
    tiers = [materialise(roll_up(nodes, 0), "blocks")]
    while DIGITS * len(tiers) < top:
        above = tiers[-1].select("tree", "height", "i", "digest", F.lit(None).cast("int").alias("item"))
        tiers.append(materialise(roll_up(above, DIGITS * len(tiers)), "blocks"))
    return tiers


def proven(tiers: list[DataFrame], roots: DataFrame, carried: list[str]) -> DataFrame:
    """Every leaf with its path, from the path and the carried columns of each tree's root in ``roots``."""
    at = tiers[-1].join(roots, "tree")
    for level in range(len(tiers) - 1, 0, -1):
        down = unfold(at, DIGITS * level, carried).select("tree", "i", "path", *carried)
        at = tiers[level - 1].join(down, ["tree", "i"])
    return unfold(at, 0, carried)


def merkle_manifest(
    docs: DataFrame,
    doc_id: str = "doc_id",
    lang: str = "lang",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    text: str = "text",
    divisor: int = 3,
) -> DataFrame:
    """Leaf, subroot of its language, root, digest of its proof, and the root folded from a tampered or true leaf.

    Where ``divisor`` divides the id's crc32, the leaf is tampered with: A-Z of its text in lower case. `n_steps`
    is the length of the proof. Nulls are values of their own: a null id comes first and is never tampered with, a null
    language is a tree of its own and the first one. Rows of one id are ordered by leaf; equal rows are leaves of their
    own. An empty table has no rows. Columns that are no field are not looked at.
    """
    named = [F.col(c) for c in fields]
    lower = [F.translate(F.col(c), CAPITALS, CAPITALS.lower()) if c == text else F.col(c) for c in fields]
    struck = F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor == 0
    tree = F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"),
        F.col(doc_id).alias("id"),
        leaf_digest(named).alias("digest"),
        F.when(struck, leaf_digest(lower)).alias("struck"),
    )
    top = docs.groupBy(tree.alias("tree")).agg(F.count("*").alias("n")).agg(F.max(height_of(F.col("n")))).first()[0] or 0
    nodes = ranked(leaves, ["tree"], ["id", "digest"])
    item = F.struct("id", "struck").alias("item")
    tiers = tiers_of(nodes.select("tree", height_of(F.col("n")).alias("height"), "i", "digest", item), top)

    subroots = ranked(tiers[-1].select("tree", "digest"), [], ["tree"])
    whole = F.lit("").alias("tree")
    nodes = materialise(
        subroots.select(whole, height_of(F.col("n")).alias("height"), "i", "digest", F.col("tree").alias("item")), "subroots"
    )
    above = tiers_of(nodes, nodes.agg(F.max("height")).first()[0] or 0)
    summit = above[-1].select("tree", F.col("digest").alias("root"), F.array().cast(NO_STEPS).alias("path"))
    roots = proven(above, summit, ["root"]).select(F.col("item").alias("tree"), "path", F.col("digest").alias("subroot"), "root")

    found = proven(tiers, materialise(roots, "roots"), ["subroot", "root"])
    start = F.coalesce("item.struck", "digest")
    climbed = F.aggregate("path", start, lambda low, step: F.sha2(F.concat(step["left"], low, step["right"]).cast("binary"), 256))
    siblings = joined(F.transform("path", lambda step: F.concat(step["left"], step["right"])))
    out = found.select(
        F.col("item.id").alias(doc_id),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        climbed.alias("folded_root"),
        F.size("path").alias("n_steps"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
