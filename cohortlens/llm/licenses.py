"""License detection by ordered signature rules, in Spark's own functions only.

A text becomes its words with one space between them. Keywords decide which rules
are tried at all. A rule marks its places in the text, and the marks give each
detection its first and last word. A detection that lies inside one of a stronger
or equal priority is suppressed; this is one pass over the detections of a document
in the order of their starts, with a running maximum of ends per priority.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.license_rules import Rule, rules

#: What stands between words. Fixed value (capital letters are folded after).
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OPEN, CLOSE = "\x01", "\x02"
PRIORITIES = (1, 2, 3, 4, 5)


def _places(low: Column, pattern: Column) -> Column:
    """(first, last) word numbers of every match of the pattern."""
    marked = F.regexp_replace(low, F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )")), F.lit(f"{OPEN} $0 {CLOSE}"))
    words = F.split(F.trim(marked), " ")

    def at(mark: str) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(w == mark, i)), lambda i: i.isNotNull())

    # a start has two marks before it for each earlier match, an end one more
    starts = F.transform(at(OPEN), lambda i, k: (i - 2 * k).cast("long"))
    ends = F.transform(at(CLOSE), lambda i, k: (i - 2 * k - 2).cast("long"))
    return F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda s: F.struct(s["a"].alias("first"), s["b"].alias("last")))


def keys(rule: Rule) -> list[str]:
    """The keywords of which every match holds one, as they stand among the words."""
    return [f" {k}" for k in rule.keyword.split("|")]


def find_licenses(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", signatures: list[Rule] | None = None
) -> DataFrame:
    """Words, base phrases, labels and a score of each document; one row for each row.

    The labels are those of the base phrases, which are never suppressed, and of
    the detections that are not suppressed; the score is the largest weight among
    them, 0 without any. Null and empty texts have no words; repeated rows are
    judged each; other columns are not looked at.
    """
    signatures = rules() if signatures is None else signatures
    table = F.array(
        *[
            F.struct(
                F.lit(r.priority).alias("priority"),
                F.lit(order).alias("order"),
                F.lit(r.label).alias("label"),
                F.lit(r.weight).alias("weight"),
                F.lit(r.base).alias("base"),
                F.array(*[F.lit(k) for k in keys(r)]).alias("keywords"),
                F.lit(f" {r.also}").alias("also"),
                F.lit(r.pattern).alias("pattern"),
            )
            for order, r in enumerate(signatures)
        ]
    )
    second = sorted({f" {r.also}" for r in signatures if r.also})
    free = sorted({k for r in signatures if not r.also for k in keys(r)} | set(second))
    bound = sorted({k for r in signatures if r.also for k in keys(r)} - set(free))

    words = df.select(
        F.col(doc_id).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.trim(F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), BETWEEN, " ")).alias("words"),
    )
    gated = words.select(
        "id",
        "row",
        F.when(F.col("words") == "", 0)
        .otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "))) + 1)
        .cast("long")
        .alias("n_words"),
        F.concat(F.lit(" "), "words", F.lit(" ")).alias("words"),
    ).withColumn("low", F.translate("words", string.ascii_uppercase, string.ascii_lowercase))

    def present(keys: list[str]) -> Column:
        return F.array_compact(F.array(*[F.when(F.contains("low", F.lit(k)), F.lit(k)) for k in keys]))

    # keywords that only count beside a second one are looked for where one of those is
    gated = gated.withColumn("hits", present(free))
    if bound:
        some = F.arrays_overlap("hits", F.array(*[F.lit(k) for k in second]))
        gated = gated.withColumn("hits", F.when(some, F.concat("hits", present(bound))).otherwise(F.col("hits")))
    found = gated.select(
        "id",
        "row",
        "n_words",
        F.when(
            F.size("hits") > 0,
            F.flatten(
                F.transform(
                    F.filter(
                        table,
                        lambda r: F.arrays_overlap("hits", r["keywords"])
                        & ((r["also"] == " ") | F.array_contains("hits", r["also"])),
                    ),
                    lambda r: F.transform(
                        _places(F.col("low"), r["pattern"]),
                        lambda p: F.struct(
                            p["first"].alias("first"),
                            p["last"].alias("last"),
                            r["priority"].alias("priority"),
                            r["order"].alias("order"),
                            r["label"].alias("label"),
                            r["weight"].alias("weight"),
                            r["base"].alias("base"),
                        ),
                    ),
                )
            ),
        ).alias("found"),
    )
    each = found.select("id", "row", "n_words", F.inline_outer("found"))
    # earlier in this order: whatever can contain a row
    before = (
        Window.partitionBy("row")
        .orderBy("first", F.desc("last"), "priority", "order")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = [F.max(F.when(F.col("priority") <= p, F.col("last"))).over(before) for p in PRIORITIES]
    covered = F.lit(False)
    for p, end in zip(PRIORITIES, reach, strict=True):
        covered = F.when(F.col("priority") == p, F.coalesce(end >= F.col("last"), F.lit(False))).otherwise(covered)
    judged = each.withColumn("stays", F.col("base") | ~covered)
    names = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(F.when(c, F.col("label")))))
    return judged.groupBy("row").agg(
        F.first("id").alias(doc_id),
        F.first("n_words").alias("n_words"),
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        names(F.col("base")).alias("base_labels"),
        names(F.col("stays")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("stays"), F.col("weight"))), F.lit(0.0)).alias("score"),
        F.count_if(F.col("first").isNotNull() & ~F.col("stays")).alias("n_suppressed"),
    ).drop("row")
