"""Block and allow lists over host suffixes and path prefixes.

A url is expanded into the expressions that could be rules: every suffix of its
host at a label, with every prefix of its path that has the length of some rule's
path. Expressions meet the rules on a short prefix of their digest, and the full
digest confirms. The longest rule wins.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the digest that the join uses.
PREFIX = 8


class UrlRule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


#: Fixed values.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def rule_table(spark: SparkSession, rules: Iterable[UrlRule]) -> DataFrame:
    """The rules as rows."""
    rows = [F.struct(*[F.lit(v).alias(c) for c, v in zip(UrlRule._fields, r, strict=True)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_of(url: Column) -> Column:
    """From the first :// to /, ?, # or the end, capital ASCII letters folded; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    df: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """Host, path, the rule that decides and the verdict of each row.

    ``rules`` has the columns verdict, host and path; it may have any size. Where no
    rule fits, `rule` is null and the verdict is ``otherwise``. Of rules that fit the
    one with the longest text wins, of equally long ones that with the longer host,
    and block before allow on the same host and path. A null url and one without
    :// have an empty host and path, which no rule fits. Repeated rows get equal
    rows; rules with a null in them are left out; other columns are not looked at.
    """
    rules = rules.select("verdict", F.lower("host").alias("host"), "path").na.drop().distinct()
    listed = rules.select(
        F.sha2(F.concat("host", "path"), 256).alias("digest"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.length("path").alias("path_length"),
        "verdict",
    )
    # how many characters rule paths have, and how many labels rule hosts: as many rows as there are lengths
    lengths = sorted(r[0] for r in listed.select("path_length").distinct().collect())
    labels = rules.select(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0

    pages = df.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("address"))
    urls = pages.select("address").filter("address is not null").distinct()
    parts = urls.select("address", host_of(F.col("address")).alias("host"), path_of(F.col("address")).alias("path"))
    names = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(names), F.lit(max(1, labels)))),
        lambda n: F.array_join(F.slice(names, -n, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substring("path", F.lit(1), n),
    )
    spread = (
        parts.filter("host <> ''")
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .select("address", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"), F.length("suffix").alias("host_length"))
    )
    short = lambda d: F.substring(d, 1, PREFIX)
    met = (
        spread.withColumn("short", short(F.col("digest")))
        .join(listed.withColumnRenamed("digest", "full").withColumnRenamed("host_length", "cut").withColumn("short", short(F.col("full"))), "short")
        .filter((F.col("digest") == F.col("full")) & (F.col("host_length") == F.col("cut")))
    )
    rank = F.struct(F.length("rule").alias("length"), "cut", (F.col("verdict") == "block").alias("blocks"), "rule", "verdict")
    best = met.groupBy("address").agg(F.max(rank).alias("best")).select("address", "best.rule", "best.verdict")
    return pages.join(best, "address", "left").select(
        F.col("id").alias(page_id),
        host_of(F.col("address")).alias("host"),
        path_of(F.col("address")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(otherwise)).alias("verdict"),
    )
