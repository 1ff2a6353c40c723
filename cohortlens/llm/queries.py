"""The text queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.bpe import count_tokens
from cohortlens.llm.common import table
from cohortlens.llm.decontaminate import contaminated
from cohortlens.llm.language import identify_language
from cohortlens.llm.licenses import find_licenses
from cohortlens.llm.merkle import merkle_manifest
from cohortlens.llm.packing import best_fit_packing
from cohortlens.llm.prefix_trie import conversation_trie
from cohortlens.llm.quality import classify_quality
from cohortlens.llm.repetition import repetition_rules
from cohortlens.llm.secret_scan import find_secrets
from cohortlens.llm.simhash import near_duplicates
from cohortlens.llm.toxicity import classify_toxicity
from cohortlens.llm.urls import RULES, judge_urls, rule_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


@query
def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES["op4_urls"] = f"""
WITH parts AS (
    SELECT row_number() OVER () AS n, page_id,
           coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{CAPITALS}', '{CAPITALS.lower()}'), '') AS host,
           coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
    FROM pages),
rules(verdict, host, path) AS (VALUES {", ".join(str(tuple(r)) for r in RULES)}),
fits AS (
    SELECT n, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
    FROM parts p JOIN rules r
      ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.n = p.n AND f.k = 1
"""


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))


@query
def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


#: crc32 of an id as decimal text, bit by bit.
CRC32 = (
    "xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split({id}::VARCHAR, ''), "
    "lambda c: ascii(c)::BIGINT), lambda crc, b: list_reduce([xor(crc, b)] || [0::BIGINT, 1, 2, 3, 4, 5, 6, 7], "
    "lambda x, k: xor(x >> 1, (x & 1) * 3988292384))))"
)


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id AS c, list({{'role': role, 'text': text}} ORDER BY i) AS s, {CRC32.format(id="conv_id")} % 6 AS h
    FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT a.c, coalesce(b.s, [])[1:a.h] || a.s[a.h + 1:] AS s
    FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 100),
begun AS (
    SELECT c, d, s[1:d]::VARCHAR AS node, CASE WHEN d > 0 THEN s[1:d - 1]::VARCHAR END AS parent,
           CASE WHEN d > 0 THEN length(s[d].text) ELSE 0 END AS chars, d = len(s) AS ends
    FROM rebuilt, unnest(range(0, len(s) + 1)) AS r(d)),
nodes AS (
    SELECT node, d, parent, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS own,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
    FROM begun GROUP BY node, d, parent),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
    SELECT up.node, sum(n.own) AS saved, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
    FROM nodes n LEFT JOIN children k USING (node)
    JOIN begun low ON low.c = n.conv_id AND low.d = n.d
    JOIN begun up ON up.c = n.conv_id AND up.d <= n.d
    GROUP BY up.node)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       b.n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children k ON k.node = n.node JOIN below b ON b.node = n.node
"""


@query
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


def leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')" for x in fields) + ")"


ORACLES["op12_manifest"] = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf_sql("text")} AS leaf,
           CASE WHEN {CRC32.format(id="doc_id")} % 3 = 0
                THEN {leaf_sql(f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')")} END AS struck
    FROM documents),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY tree) AS n
    FROM leaves),
nodes AS (
    SELECT tree, 0 AS lvl, i, leaf AS digest, n FROM numbered
    UNION ALL
    SELECT tree, lvl + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)), (n + 7) // 8
    FROM nodes WHERE n > 1 GROUP BY tree, lvl, i // 8, n),
subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
    SELECT 0 AS lvl, i, digest, n FROM subroots
    UNION ALL
    SELECT lvl + 1, i // 8, sha256(string_agg(digest, '' ORDER BY i)), (n + 7) // 8
    FROM tops WHERE n > 1 GROUP BY lvl, i // 8, n),
beside AS (
    SELECT tree, lvl, i,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY tree, lvl, i // 8 ORDER BY i)),
beside_tops AS (
    SELECT lvl, i,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM tops WHERE n > 1 WINDOW run AS (PARTITION BY lvl, i // 8 ORDER BY i)),
steps AS (
    SELECT d.tree, d.i, b.lvl, b.l, b.r FROM numbered d JOIN beside b ON b.tree = d.tree AND b.i = d.i >> (3 * b.lvl)
    UNION ALL
    SELECT d.tree, d.i, 1000 + b.lvl, b.l, b.r
    FROM numbered d JOIN subroots s ON s.tree = d.tree JOIN beside_tops b ON b.i = s.i >> (3 * b.lvl)),
paths AS (
    SELECT tree, i, list({{'l': l, 'r': r}} ORDER BY lvl) AS path, string_agg(l || r, '' ORDER BY lvl) AS proof
    FROM steps GROUP BY tree, i),
folded AS (
    SELECT d.*, s.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root, coalesce(p.proof, '') AS proof, len(coalesce(p.path, [])) AS n_steps,
           list_reduce([coalesce(struck, leaf)] || coalesce(list_transform(p.path, lambda x: x.l || '|' || x.r), []),
               lambda low, x: sha256(replace(x, '|', low))) AS folded_root
    FROM numbered d JOIN subroots s ON s.tree = d.tree LEFT JOIN paths p ON p.tree = d.tree AND p.i = d.i)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified,
       n_steps::INT AS n_steps FROM folded
"""


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
