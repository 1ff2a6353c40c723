"""Language identification by compression.

Each language has a zstandard dictionary of raw text. A text is encoded with every
dictionary, and the smallest result names the language. Where the second smallest
is almost as small the row is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import per_text, remainder
from cohortlens.session import materialise


#: ASCII other than small letters becomes a space.
LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


class Settings(NamedTuple):
    """The dictionary of a language is made of at most ``samples`` training texts of it, ``excerpt`` characters of each
    from a place anywhere in it; texts and places are drawn by a hash of their ids. With very many languages the excerpts
    shrink, so that all dictionaries together stay within ``budget`` characters. Scoring reads whole texts."""

    samples: int = 256
    excerpt: int = 1000
    level: int = 6
    narrow: float = 0.01
    budget: int = 16_000_000


def dictionaries(train: DataFrame, doc_id: str, text: str, lang: str, settings: Settings) -> dict[str, bytes]:
    """Raw dictionary of each language that occurs with a text that has a letter, the most frequent language first.

    One text is drawn for each language and hash bucket, in two passes: the
    smallest hash by a partial minimum, then the texts that have it.
    """
    rows = train.select(F.col(lang).cast("string").alias("lang"), F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").alias("body"))
    hashed = (
        rows.filter(F.col("lang").isNotNull() & F.col("body").rlike(r"\p{L}"))
        .withColumn("hash", F.xxhash64("id", F.length("body")))
        .withColumn("bucket", F.pmod("hash", F.lit(settings.samples)))
    )
    drawn = hashed.groupBy("lang", "bucket").agg(F.min("hash").alias("hash"), F.count("*").alias("n"))
    drawn = materialise(drawn, "drawn")
    languages = drawn.select("lang").distinct().count()
    excerpt = max(1, min(settings.excerpt, settings.budget // max(1, settings.samples * languages)))
    start = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.lit(1), F.length("body") - excerpt + 1)).cast("int") + 1
    found = (
        hashed.join(drawn, ["lang", "bucket", "hash"])
        .select("lang", "bucket", "n", F.substr("body", start, F.lit(excerpt)).alias("part"))
        .groupBy("lang", "bucket")
        .agg(F.min("part").alias("part"), F.max("n").alias("n"))
        .groupBy("lang")
        .agg(F.sum("n").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "part"))), lambda p: p["part"]), "\n").alias("raw"))
        .collect()  # a row of bounded size for each language
    )
    return {r["lang"]: letters_of(r["raw"]) for r in sorted(found, key=lambda r: (-r["n"], r["lang"]))}


def letters_of(text: str) -> bytes:
    """The whole text in small letters, with one space for all between them."""
    return b" ".join(text.lower().encode().translate(LETTERS).split())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def classifier(raw: dict[str, bytes], settings: Settings) -> Callable[[str | None], tuple[str, float, bool]]:
    """The function of one text that gives language, score and whether the margin is narrow."""
    coders = []
    for name, content in raw.items():
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=settings.level)
        coders.append(
            (name, zstandard.ZstdCompressor(level=settings.level, dict_data=known, write_content_size=False, write_checksum=False))
        )

    def one(text: str | None) -> tuple[str, float, bool]:
        if not text or not coders or not has_letter(text):
            return "und", 0.0, True
        data = letters_of(text)
        sizes = sorted((len(coder.compress(data)), k) for k, (_, coder) in enumerate(coders))
        first = sizes[0][0]
        margin = (sizes[1][0] - first) / sizes[1][0] if len(sizes) > 1 else 1.0
        weights = [2.0 ** (-80 * (size - first) / first) for size, _ in sizes]
        return coders[sizes[0][1]][0], 1 / sum(weights), margin < settings.narrow

    return one


def identify_language(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()
) -> DataFrame:
    """Language of each document, learned from the rows that are not held out.

    Null texts and texts without a letter get `und` and score 0, and so do all if no
    language could be learned. `rejected` marks these and narrow margins; the
    language is named all the same. Equal sizes go to the language with more training rows. Repeated rows
    get equal rows; other columns are not looked at.
    """
    held = F.coalesce(remainder(doc_id) == 2, F.lit(False))
    raw = dictionaries(df.filter(~held), doc_id, text, lang, settings)
    rows = df.select(F.col(doc_id), held.alias("held_out"), F.col(text).alias("body"))
    return per_text(
        rows, [doc_id, "held_out"], "body", lambda: classifier(raw, settings), "lang_pred string, score double, rejected boolean"
    )
