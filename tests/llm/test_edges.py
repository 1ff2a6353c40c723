"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm.bpe import count_tokens
from cohortlens.llm.decontaminate import contaminated, drop_contaminated
from cohortlens.llm.language import identify_language
from cohortlens.llm.licenses import find_licenses
from cohortlens.llm.merkle import merkle_manifest
from cohortlens.llm.packing import best_fit_packing
from cohortlens.llm.quality import classify_quality
from cohortlens.llm.repetition import keep_by_rules, repetition_rules
from cohortlens.llm.secret_scan import find_secrets, redact_secrets
from cohortlens.llm.simhash import drop_near_duplicates, near_duplicates
from cohortlens.llm.toxicity import classify_toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, "
CLASH = "print long, kept boolean, score double, row long, text_in string, low string, id string, least long, masked string, n long"
PROSE = "the quick brown fox jumps over a lazy dog while seven wizards vex bold gnomes under pale moonlight near old stone walls"
LONG = " ".join(f"word{i} {PROSE.split()[i % 20]}" for i in range(60_000))


def documents(spark):
    texts = {0: "", 1: None, 2: PROSE, 3: PROSE, 4: LONG, 5: 'token = "abcdefgh12345"', 6: " \n\t ", 7: "<|endoftext|>", 9: "é"}
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()]
    rows += [rows[2], rows[2], (None, PROSE, None, None, None), (None, None, None, None, None), (2, LONG + " tail", "en", "s", 1)]
    clash = (1, True, 0.5, 7, "x", "y", "z", 3, "m", 4)
    return spark.createDataFrame([r + clash for r in rows], SCHEMA + CLASH)


def items(spark):
    return spark.createDataFrame(
        [(1, PROSE), (1, PROSE), (2, None), (3, ""), (None, "alpha beta gamma delta epsilon zeta"), (4, "the")], "item_id long, text string"
    )


def labels(spark):
    return spark.createDataFrame([(2, 1, 0), (2, 1, 0), (3, 0, 0), (4, None, 1), (None, 1, 0), (0, 0, 0)], "doc_id long, quality int, toxic int")


PER_ROW = {
    "secrets": lambda d: find_secrets(d),
    "quality": lambda d: classify_quality(d, labels(d.sparkSession)),
    "licenses": lambda d: find_licenses(d),
    "repetition": lambda d: repetition_rules(d),
    "simhash": lambda d: near_duplicates(d),
    "language": lambda d: identify_language(d),
    "tokens": lambda d: count_tokens(d),
    "manifest": lambda d: merkle_manifest(d),
    "toxicity": lambda d: classify_toxicity(d, labels(d.sparkSession)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, name):
    docs = documents(spark)
    got = PER_ROW[name](docs).collect()
    ids = lambda rows: sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
    assert ids(got) == ids(docs.select("doc_id").collect())
    repeated = [tuple(r) for r in got if r["doc_id"] == 2]
    assert len(repeated) == 4 and len(set(map(str, repeated))) <= 2


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](documents(spark).limit(0)).collect() == []


def test_values_of_null_and_empty(spark):
    docs = documents(spark).filter("doc_id in (0, 1)")
    assert {(r.n_assign, r.spans) for r in find_secrets(docs).collect()} == {(0, "")}
    assert {(r.n_words, r.first_word, r.labels, r.score) for r in find_licenses(docs).collect()} == {(0, None, "", 0.0)}
    assert {(r.n_words, r.word_chars, r.base_failed, r.kept) for r in repetition_rules(docs).collect()} == {(0, 0, True, False)}
    assert {(r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()} == {("0" * 16, 0)}
    assert {(r.lang_pred, r.score) for r in identify_language(docs).collect()} == {("und", 0.0)}
    assert {(r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs).collect()} == {(0, 0, False)}
    assert {(r.piece, r.start, r.length) for r in best_fit_packing(docs).collect()} == {(0, 0, 1)}


def test_packing_is_gapless(spark):
    docs = documents(spark)
    rows = best_fit_packing(docs).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r.piece == 0 for r in rows) == docs.count()
    assert best_fit_packing(docs.limit(0)).collect() == []


def test_decontamination(spark):
    docs = documents(spark)
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items(spark)).collect()}
    assert got == {(2, 1), (3, 1), (None, 1)}
    kept = drop_contaminated(docs, items(spark))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("0 1 4 5 6 7 9 None 2".split())
    assert contaminated(docs.limit(0), items(spark)).collect() == []
    assert contaminated(docs, items(spark).limit(0)).collect() == []
    assert drop_contaminated(docs, items(spark).limit(0)).count() == docs.count()


def test_one_row_of_each_component_stays(spark):
    docs = documents(spark)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", F.length("text").alias("n")).collect()
    texts = sorted((r.doc_id, r.n) for r in rows)
    # empty texts are one component (0); the prose (2); the long text (4) with its longer copy under id 2
    assert texts == [(0, 0), (2, len(PROSE)), (2, len(LONG) + 5), (5, 23), (7, 13), (9, 1)]
    assert drop_near_duplicates(docs.limit(0)).collect() == []


def test_only_null_ids(spark):
    docs = documents(spark).filter("doc_id is null and text is not null")
    twice = docs.union(docs)
    assert [r.component_id for r in near_duplicates(twice).collect()] == [None, None]
    assert drop_near_duplicates(twice).count() == 1


def test_stages_keep_columns(spark):
    docs = documents(spark)
    for frame in (keep_by_rules(docs), redact_secrets(docs)):
        assert frame.schema == docs.schema
    assert redact_secrets(docs).count() == docs.count()
    masked = redact_secrets(docs.filter("doc_id = 5")).first()
    assert masked.text == '[SECRET]"' and masked.n_chars == len(masked.text) and masked["masked"] == "m"
    assert redact_secrets(docs.filter("doc_id = 1")).first().text is None


def test_pipeline_on_nothing_and_on_awkward_rows(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == {2} or {r.doc_id for r in rows} == {4}
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    items(spark).write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).collect() == []
