"""The pipeline against the same stages in plain Python."""

import os

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from cohortlens.llm.decontaminate import Block, Settings
from cohortlens.llm.repetition import Rules, broken, measure
from cohortlens.llm.secret_scan import redacted
from cohortlens.llm.simhash import THRESHOLD, fingerprint

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_stages(spark, tmp_path):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    rules = Rules()
    kept = {d: t for d, t in docs.items() if not broken(measure(t, tuple(n for n, _ in rules.runs)), rules)}
    wanted = [kept]

    prints = {d: fingerprint(t) for d, t in kept.items()}
    group = {d: d for d in kept}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= THRESHOLD and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    kept = {d: t for d, t in kept.items() if group[d] == d}
    wanted.append(kept)
    kept = {d: t for d, t in kept.items() if not Block(items, Settings()).find(t)}
    wanted.append(kept)
    kept = {d: redacted(t) for d, t in kept.items()}
    wanted.append(kept)

    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = frame.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted):
        stage(spark, frame, SMALL).write.parquet(f"{tmp_path}/{name}")
        frame = spark.read.parquet(f"{tmp_path}/{name}")
        assert frame.columns == columns
        assert {r.doc_id: r.text for r in frame.collect()} == want, name
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, SMALL)
    assert {r.doc_id for r in packed.collect()} == set(kept)
    assert len(wanted[0]) > len(wanted[1]) > len(wanted[2]) > 0
