"""Prefix trie, manifest and toxic spans against plain versions of themselves."""

import hashlib
import itertools
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from cohortlens.llm import toxicity
from cohortlens.llm.merkle import merkle_manifest
from cohortlens.llm.prefix_trie import conversation_trie
from cohortlens.llm.queries import ORACLES
from cohortlens.llm.toxicity import Field, Settings, classify_toxicity, learn

TURNS = "conv_id long, turn long, role string, text string, key string, node string"


def plain_trie(turns):
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + mine[h:])
    nodes = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    out = set()
    for node, members in nodes.items():
        under = [n for n in nodes if n[: len(node)] == node]
        childless = [n for n in under if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in nodes)]
        ends = ",".join(map(str, sorted(c for c in members if rebuilt[c] == node)))
        out.add((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
            sum(len(n) == len(node) + 1 for n in under), len(childless),
            sum((len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0) for n in under), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def random_turns(seed):
    rng = random.Random(seed)
    out = []
    for conv in rng.sample(range(350), 60) + [100, 0]:
        for turn in range(rng.randrange(1, 9)):
            place = None if rng.random() < 0.05 and turn == 0 else turn
            out.append((conv, place, rng.choice(["user", "user", None, "é"]), rng.choice(["", "a", "bb", None, "ü" * 5])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_plain(spark, seed):
    turns = random_turns(seed) + [(7, 1, "user", "x"), (7, 1, "user", "x"), (None, 1, "user", "lost"), (-5, 3, "user", "y")]
    turns += [(c, t, "user", "same") for c in range(400, 440) for t in range(7)]
    df = spark.createDataFrame([(*t, "k", "n") for t in turns], TURNS)
    got = conversation_trie(df)
    assert {tuple(r) for r in got.collect()} == plain_trie(turns)
    assert got.count() == len(plain_trie(turns))


def test_trie_of_nothing_and_of_a_long_conversation(spark):
    assert conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    long = spark.createDataFrame([(5, t, "user", str(t % 3), "", "") for t in range(3000)], TURNS)
    rows = {r.depth: r for r in conversation_trie(long).collect()}
    h = zlib.crc32(b"5") % 6
    assert len(rows) == 3001 - h and rows[0].n_leaves == 1 and rows[max(rows)].n_children == 0 and rows[0].saved_tokens == 0


def test_ends_of_a_node_with_very_many(spark):
    """The list of ids goes over several pieces."""
    n = 20_000
    df = spark.range(n).selectExpr("id * 100 AS conv_id", "0L AS turn", "'user' AS role", "'x' AS text")
    rows = conversation_trie(df).collect()
    ids = ",".join(str(100 * i) for i in range(n))
    assert {(r.depth, r.n_convs, r.ends_sha256) for r in rows} == {
        (0, n, hashlib.sha256(b"").hexdigest()), (1, n, hashlib.sha256(ids.encode()).hexdigest())
    }


DOCS = "doc_id long, source string, lang string, n_chars long, text string, path string, item string, root string"


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, "de": 9, None: 2}, {"en": 700, "": 64, "é": 65, "x": 1}, {str(k): 1 + k % 3 for k in range(70)}])
def test_manifest_against_sql(spark, sizes):
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["s", None]), lang, rng.choice([None, 5]), rng.choice(["Abc Déf", "abc", None, ""]), "p", "i", "r")
        for i, lang in enumerate(key for key, n in sizes.items() for _ in range(n))
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCS)
    got = merkle_manifest(df)
    duck = duckdb.connect()
    documents = df.drop("path", "item", "root").toPandas().astype({"n_chars": "Int64"})  # noqa: F841
    duck.execute("CREATE TABLE documents AS SELECT * FROM documents")
    want = duck.execute(ORACLES["op12_manifest"])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
    changed = {r.doc_id for r in got.filter("not verified").collect()}
    assert changed == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] in ("Abc Déf",)}


def test_manifest_of_repeated_rows(spark):
    row = (None, None, None, None, None, "", "", "")
    got = merkle_manifest(spark.createDataFrame([row] * 600 + [(1, "s", "en", 1, "A", "", "", "")], DOCS)).collect()
    assert len(got) == 601 and all(r.folded_root == r.root for r in got if r.doc_id is None)
    assert sorted({r.n_steps for r in got}) == [1, 5]  # four levels of 600 rows, and that of the two languages


def every(evidence, moves):
    """Weight of every sequence of states."""
    weights = {}
    for states in itertools.product((0, 1), repeat=len(evidence)):
        w = sum(e for e, s in zip(evidence, states) if s)
        w += sum({(0, 0): 0, (0, 1): moves[0], (1, 0): moves[1], (1, 1): moves[2]}[p] for p in zip(states, states[1:]))
        weights[states] = np.exp(w)
    return weights


def test_marginals_against_all_sequences():
    rng = np.random.default_rng(5)
    for n in range(1, 8):
        evidence, moves = rng.normal(0, 2, n), rng.normal(0, 2, 3)
        forward, backward = toxicity.chain(evidence.tolist(), moves)
        weights = every(evidence, moves)
        total = sum(weights.values())
        want = [sum(w for s, w in weights.items() if s[k]) / total for k in range(n)]
        assert np.allclose(1 / (1 + np.exp(-(forward + backward))), want)


def test_likelihood_and_gradient():
    rng = np.random.default_rng(6)
    field = Field(rng.normal(0, 1, 50), rng.normal(0, 1, 3))
    found, marks = rng.integers(1, 50, (6, toxicity.WIDTH)), np.array([0, 1, 1, 0, 0, 1.0])
    value, slope = toxicity.loss(field, found, marks)
    weights = every(field.weights[0] + field.weights[found].sum(axis=1), field.moves)
    assert np.isclose(value, -np.log(weights[tuple(map(int, marks))] / sum(weights.values())))
    x = np.concatenate(field)
    for k in [0, 50, 51, 52, *set(found.ravel().tolist())]:
        step = np.eye(53)[k] * 1e-5
        ends = [toxicity.loss(Field((x + s)[:50], (x + s)[50:]), found, marks)[0] for s in (step, -step)]
        assert np.isclose((ends[0] - ends[1]) / 2e-5, slope[k], atol=1e-4)


def test_quasi_newton_on_a_bowl():
    pull = np.array([1.0, 30.0, 500.0])
    found = toxicity.minimised(np.ones(3), lambda x: (float(pull @ (x - 2) ** 2), 2 * pull * (x - 2)), 60)
    assert np.allclose(found, 2, atol=1e-2)


def planted(spark, n=600):
    rng = random.Random(9)
    plain = [a + b for a in "ba ti so ren mol".split() for b in "lo na der sti ka".split()]
    rude = ["grumpox", "zwirtling", "flebbo", "flebbaz", "flebbir"]
    docs, labels = [], []
    for i in range(n):
        words, toxic = rng.choices(plain, k=rng.randrange(20, 80)), int(i % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs += [(n, None), (n + 1, ""), (None, "grumpox " * 9), (n + 2, "Ein FLEBBO, molna")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), labels


def test_toxic_words_are_found(spark):
    docs, marks, labels = planted(spark)
    got = {r.doc_id: r for r in classify_toxicity(docs, marks).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in labels)
    held = [(got[i].predicted, t) for i, t in labels if got[i].held_out]
    assert len(held) > 80 and all(p == t for p, t in held)
    assert got[602].spans == "4:10" and got[602].n_toxic == 1
    assert got[None].predicted == 1 and got[600].predicted == got[601].predicted == 0 and got[600].score == got[601].score


def test_held_out_labels_do_not_matter(spark):
    docs, marks, labels = planted(spark, 200)
    turned = spark.createDataFrame(
        [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels], "doc_id long, toxic int"
    )
    scores = [{r.doc_id: r.score for r in classify_toxicity(docs, m).collect()} for m in (marks, turned)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def test_without_labels_of_both_classes(spark):
    docs, marks, _ = planted(spark, 50)
    assert {r.score for r in classify_toxicity(docs, marks.limit(0)).collect()} == {0.5}
    only = marks.filter("toxic = 0")
    n = only.filter("crc32(cast(doc_id as string)) % 5 <> 0").count()
    assert {r.score for r in classify_toxicity(docs, only).collect()} == {1 / (n + 2)}


def test_sample_is_bounded(spark):
    docs, marks, _ = planted(spark)
    repeated = docs.filter("doc_id = 6").crossJoin(spark.range(300)).drop("id")
    model = learn(
        docs.unionByName(repeated).toDF("id", "body"), marks.toDF("id", "label"), Settings(sample=40, iterations=3)
    )
    assert model.score.shape in ((1,), (3,))
    drawn = toxicity.drawn(docs.unionByName(repeated).toDF("id", "body"), marks.toDF("id", "label"), Settings(sample=40))
    assert {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()} == {0: 40, 1: 40}
