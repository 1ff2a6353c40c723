"""Keywords only speed rules up: an example of each alternative of each rule passes the rule's own gate."""

import itertools
import math
import re
from re import _constants as c
from re import _parser

import pytest

from cohortlens.llm.license_rules import Rule, rules
from cohortlens.llm.licenses import find_licenses


def examples(tree):
    """Texts of a pattern that show each of its alternatives, all combinations where they are few."""
    parts = []
    for op, value in tree:
        if op is c.LITERAL:
            parts.append([chr(value)])
        elif op is c.IN:
            kind, arg = value[0]
            parts.append(["x"] if kind is c.CATEGORY else [chr(arg if kind is c.LITERAL else arg[0])])
        elif op is c.SUBPATTERN:
            parts.append(examples(value[3]))
        elif op is c.BRANCH:
            parts.append([e for branch in value[1] for e in examples(branch)])
        elif op is c.MAX_REPEAT:
            low, high, inner = value
            parts.append([e * n for n in sorted({low, min(high, low + 1)}) for e in examples(inner)])
        else:
            raise AssertionError(op)
    parts = [list(dict.fromkeys(p)) for p in parts]
    if math.prod(map(len, parts)) <= 500:
        return ["".join(p) for p in itertools.product(*parts)]
    first = [p[0] for p in parts]
    return ["".join([*first[:i], e, *first[i + 1 :]]) for i, p in enumerate(parts) for e in p]


@pytest.mark.parametrize("rule", rules(), ids=lambda r: f"{r.priority}-{r.label}-{r.keyword}")
def test_every_alternative_passes_its_gate(rule: Rule):
    shown = [" ".join(e.split()) for e in examples(_parser.parse(rule.pattern))]
    shown = [e for e in shown if re.fullmatch(rule.pattern, e)]
    assert shown
    for e in shown:
        low = f" {e} "
        assert any(f" {k}" in low for k in rule.keyword.split("|")), e
        assert not rule.also or f" {rule.also}" in low, e


def test_other_spellings_have_their_labels(spark):
    texts = ["released under the Expat License", "PNG Reference Library License", "CreativeML Open RAIL-M"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in find_licenses(docs).collect()}
    assert got == {0: "mit", 1: "libpng", 2: "openrail"}
