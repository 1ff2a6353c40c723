"""Benchmark items in any script, of any length, and in any number of blocks."""

import random

import numpy as np
import pytest

from cohortlens.llm import decontaminate
from cohortlens.llm.decontaminate import Block, Settings, blocks, contaminated, drop_contaminated, words_of

CHINESE = "水的沸点随着大气压强的降低而下降，因此在高山上煮鸡蛋需要更长的时间才能熟透。"
THAI = "น้ำเดือดที่อุณหภูมิต่ำลงเมื่อความดันอากาศลดลงบนภูเขาสูง"
JAPANESE = "水の沸点は気圧が下がると低くなるので、高い山では卵をゆでる時間が長くなる。"


def test_words_of_any_script():
    fold = lambda t: b" ".join(words_of(t)).decode()
    assert fold("“Don’t”—he said… ‘no’ more") == "don t he said no more"
    assert fold("日本、ABC山") == "日 本 abc 山"
    assert fold("co­operate naïve 한국어 हिन्दी") == "cooperate naïve 한국어 हिन्दी"


@pytest.mark.parametrize("item", [CHINESE, THAI, JAPANESE])
def test_items_without_spaces_are_found(item):
    block = Block([(1, item)], Settings())
    pick = random.Random(1)
    changed = "".join(c if pick.random() > 0.08 else "変" for c in item)
    assert len(block.find(f"前文{item}後文")) == 1
    assert len(block.find(f"前文{changed}後文")) == 1
    others = {CHINESE, THAI, JAPANESE} - {item}
    assert not any(block.find(t * 3) for t in others)


def test_typographic_marks_do_not_hide_an_edited_copy():
    block = Block([(1, '"why" - asked he - "did" "you" "go" - "so" - "soon"')], Settings())
    assert block.find("“why” — asked he — “did” “you” “go” — “so” — “soon”")


def test_short_items_are_found_as_whole_documents():
    block = Block([(1, "Forty-two"), (2, "Yes"), (3, "..."), (4, "forty two")], Settings())
    assert [h.item for h in block.find(" forty two! ")] == [0, 3]
    assert [h.item for h in block.find("YES.")] == [1]
    assert not block.find("no") and not block.find("...") and not block.find("")


def test_one_block_at_a_time_and_none_too_large(spark, monkeypatch):
    pick = random.Random(3)
    passage = lambda: " ".join("".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(30))
    texts = [passage() for _ in range(60)]
    ids = [7] * 30 + [None] * 15 + list(range(100, 115))  # half of the rows under one id, a quarter under none
    items = spark.createDataFrame(list(zip(ids, texts)), "item_id long, text string")
    docs = [(d, f"{passage()} {texts[d]} {passage()}") for d in range(60)] + [(60 + d, passage()) for d in range(20)]
    docs += [docs[0], docs[0], (80, f"{texts[0]} {texts[1]} {texts[55]}"), (81, None), (82, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    small = Settings(block_chars=1000)

    seen = []

    def watched(*given):
        n, read = blocks(*given)

        def noted(k):
            rows = read(k)
            seen.append(sum(len(t) for _, t in rows))
            return rows

        return n, noted

    one = sorted(map(str, contaminated(frame, items).collect()))
    kept = sorted(map(str, drop_contaminated(frame, items).collect()))
    monkeypatch.setattr(decontaminate, "blocks", watched)
    several = contaminated(frame, items, settings=small)
    assert len(seen) == 11 and max(seen) < 3000
    rest = drop_contaminated(frame, items, settings=small)
    for result in (several, rest):  # no block is in the plan
        assert "MapInArrow" not in result._jdf.queryExecution().toString()
    assert sorted(map(str, several.collect())) == one
    assert sorted(map(str, rest.collect())) == kept
    assert len(kept) == 22 and sum("doc_id=0," in r for r in one) == 3


def test_seeds_are_the_rarest_of_each_stretch():
    pick = random.Random(3)
    items = [(k, " ".join(f"w{pick.randrange(40)}" for _ in range(pick.randrange(120)))) for k in range(30)]
    block = Block(items, Settings())
    counts = np.array([pick.randrange(6) for _ in block.codes])
    block.choose(counts)
    want = set()
    for i, words in enumerate(block.words):
        own = [tuple(r) for r in block.rows.tolist() if r[1] == i]
        assert [p for _, _, p in sorted(own, key=lambda r: r[2])] == list(range(max(0, len(words) - 2)))
        for stretch in {p // 32 for _, _, p in own}:
            part = sorted((r for r in own if r[2] // 32 == stretch), key=lambda r: (counts[r[0]], r[2]))
            want |= set(part[: max(1, len(part) - int(len(part) * 0.25))])
    assert {tuple(r) for r in block.seeds.tolist()} == want
    assert not len(Block([], Settings()).seeds)
