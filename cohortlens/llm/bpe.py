"""Token counts by byte-pair merging on a heap and a linked list.

A word starts as a linked list of symbols. All adjacent pairs that can merge lie
on a heap by rank; the lowest is popped, its symbols are joined, and the pairs on
both sides of the new symbol are pushed. Pairs whose symbols have changed since
are passed over when popped. The count is the number of first symbols less the
merges; no token is ever looked up.
"""

from __future__ import annotations

import heapq
import json

import public_tokenizers
import regex
from pyspark.sql import DataFrame

from cohortlens.llm.common import per_text
from cohortlens.llm.tokens import safe_to_cut

TOKENIZER = "byte_bpe_50k.json"
#: Entries of the word cache of one worker (some 150 bytes each); a full cache starts anew.
CACHE = 1_000_000


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Counter:
    """Token counts of texts by the merges of a byte-level JSON vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        numbers: dict[str, int] = {}
        number = lambda s: numbers.setdefault(s, len(numbers))
        self.first = [number(c) for c in byte_letters()]
        # (left, right) as one number -> rank and joined symbol
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(described["model"]["merges"]):
            self.merges.setdefault(number(left) << 32 | number(right), (rank, number(left + right)))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        special = sorted((t["content"] for t in described["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.marks = special
        counter = self

        class Words(dict):
            """Tokens of a space and the word after it."""

            def __missing__(self, word: str) -> int:
                n = counter.plain(" " + word)
                if len(word) <= 100:
                    if len(self) >= CACHE:
                        self.clear()
                    self[word] = n
                return n

        class Parts(dict):
            """Tokens of a part that the pattern gives."""

            def __missing__(self, part: str) -> int:
                n = counter.merged(part.encode())
                if len(part) <= 100:
                    if len(self) >= CACHE:
                        self.clear()
                    self[part] = n
                return n

        self.words, self.parts = Words(), Parts()

    def merged(self, data: bytes) -> int:
        """Symbols left after all merges of one part."""
        n, find = len(data), self.merges.get
        if n < 2:
            return n
        symbol = [self.first[b] for b in data]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if (m := find(symbol[i] << 32 | symbol[i + 1])) is not None:
                heap.append((m[0], i, symbol[i], symbol[i + 1], m[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b, joined = heapq.heappop(heap)
            j = after[i] if symbol[i] == a else n
            if j >= n or symbol[j] != b:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = joined, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (m := find(joined << 32 | symbol[k])) is not None:
                    heapq.heappush(heap, (m[0], i, joined, symbol[k], m[1]))
            h = before[i]
            if h >= 0 and (m := find(symbol[h] << 32 | joined)) is not None:
                heapq.heappush(heap, (m[0], h, symbol[h], joined, m[1]))
        return left

    def plain(self, text: str) -> int:
        """Tokens of a text; strings of special tokens count as one each."""
        if self.special is not None and any(mark in text for mark in self.marks):
            return sum(
                1 if k % 2 else self.plain(part) for k, part in enumerate(self.special.split(text)) if part
            )
        return sum(map(self.parts.__getitem__, self.pattern.findall(text)))

    def count(self, text: str) -> int:
        if not safe_to_cut(text):
            return self.plain(text)
        head, *words = text.split(" ")
        return self.plain(head) + sum(map(self.words.__getitem__, words))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per worker process, with its caches."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, limit: int = 512
) -> DataFrame:
    """Bytes and tokens of each document; one row for each row.

    Null and empty texts have none of either. Repeated rows get equal rows; other
    columns are not looked at.
    """

    def make():
        count = counter(public_tokenizers.path(tokenizer)).count

        def one(value: str | None) -> tuple:
            value = value or ""
            n = count(value)
            return len(value.encode()), n, n > limit

        return one

    return per_text(df, [doc_id], text, make, "n_bytes long, n_tokens long, over_limit boolean")
