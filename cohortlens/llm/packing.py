"""Best-fit packing of tokenized documents into training sequences.

Lengths lie between 1 and the sequence length, so the packing problem is a table
of at most that many counts, whatever the number of documents. It is solved on
the driver by bin completion with branch and bound over counts; its answer, a list
of fillings and how often each is used, is bounded by the table too. Spark then
numbers the pieces of each length and looks up the place of each number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from math import inf

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import columns_of
from cohortlens.llm.tokens import safe_to_cut
from cohortlens.session import materialise

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k"
#: Entries of the word cache of one worker (some 250 bytes each, 150 MB); a full cache starts anew.
CACHE = 600_000

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


class Codec:
    """Token ids, as little-endian bytes, of whole texts by the JSON tokenizer and its default settings.

    Pieces of Latin text are encoded once per worker by the same vocabulary's rank
    file, which gives the same ids in a third of the time; everything else by the
    JSON tokenizer itself.
    """

    def __init__(self, name: str) -> None:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        path = public_tokenizers.path
        self.json = Tokenizer.from_file(path(f"{name}.json"))
        with open(path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {t.content: i for i, t in self.json.get_added_tokens_decoder().items()}
        fast = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        slow = self.whole

        class Words(dict):
            """Ids of a space and the word after it."""

            def __missing__(self, word: str) -> bytes:
                if len(word) > 100 or not word or max(word) > "ɏ":
                    return slow(" " + word)
                ids = np.array(fast.encode(" " + word, allowed_special="all"), "<u4").tobytes()
                if len(self) >= CACHE:
                    self.clear()
                self[word] = ids
                return ids

        self.words = Words()

    def whole(self, text: str) -> bytes:
        return np.array(self.json.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not safe_to_cut(text):
            return self.whole(text)
        head, *words = text.split(" ")
        return (self.whole(head) if head else b"") + b"".join(map(self.words.__getitem__, words))


_CODECS: dict[str, Codec] = {}


def codec(name: str) -> Codec:
    """One per worker process, with its cache."""
    if name not in _CODECS:
        _CODECS[name] = Codec(name)
    return _CODECS[name]


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids; a longer one is cut so that the first piece is the short one."""
    n, out, start = len(ids) // 4, [], 0
    while start < n:
        length = (n - start) % capacity if not start and n % capacity else min(capacity, n)
        out.append((len(out), start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
        start += length
    return out


def pieces(df: DataFrame, doc_id: str, text: str, tokenizer: str, capacity: int, end: int) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32."""
    inner = df.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("body"))
    tail = int(end).to_bytes(4, "little")
    arrow = pa.schema([(c, pa.int64()) for c in ("piece", "start", "length", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(tokenizer).encode
        for batch in batches:
            rows, origin = [], []
            for i, value in enumerate(batch.column(1)):
                own = cut(encode(value.as_py() or "") + tail, capacity)
                rows += own
                origin += [i] * len(own)
            ids = batch.column(0).take(pa.array(origin, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *columns_of(rows, arrow)], ["id", *arrow.names])

    schema = T.StructType([inner.schema["id"]] + [T.StructField(c, T.LongType()) for c in arrow.names])
    return inner.mapInArrow(run, schema)


def add(bins: dict[int, dict[Filling, int]], room: int, filling: Filling, times: int) -> None:
    """Counts ``times`` more bins with this filling among those with ``room`` left."""
    if times:
        group = bins.setdefault(room, {})
        group[filling] = group.get(filling, 0) + times


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best fit decreasing on counts: equal bins are filled together."""
    bins: dict[int, dict[Filling, int]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in bins if r >= length):
            each, group = room // length, bins.pop(room)
            for filling, times in group.items():
                full = min(times, left // each)
                add(bins, room - each * length, (*filling, (length, each)), full)
                left -= full * each
                times -= full
                if times and left and left < each:
                    add(bins, room - left * length, (*filling, (length, left)), 1)
                    times, left = times - 1, 0
                add(bins, room, filling, times)
            if not left:
                break
        each = capacity // length
        add(bins, capacity - each * length, ((length, each),), left // each)
        if left % each:
            add(bins, capacity - left % each * length, ((length, left % each),), 1)
    return [(filling, times) for group in bins.values() for filling, times in group.items()]


def completions(counts: list[int], room: int, width: float, steps: float) -> tuple[list[tuple[int, list[int]]], int]:
    """(waste, lengths) of up to ``width`` undominated fillings of ``room``, least waste first; and the steps it took.

    Fillings are built from long to short. One is dominated, and left out, if a
    remaining piece still fits or could replace a shorter one of it. ``steps``
    bounds the enumeration of one call, not what is packed: the search stays valid
    with fewer branches.
    """
    lengths = [n for n in range(min(room, len(counts) - 1), 0, -1) if counts[n]]
    if not lengths:
        return [(room, [])], 1
    found: list[tuple[int, list[int]]] = []
    used: dict[int, int] = {}
    spent = 0

    def undominated(chosen: list[int], waste: int) -> bool:
        free = lambda n: n < len(counts) and counts[n] > used.get(n, 0)
        if any(free(n) for n in range(1, waste + 1)):
            return False
        return not any(free(n) for c in set(chosen) for n in range(c + 1, c + waste + 1))

    def extend(first: int, space: int, chosen: list[int]) -> bool:
        """False once enough is found."""
        nonlocal spent
        spent += 1
        if space <= len(counts) - 1 and space and counts[space] > used.get(space, 0) and space <= lengths[first]:
            found.append((0, [*chosen, space]))
            if len(found) >= width:
                return False
        grown = False
        for at in range(first, len(lengths)):
            n = lengths[at]
            if n >= space and n != space or counts[n] <= used.get(n, 0):
                continue
            grown = True
            if n == space:
                continue
            used[n] = used.get(n, 0) + 1
            chosen.append(n)
            go_on = extend(at, space - n, chosen)
            chosen.pop()
            used[n] -= 1
            if not go_on or spent >= steps:
                return False
        if not grown and undominated(chosen, space):
            found.append((space, list(chosen)))
        return len(found) < width

    extend(0, room, [])
    if not found:  # the enumeration ended early: the first fit is a filling too
        space, chosen = room, []
        for n in lengths:
            take = min(counts[n], space // n)
            chosen += [n] * take
            space -= take * n
        found.append((space, chosen))
    return sorted(found, key=lambda f: (f[0], len(f[1]))), spent


def least_bins(counts: list[int], capacity: int) -> int:
    """Bins that any packing needs, by the waste that cannot be avoided.

    For a size k: pieces over capacity - k stand without any piece of k or more, pieces
    over half the capacity stand alone among themselves, and the pieces from k up
    to half fill at most the room beside the latter. The best k counts.
    """
    number = np.array(counts, np.int64)
    upto = np.concatenate(([0], np.cumsum(number)))  # upto[n]: pieces shorter than n
    weight = np.concatenate(([0], np.cumsum(number * np.arange(len(number)))))
    half = capacity // 2
    k = np.arange(1, half + 1)
    alone = upto[capacity + 1] - upto[capacity - k + 1]
    big = upto[capacity - k + 1] - upto[half + 1]
    room = big * capacity - (weight[capacity - k + 1] - weight[half + 1])
    middle = weight[half + 1] - weight[k]
    bound = alone + big + np.maximum(0, -((room - middle) // capacity))
    return int(max(bound.max(initial=0), -(-int(weight[-1]) // capacity)))


#: Passes of the search while the best packing is above the bound: branches at a node, steps of one enumeration of
#: them, nodes, and work of the whole pass (its steps, and the lengths in use at each node). The last one branches on
#: every undominated filling.
PASSES = ((3, 300, 1000, 2_000_000), (12, 3000, 300, 100_000), (inf, inf, 3000, 100_000))


def pack(
    counts: dict[int, int], capacity: int, passes: Sequence[tuple[float, float, int, int]] = PASSES
) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used, for ``counts`` pieces of each length.

    Bin completion: the longest piece left is put into a bin, the undominated
    fillings of the rest of the bin are the branches, and a filling is used as
    often as the counts allow. A branch ends when its bins so far and the least
    bins for the rest can't beat the best packing known, which best fit decreasing
    gives at first and again from the nodes on the way. The first pass looks at the few branches of least waste, the
    last one at all; their limits bound the search for something better, every piece is packed in any case. Tables that
    the last pass can search within its limits get the fewest bins.
    """
    left = [0] * (capacity + 1)
    for n, c in counts.items():
        left[n] = c
    best = best_fit({n: c for n, c in enumerate(left) if c}, capacity)
    least = least_bins(left, capacity)
    for width, steps, nodes, budget in passes:
        if sum(times for _, times in best) <= least:
            break
        best = search(left, capacity, best, least, width, steps, nodes, budget)
    return best


def search(
    start: list[int], capacity: int, best: list[tuple[Filling, int]], least: int, width: float, steps: float, nodes: int, budget: int
) -> list[tuple[Filling, int]]:
    """The best packing that one pass finds, ``best`` if none is better."""
    size, visited, taken = sum(times for _, times in best), 0, 0
    stack: list[tuple] = [(start, (), 0)]  # counts, fillings so far, number of bins; depth first
    while stack and size > least and visited < nodes and taken < budget:
        left, done, bins = stack.pop()
        longest = next((n for n in range(capacity, 0, -1) if left[n]), 0)
        if not longest:
            if bins < size:
                size, best = bins, unwind(done)
            continue
        if bins + least_bins(left, capacity) >= size:
            continue
        if visited % 16 == 0:
            rest = best_fit({n: c for n, c in enumerate(left) if c}, capacity)
            if (total := bins + sum(times for _, times in rest)) < size:
                size, best = total, unwind(done) + rest
        visited += 1
        inner = list(left)
        inner[longest] -= 1
        branches = []
        found, spent = completions(inner, capacity - longest, width, min(steps, budget - taken))
        taken += spent + sum(map(bool, left))
        for _, chosen in found:
            need: dict[int, int] = {}
            for n in [longest, *chosen]:
                need[n] = need.get(n, 0) + 1
            most = min(left[n] // k for n, k in need.items())
            # using a filling once only leaves the others open for equal bins: tried where all branches are
            for times in [most, 1] if width == inf and most > 1 else [most]:
                after = list(left)
                for n, k in need.items():
                    after[n] -= times * k
                branches.append((after, (done, tuple(sorted(need.items(), reverse=True)), times), bins + times))
        stack += branches[::-1]  # least waste on top
    return best


def unwind(done: tuple) -> list[tuple[Filling, int]]:
    out = []
    while done:
        done, filling, times = done
        out.append((filling, times))
    return out


def places(packing: list[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """For each run of numbers of one length: the first bin, pieces per bin and offset in it."""
    rows, used, first = [], {}, 0
    for filling, times in packing:
        offset = 0
        for length, each in filling:
            rows.append((length, used.get(length, 0), first, each, offset))
            used[length] = used.get(length, 0) + times * each
            offset += length * each
        first += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "bin", "each", "offset"), table.T))


def best_fit_packing(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """Where each piece of each document goes; one row for each piece.

    A null or empty text is the end token alone. Repeated rows are packed again;
    null ids are kept; an empty table gives no rows. Other columns are not looked at.
    """
    # numbered as it is written, so every later read sees the same numbers
    cut_rows = materialise(
        pieces(df, doc_id, text, tokenizer, capacity, end).withColumn("row", F.monotonically_increasing_id()), "pieces"
    ).withColumn("chunk", F.shiftright("row", 16))
    per_chunk = materialise(cut_rows.groupBy("length", "chunk").agg(F.count("*").alias("n")), "chunks")
    counts = {r["length"]: r["n"] for r in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = places(pack(counts, capacity))

    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_chunk.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "chunk").orderBy("row")
    numbered = (
        cut_rows.withColumn("rank", F.row_number().over(within) - 1)
        .join(starts, ["length", "chunk"])
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = plan["length"] * (1 << 48) + plan["rank"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            behind = rank - plan["rank"][at]
            sequence = plan["bin"][at] + behind // plan["each"][at]
            offset = plan["offset"][at] + behind % plan["each"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    schema = T.StructType(
        [*numbered.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return numbered.mapInArrow(run, schema).withColumnRenamed("id", doc_id)
