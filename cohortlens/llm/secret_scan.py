"""Secrets in text, also behind nested encodings.

A worklist holds the layers of a document. The first layer is the text itself.
Every layer is searched with the same patterns and then opened: percent and
Unicode escapes give the whole layer rewritten, with a position for each
character; base64 runs give layers of their own, and compressed bytes in them are
unpacked first, all members and frames of them. Layers are opened until none is left.
A layer that was met before at the same place is not taken again, so a cycle ends.
Escapes of escapes are searched level by level; below `LEVELS` of them the rest is
resolved to its fixpoint in one pass, so that time and memory stay linear.

Decoded and unpacked bytes are always searched, whatever they are; a bare base64 word
must look like text only to be opened further. A layer over `MAX_LAYER` is searched in
overlapping windows.

Positions are code points of the document. What is found in an opened layer has
the span of the encoded characters that it came from.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import fresh, per_text

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
TAIL = re.compile(r"\r?\n[A-Za-z0-9+/]{1,15}={0,2}(?![A-Za-z0-9+/=])")
ESCAPE = re.compile(
    r"(?P<url>(?:%[0-9A-Fa-f]{2})+)"
    r"|\\u(?P<high>[dD][89abAB][0-9A-Fa-f]{2})\\u(?P<low>[dD][c-fC-F][0-9A-Fa-f]{2})"
    r"|\\u(?P<four>[0-9A-Fa-f]{4})|\\u\{(?P<braced>[0-9A-Fa-f]{1,6})\}|\\U(?P<eight>[0-9A-Fa-f]{8})"
    r"|\\x(?P<two>[0-9A-Fa-f]{2})|&#[xX](?P<ref>[0-9A-Fa-f]{1,6});|&#(?P<dec>[0-9]{1,7});"
)
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\ufffe\uffff]")
#: Size from which a layer is taken in windows, and what they share at least: more where an encoded run crosses.
MAX_LAYER, OVERLAP = 64 << 20, 1 << 20
#: Bytes unpacked for one document, so that nested bombs end. What is beyond, and encoded runs of over half a window
#: within a windowed layer, are counted in `n_unopened`; `redacted` masks the place that they came from.
MAX_TOTAL = 8 << 30
ENCODED = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\&#;{}\r\n\x00"
BROKEN = (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError)
PIECE = 1 << 16
#: Share of characters that are no text up to which a bare base64 word is opened further.
NO_TEXT = 0.1
#: Levels of escapes within escapes that are layers of their own, and the longest escape of one character.
LEVELS, ESCAPED = 16, 12
#: Compressed formats within each other that are read as one stream; below them the bytes are held.
STREAMS = 100
MASK = "[SECRET]"


class Layer(NamedTuple):
    text: str
    start: np.ndarray | int | None  # document position of each character; one for all; None: the document itself
    end: np.ndarray | int | None
    path: str
    level: int = 0  # of escapes within escapes
    sealed: bool = False  # searched, but not opened further

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        if isinstance(self.start, int):
            return self.start, self.end
        return int(self.start[a]), int(self.end[b - 1])


def encoded_runs(text: str) -> list[tuple[int, int]]:
    """Runs that may be base64, and runs of 40 characters or more joined over line ends. Linear in the text."""
    runs = [m.span() for m in RUN.finditer(text)]
    joined, first = [], 0
    for i, (a, b) in enumerate(runs):
        after = runs[i + 1][0] if i + 1 < len(runs) else -1
        if b - a >= 40 and b < after <= b + 2 and text[b:after] in ("\n", "\r\n"):
            continue  # goes on in the next line
        tail = TAIL.match(text, b) if b - a >= 40 else None
        if first < i:
            joined.append((runs[first][0], b))
        if tail:  # a short last line, or the word after the run
            joined.append((runs[first][0], tail.end()))
        first = i + 1
    return runs + joined


class Found(NamedTuple):
    base: list[tuple[int, int, int]]  # start, kind, end
    added: list[tuple[int, int, int]]
    paths: list[str]
    unopened: int
    closed: list[tuple[int, int]]  # where the layers counted in unopened came from


def matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base match in one layer."""
    out = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def unescape(layer: Layer) -> tuple[Layer | None, list[tuple[bytes, int, int]]]:
    """The layer with one level of escapes resolved (None if it has none), and byte runs that are no text."""
    text, pieces, at, raw = layer.text, [], 0, []
    lengths, starts, widths = array("q"), array("q"), array("q")  # runs of characters: of the text, or one escape each

    def run(length: int, start: int, width: int) -> None:
        lengths.append(length)
        starts.append(start)
        widths.append(width)

    for m in ESCAPE.finditer(text):
        kind, value = m.lastgroup, m[m.lastgroup]
        if kind == "url":
            data = bytes.fromhex(value.replace("%", ""))
            chars = data.decode("utf-8", "surrogateescape")
            sizes = [3 if "\udc80" <= c <= "\udcff" else 3 * len(c.encode()) for c in chars]
            if any("\udc80" <= c <= "\udcff" for c in chars):  # such bytes stand as characters of their own
                raw.append((data, m.start(), m.end()))
                chars = "".join(chr(ord(c) - 0xDC00) if "\udc80" <= c <= "\udcff" else c for c in chars)
        elif (chars := character(m)) is None:
            continue
        else:
            sizes = [m.end() - m.start()]
        pieces += [text[at : m.start()], chars]
        run(m.start() - at, at, 1)
        first = m.start()
        for size in sizes:
            run(1, first, size)
            first += size
        at = m.end()
    if not pieces:
        return None, raw
    pieces.append(text[at:])
    run(len(text) - at, at, 1)
    path, level = f"{layer.path}>escape" if not layer.level else layer.path, layer.level + 1
    if isinstance(layer.start, int):  # all at one place
        return Layer("".join(pieces), layer.start, layer.end, path, level), raw
    length = np.frombuffer(lengths, np.int64)
    start = np.repeat(np.frombuffer(starts, np.int64) - np.cumsum(length) + length, length) + np.arange(length.sum())
    end = start + np.repeat(np.frombuffer(widths, np.int64), length)
    if layer.start is not None:
        start, end = layer.start[start], layer.end[end - 1]
    return Layer("".join(pieces), start, end, path, level), raw


def character(m: re.Match) -> str | None:
    """The character of an escape that is no percent escape; None if it is none."""
    kind, value = m.lastgroup, m[m.lastgroup]
    if kind == "low":
        code = 0x10000 + ((int(m["high"], 16) & 0x3FF) << 10) + (int(value, 16) & 0x3FF)
    else:
        code = int(value, 10 if kind == "dec" else 16)
    return None if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)


def settled(layer: Layer) -> Layer:
    """The layer with its escapes resolved until none is left, in one pass.

    A resolved character goes back to what is still to be read, with as many characters before it as may begin an
    escape that it completes. Each escape makes the text shorter, so the pass is linear.
    """
    text, ahead = layer.text, []  # characters put back, the next one last: (character, first, last)
    done: list[str] = []
    first, last = array("q"), array("q")
    at = 0
    while ahead or at < len(text):
        next_one = ahead[-1][0] if ahead else text[at]
        if next_one in "%\\&":
            back = ahead[: -ESCAPED - 1 : -1]
            window = "".join(c for c, _, _ in back) + text[at : at + ESCAPED - len(back)]
            m = ESCAPE.match(window)
            if m is not None:
                char, used = None, m.end()
                if m.lastgroup == "url":
                    data = bytes.fromhex(m["url"].replace("%", ""))[:4]
                    size = next((k for k in range(1, len(data) + 1) if _is_character(data[:k])), 0)
                    char, used = (data[:size].decode(), 3 * size) if size else (chr(data[0]), 3)
                else:
                    char = character(m)
                if char is not None:
                    held = min(used, len(ahead))
                    spots = [ahead.pop()[1:] for _ in range(held)]
                    spots += [(at + k, at + k) for k in range(used - held)]
                    at += used - held
                    ahead.append((char, spots[0][0], spots[-1][1]))
                    tail = "".join(done[-ESCAPED + 1 :])
                    for _ in range(len(tail) - min((k for k in map(tail.find, "%\\&") if k >= 0), default=len(tail))):
                        ahead.append((done.pop(), first.pop(), last.pop()))
                    continue
        if ahead:
            char, a, b = ahead.pop()
        else:
            char, a, b = next_one, at, at
            at += 1
        done.append(char)
        first.append(a)
        last.append(b)
    if isinstance(layer.start, int):
        return Layer("".join(done), layer.start, layer.end, layer.path, layer.level)
    start, end = np.frombuffer(first, np.int64), np.frombuffer(last, np.int64)
    start, end = (layer.start[start], layer.end[end]) if layer.start is not None else (start, end + 1)
    return Layer("".join(done), start, end, layer.path, layer.level)


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def packing(head: bytes) -> str | None:
    """The format that the first bytes announce."""
    if head[:2] == b"\x1f\x8b":
        return "gzip"
    if head[:3] == b"BZh":
        return "bzip2"
    if head[:6] == b"\xfd7zXZ\x00":
        return "xz"
    if head[:4] == b"\x28\xb5\x2f\xfd" or head[1:4] == b"\x2a\x4d\x18" and head[0] >> 4 == 5:
        return "zstd"
    if len(head) > 2 and head[0] & 15 == 8 and (head[0] << 8 | head[1]) % 31 == 0:
        return "zlib"
    return None


OPENERS = {
    "gzip": lambda: zlib.decompressobj(47),
    "zlib": lambda: zlib.decompressobj(47),
    "bzip2": bz2.BZ2Decompressor,
    "xz": lzma.LZMADecompressor,
    "zstd": lambda: zstandard.ZstdDecompressor().decompressobj(),
}


class Source:
    """Pieces of bytes, none empty before the end; those taken since ``log`` was set can be put back."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.back, self.log = pieces, [], None

    def take(self) -> bytes:
        piece = self.back.pop() if self.back else next(self.pieces, b"")
        if self.log is not None:
            self.log.append(piece)
        return piece


def pieces_of(data: bytes) -> Iterator[bytes]:
    return (data[at : at + PIECE] for at in range(0, len(data), PIECE))


def members(source: Source) -> Iterator[bytes]:
    """The content of every member or frame, piece by piece, as far as it can be read."""
    data = source.take()
    while True:
        while len(data) < 6 and (more := source.take()):
            data += more
        if (name := packing(data[:6])) is None:
            return
        opened = OPENERS[name]()
        try:
            while not opened.eof:
                if name == "zstd":  # has no bound of its own on what comes out
                    out, data = opened.decompress(data[:1024]), data[1024:]
                    if opened.eof:
                        data = opened.unused_data + data
                else:
                    out = opened.decompress(data, PIECE)
                    data = opened.unused_data if opened.eof else opened.unconsumed_tail if hasattr(opened, "unconsumed_tail") else b""
                if out:
                    yield out
                elif not opened.eof and not data and not (data := source.take()):
                    return
        except BROKEN:
            return
        if name in ("gzip", "xz"):  # may be padded
            while not (data := data.lstrip(b"\0")) and (data := source.take()):
                pass


def peel(source: Source) -> tuple[str, Source] | None:
    """(format, content) if the bytes are compressed, else None and nothing is taken."""
    source.log = []
    head = b""
    while len(head) < 6 and (piece := source.take()):
        head += piece
    name, taken = packing(head[:6]), [p for p in source.log if p]
    source.back += reversed(taken)
    source.log = []
    inner = Source(members(source))
    first = inner.take() if name else b""
    taken, source.log = [p for p in source.log if p], None
    if not first:
        source.back += reversed(taken)
        return None
    inner.back.append(first)
    return name, inner


def unpack(data: bytes, room: int) -> tuple[str, bytes | None] | None:
    """(format, content) of compressed bytes; content None: larger than ``room``; None: not compressed."""
    if (name := packing(data[:6])) is None:
        return None
    out = bytearray()
    for piece in members(Source(pieces_of(data))):
        out += piece
        if len(out) > room:
            return name, None
    return (name, bytes(out)) if out else None


def views(data: bytes) -> list[str]:
    """The bytes as text; with NUL bytes (UTF-16, UTF-32) also without them. Bytes that are no text are replaced."""
    out = [data.decode("utf-8", "replace")]
    if "\ufffd" in out[0]:
        out.append(data.decode("latin-1"))
    if b"\0" in data:
        out.append(data.replace(b"\0", b"").decode("utf-8", "replace"))
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        out.append(data.decode("utf-16", "replace"))
    return [text for text in out if text]


def no_text(text: str) -> float:
    """Share of control and replaced characters."""
    return (sum(1 for _ in CONTROL.finditer(text)) + text.count("\ufffd")) / len(text) if text else 1.0


def from_base64(run: str) -> bytes | None:
    run = run.rstrip("=").translate({45: 43, 95: 47, 10: None, 13: None})
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True) if len(run) % 4 != 1 else None
    except binascii.Error:
        return None


def suffixes(run: str) -> Iterator[int]:
    """Where in a run, behind a '/', '_' or '-', compressed bytes or a text seem to start."""
    aligned = set()
    for m in re.finditer(r"[/_-](?=[A-Za-z0-9+/_-]{16})", run):
        at = m.end()
        head = from_base64(run[at : at + 24][: len(run[at : at + 24].rstrip("=")) // 4 * 4])
        if head is None:
            continue
        if packing(head[:6]) is not None:
            yield at
        elif at % 4 not in aligned and no_text(views(head)[-1] if head else "") == 0:
            data = from_base64(run[at:])
            if data is not None and min(map(no_text, views(data)), default=1.0) <= NO_TEXT:
                aligned.add(at % 4)  # a later one of this kind lies in it
                yield at


def scan(text: str | None) -> Found:
    """All secrets of one text. Null is the empty text, which has none."""
    text = text or ""
    base = matches(text)
    own = set(base)
    added, paths, closed, room = set(), set(), [], MAX_TOTAL
    seen: set[tuple] = set()
    charged: set[bytes] = set()

    def charge(data: bytes) -> bytes:
        nonlocal room
        digest = hashlib.blake2b(data, digest_size=16).digest()
        if digest not in charged:
            charged.add(digest)
            room -= len(data)
        return digest

    def opened(data: bytes, start: int, end: int, path: str) -> Iterator[Layer]:
        known = set()
        while (packed := unpack(data, min(MAX_LAYER, max(room, 0)))) is not None:
            name, content = packed
            path = f"{path}>{name}"
            if content is None:
                yield from windows(data, start, end, path)
                return
            if (digest := charge(content)) in known:
                return
            known.add(digest)
            data = content
        for inner in views(data):
            yield Layer(inner, start, end, path)

    def windows(data: bytes, start: int, end: int, path: str) -> Iterator[Layer]:
        nonlocal room
        digest = hashlib.blake2b(data, digest_size=16).digest()
        again, whole, depth = digest in charged, True, 0
        charged.add(digest)
        source = Source(members(Source(pieces_of(data))))
        while depth < STREAMS and (packed := peel(source)) is not None:
            name, source = packed
            path, depth = f"{path}>{name}", depth + 1
        buffer = bytearray()
        if depth == STREAMS:  # a stream within a stream takes stack; what is left starts anew, if it can be held
            while len(buffer) <= MAX_LAYER and (piece := source.take()):
                buffer += piece
            if len(buffer) <= MAX_LAYER:
                charge(bytes(buffer))
                yield from opened(bytes(buffer), start, end, path)
                return
            source.back.append(bytes(buffer))
            buffer.clear()
        while True:
            piece = source.take()
            buffer += piece
            room -= 0 if again else len(piece)
            if piece and len(buffer) < MAX_LAYER and room > 0:
                continue
            for inner in views(bytes(buffer)):
                yield Layer(inner, start, end, path)
            if not piece:
                break
            if room <= 0:
                whole = False
                break
            run = len(buffer) - len(buffer.rstrip(ENCODED))
            if run > len(buffer) // 2:
                whole, run = False, 0
            del buffer[: len(buffer) - max(run, min(OVERLAP, len(buffer) // 2))]
        if not whole:
            closed.append((start, end))

    def word(data: bytes | None, start: int, end: int, path: str) -> Iterator[Layer]:
        """Layers of a decoded base64 word; those of one that is no text are only searched."""
        if data is None:
            return
        if unpack(data, 1) is not None or min(map(no_text, views(data)), default=1.0) <= NO_TEXT:
            yield from opened(data, start, end, path)
        else:
            for inner in views(data):
                yield Layer(inner, start, end, path, sealed=True)

    def inside(layer: Layer) -> Iterator[Layer]:
        """The layers in a layer. That of its escapes is returned at the end, when this one is no longer needed."""
        inner = layer.text
        for a, b in encoded_runs(inner):
            data = from_base64(inner[a:b])
            yield from word(data, *layer.span(a, b), f"{layer.path}>base64")
            if data is None or unpack(data, 1) is None and min(map(no_text, views(data)), default=1.0):  # a path around it
                for part in re.finditer(r"[A-Za-z0-9+]{16,}={0,2}", inner[a:b]):
                    if part.end() - part.start() < b - a:
                        yield from word(from_base64(part[0]), *layer.span(a + part.start(), a + part.end()), f"{layer.path}>base64")
                for at in suffixes(inner[a:b]):
                    yield from word(from_base64(inner[a + at : b]), *layer.span(a + at, b), f"{layer.path}>base64")
        if "%" in inner or "\\" in inner or "&#" in inner:
            plain, raw = unescape(layer)
            for data, a, b in raw:
                if unpack(data, 1) is not None:
                    yield from opened(data, *layer.span(a, b), f"{layer.path}>url")
            if plain is not None:
                return settled(plain) if plain.level >= LEVELS else plain
        return None

    todo = [inside(Layer(text, None, None, ""))]
    while todo:
        try:
            layer = next(todo[-1])
        except StopIteration as end:
            todo.pop()
            layer = end.value
            if layer is None:
                continue
        span = layer.span(0, len(layer.text)) if layer.text else (0, 0)
        mark = (hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest(), *span)
        if mark in seen:
            continue
        seen.add(mark)
        for a, kind, b in matches(layer.text):
            start, end = layer.span(a, b)
            added.add((start, kind, end))
            if (start, kind, end) not in own:
                paths.add(layer.path[1:])
        if not layer.sealed:
            todo.append(inside(layer))
    return Found(base, sorted(added - own), sorted(paths), len(closed), closed)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def redacted(text: str | None) -> str | None:
    """The text with every secret, overlapping ones together, replaced by one mark. Null stays null.

    So is the place of a layer that could not be searched to its end.
    """
    if not text:
        return text
    found, out, at = scan(text), [], 0
    hidden = [(a, b) for a, _, b in (*found.base, *found.added)] + found.closed
    for start, end in sorted(hidden):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of each document; one row for each row.

    `spans` lists base and decoded findings as kind:start:end, `n_added` counts
    those that only an opened layer shows, `layers` names the encodings around
    them and `n_unopened` the layers not searched to their end. Null and
    empty texts have zero counts and empty lists; repeated rows are repeated; other
    columns are not looked at.
    """

    def one(value: str | None) -> tuple:
        found = scan(value)
        counts = [sum(k == kind for _, k, _ in found.base) for kind in range(3)]
        base = written(found.base)
        return (
            *counts,
            hashlib.sha256(base.encode()).hexdigest(),
            written([*found.base, *found.added]),
            len(found.added),
            ",".join(found.paths),
            found.unopened,
        )

    return per_text(
        df,
        [doc_id],
        text,
        lambda: one,
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long, layers string, "
        "n_unopened long",
    )


def redact_secrets(df: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets masked in ``text``; ``n_chars``, where present, follows.

    Rows with a null or empty text and rows without a secret stay as they are.
    """
    name = fresh(df, "masked")
    out = per_text(df, df.columns, text, lambda: lambda value: (redacted(value),), f"{name} string")
    changed = F.col(name) != F.col(text)
    return out.select(
        *[
            F.col(name).alias(c)
            if c == text
            else F.when(changed, F.length(name).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c == n_chars
            else F.col(c)
            for c in df.columns
        ]
    )
