"""Secret scans through nested encodings.

The base patterns run over the text itself.  Then a worklist unwraps what the
text holds: URL escapes, Unicode and hex escapes, runs of base64, and compressed
bytes inside base64.  Every unwrapped layer is a text of its own with
a map from its characters back to those of the layer above; it is scanned with
the same patterns and put on the worklist again, until no layer yields another.
Layers already met (by content and place) are not unwrapped twice, so cyclic and
self-containing encodings end.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text

KINDS = ("assign", "access", "hex")
#: The contract's patterns and least lengths.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
ASSIGN_WORDS = ("passw", "secret", "token", "api")

#: An escaped percent sign (%25) before two digits is an escape of an escape, of any depth.
URL_ESCAPE = re.compile(r"%(?:25)*([0-9A-Fa-f]{2})")
CODE_ESCAPE = re.compile(r"\\+(?:u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})|U([0-9A-Fa-f]{8}))")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Runs that go on over line breaks; possessive, so that a long run is read once.
BASE64_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
BASE64_LETTER = re.compile(r"[A-Za-z0-9+/_-]")
#: The shortest text that a base pattern matches has twelve characters, all of them ASCII.
LEAST_RUN = re.compile(rb"[\t\r\n\x20-\x7e]{12}")
#: First bytes of compressed layers.
PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|x[\x01\x5e\x9c\xda]")
UNPACKERS = {0x1f: lambda: zlib.decompressobj(31), ord("B"): bz2.BZ2Decompressor, 0xfd: lzma.LZMADecompressor,
             0x28: lambda: zstandard.ZstdDecompressor().decompressobj(), ord("x"): zlib.decompressobj}


#: What is inflated is read in windows of so many bytes, each with the first bytes of the next.
WINDOW, OVERLAP = 1 << 20, 1 << 16


@dataclass(frozen=True)
class Layer:
    """An unwrapped text; character i stands for [starts[i], ends[i]) of the document, or for
    ``whole`` like every other one (what was compressed has no finer place)."""
    text: str
    starts: list[int] | None
    ends: list[int] | None
    depth: int
    whole: tuple[int, int] | None = None

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.whole is not None:
            return self.whole
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns in ``text``, without order."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(1)) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _decoded(pieces: list[tuple[bytes | str, int, int]], layer: Layer) -> Layer:
    """A layer of pieces, each with its place; neighbouring bytes are read as UTF-8 together."""
    text, starts, ends = [], [], []
    at = 0
    while at < len(pieces):
        if isinstance(pieces[at][0], str):
            chars = [(pieces[at][0], at, at + 1)]
            at += 1
        else:
            to = at
            while to < len(pieces) and isinstance(pieces[to][0], bytes):
                to += 1
            raw = b"".join(p[0] for p in pieces[at:to])
            chars, i = [], 0
            for c in raw.decode("utf-8", "surrogateescape"):
                chars.append((c, at + i, at + i + _width(c)))
                i += _width(c)
            at = to
        for c, first, last in chars:
            text.append(c)
            if layer.whole is not None:
                continue
            starts.append(layer.place(pieces[first][1], pieces[first][2])[0])
            ends.append(layer.place(pieces[last - 1][1], pieces[last - 1][2])[1])
    return Layer("".join(text), starts, ends, layer.depth + 1, layer.whole)


def _escapes(layer: Layer, escape: re.Pattern, value) -> Iterator[Layer]:
    """The whole text with its escapes replaced, so that what stands around them is scanned too."""
    text, pieces, at = layer.text, [], 0
    for e in escape.finditer(text):
        pieces += [(text[i], i, i + 1) for i in range(at, e.start())]
        pieces.append((value(e), e.start(), e.end()))
        at = e.end()
    if not at:
        return
    pieces += [(text[i], i, i + 1) for i in range(at, len(text))]
    yield from _unpacked(pieces, layer)
    yield _decoded(pieces, layer)


def _unpacked(pieces: list[tuple[bytes | str, int, int]], layer: Layer) -> Iterator[Layer]:
    """What is compressed in the bytes of the pieces, each placed on the bytes it was read from."""
    parts = [p[0] if isinstance(p[0], bytes) else p[0].encode("latin-1" if p[0] <= "\xff" else "utf-8") for p in pieces]
    of = [k for k, part in enumerate(parts) for _ in part]
    for first, last, text in _inflated(b"".join(parts)):
        yield Layer(text, None, None, layer.depth + 1, layer.place(pieces[of[first]][1], pieces[of[last - 1]][2]))


def _code_point(e: re.Match) -> str:
    n = int(e.group(1) or e.group(2) or e.group(3), 16)
    return chr(n) if n <= 0x10FFFF and not 0xD800 <= n <= 0xDFFF else "�"


def _width(c: str) -> int:
    """Bytes of a decoded character; a byte that is not UTF-8 is one lone surrogate."""
    return 1 if "\udc80" <= c <= "\udcff" else len(c.encode("utf-8"))


def _readable(raw: bytes) -> str | None:
    """The text of ``raw``, other bytes as lone surrogates; None without a run of ASCII that a base
    pattern, or a layer that holds one, could fill."""
    return raw.decode("utf-8", "surrogateescape") if LEAST_RUN.search(raw) else None


class Inflating:
    """What inflates from a place of ``raw`` on, up to damage or the end, piece by piece; ``end`` is
    where it ended, once all pieces are read."""

    def __init__(self, raw: bytes, at: int):
        self.raw, self.end = raw, at

    def __iter__(self) -> Iterator[bytes]:
        raw = self.raw
        while PACKED.match(raw, self.end):
            tool, to = UNPACKERS[raw[self.end]](), self.end
            try:
                while to < len(raw) and not tool.eof:
                    piece = tool.decompress(raw[to:to + 256])
                    to = min(to + 256, len(raw))
                    if piece:
                        yield piece
            except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError, zstandard.ZstdError):
                self.end = min(to + 256, len(raw))
                return
            self.end = to - len(tool.unused_data)
            if not tool.eof:
                return


def _in_pieces(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """What the pieces inflate to, 256 bytes of them at a time, so that each result is bounded."""
    small = (p[k:k + 256] for p in pieces for k in range(0, len(p), 256))
    rest = b""
    while True:
        while len(rest) < 8 and (p := next(small, None)) is not None:
            rest += p
        if not PACKED.match(rest):
            return
        tool = UNPACKERS[rest[0]]()
        try:
            while not tool.eof:
                out = tool.decompress(rest)
                if out:
                    yield out
                if not tool.eof and (rest := next(small, None)) is None:
                    return
        except (OSError, EOFError, ValueError, zlib.error, lzma.LZMAError, zstandard.ZstdError):
            return
        rest = tool.unused_data


def _innermost(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The pieces, inflated again as long as they begin a compressed layer themselves."""
    first = b""
    while len(first) < 8 and (p := next(pieces, None)) is not None:
        first += p
    if not PACKED.match(first):
        if first:
            yield first
        yield from pieces
        return
    kept = [first]

    def again() -> Iterator[bytes]:
        yield first
        for p in pieces:
            if kept:
                kept.append(p)
            yield p

    inner = _in_pieces(again())
    out = next(inner, None)
    if out is None:  # only looked like one
        yield from kept
        yield from pieces
        return
    kept.clear()
    yield from _innermost(itertools.chain([out], inner))


def _windows(pieces: Iterator[bytes]) -> Iterator[bytes]:
    held = bytearray()
    for p in pieces:
        held += p
        while len(held) >= WINDOW + OVERLAP:
            yield bytes(held[:WINDOW + OVERLAP])
            del held[:WINDOW]
    if held:
        yield bytes(held)


def _inflated(raw: bytes) -> Iterator[tuple[int, int, str]]:
    """(start, end, text) of the compressed stretches of ``raw``, wherever they start, a window of
    text at a time: memory does not follow the inflated size.  A stretch is inflated twice, first
    to see where it ends and whether anything in it can be read."""
    at = 0
    while m := PACKED.search(raw, at):
        stream, readable = Inflating(raw, m.start()), False
        pieces = iter(stream)
        for window in _windows(_innermost(pieces)):
            readable = readable or LEAST_RUN.search(window) is not None
        for _ in pieces:
            pass
        at = stream.end if readable else m.start() + 1
        if readable:
            for window in _windows(_innermost(iter(Inflating(raw, m.start())))):
                text = _readable(window)
                if text is not None:
                    yield m.start(), stream.end, text


def _base64(layer: Layer) -> Iterator[Layer]:
    """Layers of the runs, read from each of their first four characters on: a run may begin with
    letters that are not its own.  Runs over line breaks come first, then each line by itself."""
    opened: dict[int, tuple[int, int]] = {}
    runs = [m.span() for m in BASE64_LINES.finditer(layer.text) if m.end() - m.start() >= 16]
    for start, end in runs + [m.span() for m in BASE64_RUN.finditer(layer.text)]:
        at = [m.start() for m in BASE64_LETTER.finditer(layer.text, start, end)]
        letters = "".join(layer.text[i] for i in at).replace("-", "+").replace("_", "/")
        for phase in range(4):
            body = letters[phase:]
            if len(body) % 4 == 1:
                body = body[:-1]
            raw = base64.b64decode(body + "=" * (-len(body) % 4))
            for first, _, text in _inflated(raw):
                begin = at[phase + first * 8 // 6]
                # a compressed layer has no finer place than its whole run, and is opened once
                if opened.setdefault(begin, (phase, end)) == (phase, end):
                    yield Layer(text, None, None, layer.depth + 1, layer.place(begin, end))
            text = _readable(raw)
            if text is None:
                continue
            if layer.whole is not None:
                yield Layer(text, None, None, layer.depth + 1, layer.whole)
                continue
            starts, ends, byte = [], [], 0
            for c in text:
                lo = phase + byte * 8 // 6
                byte += _width(c)
                hi = phase + -(-byte * 8 // 6)
                place = layer.place(at[lo], at[hi - 1] + 1 if hi <= len(at) else end)
                starts.append(place[0])
                ends.append(place[1])
            yield Layer(text, starts, ends, layer.depth + 1)


def unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers inside a layer, one at a time."""
    if "%" in layer.text:
        yield from _escapes(layer, URL_ESCAPE, lambda e: bytes([int(e.group(1), 16)]))
    if "\\" in layer.text:
        yield from _escapes(layer, CODE_ESCAPE, _code_point)
    yield from _base64(layer)


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, int]]]:
    """Base spans, and the spans (start, end, kind, depth) that layers add, both in order."""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text), key=order)
    known = set(base)
    added, seen = [], set()
    work = [unwrapped(Layer(text, None, None, 0))]
    while work:  # depth first: one layer, or window of one, is held per depth
        inner = next(work[-1], None)
        if inner is None:
            work.pop()
        elif inner.text:
            mark = (hashlib.sha256(inner.text.encode("utf-8", "surrogatepass")).digest(), inner.place(0, 1)[0])
            if mark in seen:
                continue
            seen.add(mark)
            work.append(unwrapped(inner))
            for start, end, kind in base_spans(inner.text):
                at = (*inner.place(start, end), kind)
                if at not in known:
                    known.add(at)
                    added.append((*at, inner.depth))
    return base, sorted(added, key=order)


def digest(spans) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, the number of
    added spans and the depth of the deepest layer that added one.

    Null and empty texts have no spans; ids may be null or repeat; other columns are not
    read; an empty table gives no rows.
    """
    def run(ids, texts):
        rows = []
        for i, text in zip(ids, texts):
            base, added = scan(text)
            every = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            rows.append((i, *(sum(s[2] == k for s in base) for k in KINDS),
                         hashlib.sha256(digest(base).encode()).hexdigest(), digest(every), len(added),
                         max((s[3] for s in added), default=0)))
        return pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added", "depth"])

    out = per_text(docs, run, "doc_id string, n_assign long, n_access long, n_hex long, base_sha256 string, "
                              "spans string, n_added long, depth int")
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))
