"""Secret scans that look through nested encodings.

A worklist holds the layers of a text, at first the text itself. Every layer is scanned
for secrets and then unwrapped: percent and Unicode escapes give one decoded layer,
every base64 run, also one wrapped over lines, gives others: one for each alignment that
decodes to enough text, and one for each compressed stream in it, at whatever byte it begins.
Bytes that percent or backslash escapes spell are searched for streams too. Decoded bytes are
read as UTF-8 and, where every other byte is zero, as UTF-16. Raw deflate data has no
signature and is out of scope. Each layer knows which characters of the original text each
of its characters comes from.
The list is done when no layer is new; a layer seen before at the same place is skipped,
which ends cycles.
"""

from __future__ import annotations

import base64
import bz2
import io
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.storage import text_or_empty

#: The kinds in their order, what they match, and the least length.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Surrogates that do not stand for a byte.
HALVES = re.compile("[\ud800-\udc7f\udd00-\udfff]")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Runs that only line breaks part, with indents, quote and comment signs; and one of them.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t>#*;]*+[A-Za-z0-9+/_-]++)+={0,2}"
)
WRAPPED_LINE = re.compile(r"(?:^|\\n|[\s>#*;])([A-Za-z0-9+/_-]+={0,2})")
#: No secret, plain or encoded, is shorter than "token=" and six characters.
READABLE = re.compile(rb"[\x20-\x7e]{12}")
WIDE = {"utf-16-le": re.compile(rb"(?:[\x20-\x7e]\x00){12}"), "utf-16-be": re.compile(rb"(?:\x00[\x20-\x7e]){12}")}
STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd", re.DOTALL)
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});|[uU]\+([0-9A-Fa-f]{4,6})"
)
#: Bytes of unpacked content that are scanned at once, and what such parts share.
PART_BYTES, OVERLAP = 1 << 26, 1 << 20
#: Bytes of a stream that are handed to its library at once.
FEED = 1 << 16
#: The same for zstd, which returns all that it makes of them: 128 KiB for every four at most.
ZSTD_FEED = 1 << 9


def found_in(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets that stand in ``text`` as it is."""
    out = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


class Layer:
    """A decoded text; character ``i`` comes from ``start[i]:end[i]`` of the original."""

    def __init__(self, text: str, start: np.ndarray | None, end: np.ndarray | None, path: tuple[str, ...]):
        self.text, self.start, self.end, self.path = text, start, end, path
        self.span: tuple[int, int] | None = None  #: where all characters come from, if from one place

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        return int(self.start[a:b].min()), int(self.end[a:b].max())

    def key(self) -> tuple[str, bytes]:
        """The text and a digest of where its characters come from."""
        if self.start is None:
            return self.text, b""
        if self.span is not None:
            return self.text, b"%d:%d" % self.span
        digest = blake2b(self.start.tobytes())
        digest.update(self.end.tobytes())
        return self.text, digest.digest()

    def edited(self, edits: list[tuple[int, int, str]], step: str) -> Layer:
        """The layer with each ``a:b`` replaced; what is new comes from all of ``a:b``."""
        n = len(self.text)
        start = np.arange(n) if self.start is None else self.start
        end = np.arange(1, n + 1) if self.end is None else self.end
        texts, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            first, last = self.origin(a, b)
            texts += [self.text[at:a], new]
            starts += [start[at:a], np.full(len(new), first)]
            ends += [end[at:a], np.full(len(new), last)]
            at = b
        return Layer(
            "".join([*texts, self.text[at:]]), np.concatenate([*starts, start[at:]]),
            np.concatenate([*ends, end[at:]]), (*self.path, step),
        )

    def inside(self, a: int, b: int, new: str, steps: tuple[str, ...]) -> Layer:
        first, last = self.origin(a, b)
        start, end = (np.broadcast_to(np.int64(x), len(new)) for x in (first, last))
        layer = Layer(new, start, end, (*self.path, *steps))
        layer.span = (first, last)
        return layer


def _percent(layer: Layer) -> Layer | None:
    edits = []
    for m in PERCENT.finditer(layer.text) if "%" in layer.text else ():
        raw = bytes.fromhex(m.group().replace("%", ""))
        at = m.start()
        for char in raw.decode("utf-8", "surrogateescape"):
            size = 3 * len(char.encode("utf-8", "surrogateescape"))
            edits.append((at, at + size, char))
            at += size
    return layer.edited(edits, "url") if edits else None


def _unicode(layer: Layer) -> Layer | None:
    text, edits = layer.text, []
    if "\\" not in text and "&#" not in text and "U+" not in text and "u+" not in text:
        return None
    for m in UNICODE.finditer(text):
        digits = next(g for g in m.groups() if g is not None)
        point = int(digits, 10 if m.lastindex == 6 else 16)
        if point >= 0x110000:
            continue
        if edits and edits[-1][1] == m.start() and 0xDC00 <= point < 0xE000 and len(edits[-1][2]) == 1:
            high = ord(edits[-1][2])
            if 0xD800 <= high < 0xDC00:
                point = 0x10000 + ((high - 0xD800) << 10) + (point - 0xDC00)
                edits[-1] = (edits[-1][0], m.end(), chr(point))
                continue
        edits.append((m.start(), m.end(), chr(point)))
    return layer.edited(edits, "unicode") if edits else None


def _step(raw: bytes, at: int) -> str:
    return {b"\x1f": "gzip", b"x": "zlib", b"B": "bz2", b"\xfd": "xz", b"\x28": "zstd"}[raw[at : at + 1]]


def _zlib() -> object:
    return zlib.decompressobj(47)


def _zstd() -> object:
    return zstandard.ZstdDecompressor().decompressobj()


def _content(step: str, raw: bytes, at: int, reached: list[int]) -> Iterator[bytes]:
    """Pieces of the stream that begins at ``at``, up to its end or to where it breaks.

    ``reached`` gets the place after a stream that ends well.
    """
    unzip = {"bz2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor, "zstd": _zstd}.get(step, _zlib)()
    try:
        while not unzip.eof:
            if step in ("bz2", "xz"):
                fed = raw[at : at + FEED] if unzip.needs_input else b""
                piece = unzip.decompress(fed, FEED)
                idle = unzip.needs_input
            elif step == "zstd":
                fed, idle = raw[at : at + ZSTD_FEED], True
                piece = unzip.decompress(fed)
            else:
                held = unzip.unconsumed_tail
                fed = b"" if held else raw[at : at + FEED]
                piece = unzip.decompress(held or fed, FEED)
                idle = not unzip.unconsumed_tail
            at += len(fed)
            if piece:
                yield piece
            if idle and not piece and at >= len(raw) and not unzip.eof:
                return
    except (zlib.error, lzma.LZMAError, zstandard.ZstdError, OSError, EOFError, ValueError):
        return
    reached.append(at - len(unzip.unused_data))


def _members(raw: bytes, at: int, reached: list[int]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """Step and pieces of the stream at ``at``, and of those that follow it without a gap of text.

    Members of one kind count as one stream, as its tools unpack them.
    """
    while True:
        step = _step(raw, at)

        def pieces(step: str = step, at: int = at) -> Iterator[bytes]:
            while True:
                done: list[int] = []
                yield from _content(step, raw, at, done)
                if not done:
                    return
                reached[:] = done
                follower = STREAM.match(raw, _padding_end(raw, done[0]))
                if follower is None or _step(raw, follower.start()) != step:
                    return
                at = follower.start()

        before = reached[:]
        yield step, pieces()
        if reached == before:
            return
        follower = STREAM.match(raw, _padding_end(raw, reached[0]))
        if follower is None:
            return
        at = follower.start()


def _padding_end(raw: bytes, at: int) -> int:
    while raw[at : at + 1] == b"\0":
        at += 1
    return at


def _parts(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The pieces joined to parts of ``PART_BYTES``, each with the end of the one before."""
    held, size, lead = [], 0, 0
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= PART_BYTES:
            part = b"".join(held)
            yield part
            held = [part[-OVERLAP:]]
            size = lead = len(held[0])
    if size > lead:
        yield b"".join(held)


def _unpacked(
    raw: bytes, at: int, reached: list[int], outer: tuple[bytes, ...] = ()
) -> Iterator[tuple[tuple[str, ...], bytes]]:
    """Steps and parts of the compressed streams from ``at`` on, those within them unpacked too."""
    for step, pieces in _members(raw, at, reached):
        parts = _parts(pieces)
        first = next(parts, b"")
        if not STREAM.match(first):
            for part in chain([first] if first else [], parts):
                yield (step,), part
            continue
        rest = list(parts)
        whole = b"".join([first, *(part[OVERLAP:] for part in rest)])
        yield (step,), whole
        outer = (*outer, blake2b(memoryview(raw)[at:]).digest())
        if blake2b(whole).digest() not in outer:
            for steps, part in _unpacked(whole, 0, [], outer):
                yield (step, *steps), part


def _texts(raw: bytes) -> Iterator[tuple[tuple[str, ...], str]]:
    """Steps and text of bytes, read as UTF-8 and as UTF-16 where they look like it."""
    if READABLE.search(raw):
        yield (), raw.decode(errors="replace")
    found = [(m.start(), code) for code, wide in WIDE.items() if (m := wide.search(raw))]
    if found:
        at, code = min(found)
        yield ("utf16",), raw[at % 2 :].decode(code, errors="replace")


def _streams(layer: Layer) -> Iterator[Layer]:
    """Contents of compressed streams among the bytes that escapes have spelt."""
    step = layer.path[-1] if layer.path else ""
    if step == "url":
        raw = layer.text.encode("utf-8", "surrogateescape" if not HALVES.search(layer.text) else "replace")
    elif step == "unicode":
        raw = layer.text.encode("latin-1", "replace")
    else:
        return
    places, after = None, 0
    for m in STREAM.finditer(raw):
        if m.start() < after:
            continue
        reached: list[int] = []
        for steps, content in _unpacked(raw, m.start(), reached):
            for more, text in _texts(content):
                if places is None and step == "url":  # byte places of the characters
                    width = [len(c.encode("utf-8", "replace")) for c in layer.text]
                    places = np.concatenate([[0], np.cumsum(width)])
                end = max([m.start() + 1, *reached]) if reached else len(raw)
                a, b = (m.start(), end) if places is None else np.searchsorted(places, (m.start(), end))
                yield layer.inside(int(a), min(int(b), len(layer.text)), text, (*steps, *more))
        after = max([after, *reached])


def _wrapped_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and characters of base64 that is wrapped at one width.

    A block may begin on a line of another width and ends with the first shorter line.
    """
    for m in WRAPPED.finditer(text):
        lines = [x.span(1) for x in WRAPPED_LINE.finditer(m.group())]
        size = [b - a for a, b in lines]
        for i in range(len(lines) - 1):
            if i and size[i] == size[i - 1]:
                continue
            last = i + 1
            while last + 1 < len(lines) and size[last] == size[i + 1] >= size[last + 1] and size[last] >= 16:
                last += 1
            yield m.start() + lines[i][0], m.start() + lines[last][1], "".join(m.group()[a:b] for a, b in lines[i : last + 1])


def _base64(layer: Layer) -> Iterator[Layer]:
    runs = [(*m.span(), m.group()) for m in BASE64.finditer(layer.text)]
    for a, b, chars in [*runs, *_wrapped_runs(layer.text)]:
        run = chars.rstrip("=").replace("-", "+").replace("_", "/")
        for shift in range(4):  # what touches the run may not belong to it
            own = run[shift : len(run) - ((len(run) - shift) % 4 == 1)]
            raw = base64.b64decode(own + "=" * (-len(own) % 4))
            after = 0
            for m in STREAM.finditer(raw):
                if m.start() >= after:
                    start = a + (shift + m.start() * 4 // 3 if b - a == len(chars) else 0)
                    reached = []
                    for steps, content in _unpacked(raw, m.start(), reached):
                        for more, new in _texts(content):
                            yield layer.inside(start, b, new, ("base64", *steps, *more))
                    after = max([after, *reached])
            for more, new in _texts(raw):
                yield layer.inside(a + shift, b, new, ("base64", *more))


def scan(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, path) of all secrets, by start, then kind, then end.

    The path is empty for a secret in the text itself, else the decoding steps; where
    several paths lead to the same span, the first found stays.
    """
    spans: dict[tuple[str, int, int], str] = {}
    first = Layer(text, None, None, ())
    todo, seen = deque([first]), {first.key()}
    while todo:
        layer = todo.popleft()
        for kind, a, b in found_in(layer.text):
            spans.setdefault((kind, *layer.origin(a, b)), ">".join(layer.path))
        for new in (_percent(layer), _unicode(layer), *_base64(layer), *_streams(layer)):
            if new is not None and (key := new.key()) not in seen:
                seen.add(key)
                todo.append(new)
    rows = [(*span, path) for span, path in spans.items()]
    return sorted(rows, key=lambda r: (r[1], KINDS.index(r[0]), r[2], r[3]))


FINDING = "array<struct<kind: string, start: int, end: int, path: string>>"


def _scanned_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("path", pa.string())])
    )
    for batch in batches:
        rest = batch.drop_columns(["_text"])
        step = 512
        for a in range(0, batch.num_rows, step):
            texts = batch.column("_text").slice(a, step).to_pylist()
            found = [
                [dict(zip(("kind", "start", "end", "path"), row)) for row in scan(text)] for text in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(a, step).columns, pa.array(found, kind)], [*rest.schema.names, "findings"]
            )


def scan_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``findings``: kind, start, end and decoding path of each secret.

    Positions are code points of the whole text, end exclusive. A null or empty text
    has an empty list, repeated rows the same one each. An input column ``findings``
    gives way. Nothing is shuffled.
    """
    others = [c for c in df.columns if c not in (text, "findings")]
    source = df.select(*others, text_or_empty(text).alias("_text"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in others]
    return source.mapInArrow(_scanned_batches, ", ".join([*schema, f"findings {FINDING}"]))


def joined_spans(findings: Column) -> Column:
    """kind:start:end of the findings, comma-joined."""
    return F.array_join(
        F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )

