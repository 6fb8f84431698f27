"""Secret scan with a recursive decoding worklist.

A text is scanned as it is. Then everything in it that reads as an encoding is unwrapped into
a layer of its own, each layer is scanned and unwrapped in turn, and a layer whose content was
seen before in the same document is not entered again, so the work ends at a fixpoint.

Unwrapped are: percent escapes, Unicode and hexadecimal escapes, base64 in both alphabets, also
wrapped over lines or begun behind other signs, and gzip, zlib, bzip2, xz and bare deflate streams, all members of them,
found inside base64 or, but for bare deflate, written as escaped bytes. Bytes that are no text are read byte by byte where they have a printable stretch that
could hold a secret, and as UTF-16 where every other byte is zero. Every layer carries, for each of its
characters, the part of the document it came from: one escape for an unescaped character,
the group of four signs for a base64 byte, the whole stream for a compressed one. A secret
found in a layer is reported with the span of the document that its characters came from.

Kinds, leftmost and non-overlapping per kind, offsets in code points, end exclusive:
``assign`` a keyword with a value of six signs or more, ``access`` a key id of 20 signs or
more, ``hex`` 24 hexadecimal digits or more. Too short matches are consumed and dropped.

A compressed stream that unpacks to more than ``LAYER_BYTES`` is a bomb: it is unpacked up to
there, which bounds a worker's memory, and the document is flagged ``truncated``; so it is where an xz stream wants a
dictionary of more than ``DICTIONARY_BYTES`` and is not unpacked.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .tables import map_rows, map_text

KINDS = ("assign", "access", "hex")
LAYER_BYTES = 64 << 20
DICTIONARY_BYTES = 256 << 20
# The shortest text with a secret.
SHORTEST = "token=abcdef"

# The base patterns.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of digits is matched whole or not at all, so asking for its length at once drops no match.
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})+")
ONE_ESCAPE = re.compile(r"\\(?:u\{([0-9A-Fa-f]+)\}|[uxU]([0-9A-Fa-f]+))")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
# A run that goes on in the next lines; begun only where a run begins, so a long one is read once.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{8,}+(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)+={0,2}")
SIGNS = re.compile(r"[A-Za-z0-9+/_=-]+")
# The shortest secret or nested run has so many signs.
STRETCH = re.compile(rb"[ -~]{12}")
# Compressed bytes written as escapes: their first bytes, and how far they may go.
ONE_PERCENT = re.compile(r"%[0-9A-Fa-f]{2}|.", re.DOTALL)
ONE_BYTE = re.compile(r"\\x[0-9A-Fa-f]{2}|\\.|.", re.DOTALL)
PERCENT_STREAM = re.compile(r"(?:%1[Ff]%8[Bb]|(?:x|%78)(?:%(?:01|5[Ee]|9[Cc]|[Dd][Aa])|\^)|BZh|%42%5[Aa]%68|%[Ff][Dd](?:7zXZ|%37%7[Aa]%58%5[Aa])%00)(?:%[0-9A-Fa-f]{2}|[!#$&(-;=?-~])*+")
BYTE_STREAM = re.compile(
    r"(?:\\x1[Ff]\\x8[Bb]|(?:x|\\x78)(?:\\x(?:01|5[Ee]|9[Cc]|[Dd][Aa])|\^)|BZh|\\x42\\x5[Aa]\\x68|\\x[Ff][Dd](?:7zXZ|\\x37\\x7[Aa]\\x58\\x5[Aa])\\x00)"
    r"(?:\\x[0-9A-Fa-f]{2}|\\[nrtabfv0\\'\"]|[\x20!#-&(-\[\]-~])*+"
)

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_spans long, n_layers long, truncated boolean"
)

Span = tuple[int, int, int]  # start, kind's place in KINDS, end
# A layer's characters and the start and end in the document of what each came from.
Layer = tuple[str, np.ndarray, np.ndarray]


def matches(text: str) -> list[Span]:
    """Spans of one text by itself."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


class Worklist:
    """All layers of one document."""

    def __init__(self, text: str, layer_bytes: int = LAYER_BYTES):
        self.text = text
        self.layer_bytes = layer_bytes
        self.truncated = False
        self.layers = 0
        # What the last stream left of its bytes.
        self.rest = b""

    def spans(self) -> tuple[list[Span], list[Span]]:
        """Spans of the text itself, and those spans with the ones its layers add."""
        base = matches(self.text)
        every = set(base)
        seen = {digest(self.text)}
        todo = list(self.unwrapped(self.text, None))
        while todo:
            layer = todo.pop()
            text, starts, ends = layer
            mark = digest(text), int(starts[0]), int(ends[-1])
            if mark in seen:
                continue
            seen.add(mark)
            self.layers += 1
            for start, kind, end in matches(text):
                every.add((int(starts[start:end].min()), kind, int(ends[start:end].max())))
            todo += self.unwrapped(text, layer)
        return base, sorted(every)

    def unwrapped(self, text: str, parent: Layer | None) -> Iterator[Layer]:
        """The layers one step below ``text``, with the places their characters came from."""
        if "%" in text:
            yield from self.rewritten(text, parent, PERCENT, percent)
            for m in PERCENT_STREAM.finditer(text):
                if "%" in m[0]:
                    yield from self.from_escaped(unquote_to_bytes(m[0]), m, ONE_PERCENT, parent)
        if "\\" in text:
            yield from self.rewritten(text, parent, ESCAPE, escapes)
            for m in BYTE_STREAM.finditer(text):
                if "\\x" in m[0]:
                    yield from self.from_escaped(codecs.escape_decode(m[0])[0], m, ONE_BYTE, parent)
        for m in BASE64.finditer(text):
            # Signs before a run, as in ``v1/`` or ``id-``, belong to the alphabet and shift its groups.
            for first in range(4):
                yield from self.from_base64(m[0][first:], np.arange(m.start() + first, m.end()), parent)
        if "\n" in text:
            for m in WRAPPED.finditer(text):
                lines = list(SIGNS.finditer(text, m.start(), m.end()))
                # A first line of another width may be a word before the run.
                for first in (0, 1) if len(lines) > 2 and len(lines[0][0]) != len(lines[1][0]) else (0,):
                    at = np.concatenate([np.arange(x.start(), x.end()) for x in lines[first:]])
                    yield from self.from_base64("".join(x[0] for x in lines[first:]), at, parent)

    def rewritten(self, text: str, parent: Layer | None, pattern: re.Pattern, decode) -> Iterator[Layer]:
        """The whole text with its escapes replaced, if it has any."""
        out, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(text):
            out.append(text[at : m.start()])
            starts.append(np.arange(at, m.start()))
            ends.append(np.arange(at + 1, m.start() + 1))
            for character, a, b in decode(m[0]):
                out.append(character)
                starts.append(np.array([m.start() + a]))
                ends.append(np.array([m.start() + b]))
            at = m.end()
        if at:
            out.append(text[at:])
            starts.append(np.arange(at, len(text)))
            ends.append(np.arange(at + 1, len(text) + 1))
            yield mapped("".join(out), np.concatenate(starts), np.concatenate(ends), parent)

    def from_escaped(self, raw: bytes, m: re.Match, one: re.Pattern, parent: Layer | None) -> Iterator[Layer]:
        """What a stream written as escapes holds; what stands behind the stream is no part of it."""
        if self.inflated(raw) is None:
            return
        used = len(raw) - len(self.rest)
        ends = [x.end() for x in one.finditer(m[0])]
        yield from self.from_stream(raw[:used], m.start(), m.start() + ends[used - 1], parent)

    def from_stream(self, raw: bytes, start: int, end: int, parent: Layer | None) -> Iterator[Layer]:
        """What a compressed stream holds, if the bytes are one; all of it comes from the whole stretch."""
        unpacked = self.unpacked(raw)
        text = (unpacked or b"").decode("utf-8", "replace")
        if text:
            if parent is not None:
                start, end = parent[1][start], parent[2][end - 1]
            # One value seen len(text) times, so a large stream takes no more than its text.
            yield text, *(np.broadcast_to(np.int64(edge), len(text)) for edge in (start, end))

    def from_base64(self, run: str, at: np.ndarray, parent: Layer | None) -> Iterator[Layer]:
        """The layers of a run whose signs stand at the places ``at``."""
        raw = base64_bytes(run)
        if raw is None:
            return
        if self.unpacked(raw) is not None:
            yield from self.from_stream(raw, int(at[0]), int(at[-1]) + 1, parent)
            return
        text = readable(raw)
        if text is not None:
            widths = np.array([len(c.encode()) for c in text]) if not text.isascii() else np.ones(len(text), dtype=np.int64)
            yield placed(text, np.cumsum(widths) - widths, np.cumsum(widths), at, parent)
            return
        # Every byte, and those beside zeros, as a character of its own; the patterns are ASCII.
        for first, step in ((0, 1), (0, 2), (1, 2)):
            part = raw[first::step]
            if step == 2 and raw[1 - first :: 2].count(0) * 2 < len(raw) // 2:
                continue
            if STRETCH.search(part):
                begin = np.arange(first, len(raw), step)
                yield placed(part.decode("latin-1"), begin, begin + 1, at, parent)

    def unpacked(self, raw: bytes) -> bytes | None:
        """The content of a compressed stream and of streams stacked inside it; None if it is none."""
        out = None
        seen = set()
        while raw not in seen:
            seen.add(raw)
            inner = self.inflated(raw)
            if inner is None:
                break
            out = raw = inner
        return out

    def inflated(self, raw: bytes) -> bytes | None:
        """The content of all members of a compressed stream; None if the first is none."""
        out = None
        while raw:
            try:
                machine = machine_of(raw)
                if machine is None:
                    break
                room = self.layer_bytes - len(out or b"")
                out = (out or b"") + machine.decompress(raw, room)
            except lzma.LZMAError as error:
                # A dictionary beyond DICTIONARY_BYTES is a bomb, too.
                self.truncated |= "emory" in str(error)
                break
            except (zlib.error, OSError, EOFError, ValueError):
                break
            if len(out) >= self.layer_bytes:
                self.truncated, self.rest = True, b""
                break
            # Members may be followed by zeros.
            self.rest = machine.unused_data
            raw = self.rest.lstrip(b"\x00")
        return self.deflated(raw) if out is None else out

    def deflated(self, raw: bytes) -> bytes | None:
        """The content of a deflate stream without any header; only a whole one that holds a text counts, as nothing else tells."""
        machine = zlib.decompressobj(-15)
        try:
            out = machine.decompress(raw, self.layer_bytes)
        except zlib.error:
            return None
        if not machine.eof or machine.unused_data or len(out) < len(SHORTEST) or readable(out) is None:
            return None
        self.rest = b""
        return out


def machine_of(raw: bytes):
    """What unpacks the stream that begins here."""
    if raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and len(raw) > 5 and int.from_bytes(raw[:2]) % 31 == 0):
        return zlib.decompressobj(47)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor(memlimit=DICTIONARY_BYTES) if raw[:6] == b"\xfd7zXZ\x00" else None


def placed(text: str, begin: np.ndarray, end: np.ndarray, at: np.ndarray, parent: Layer | None) -> Layer:
    """A layer of characters that are the bytes from ``begin`` to ``end`` of a base64 run with signs ``at``."""
    first = at[4 * (begin // 3)]
    after = at[np.minimum(4 * ((end - 1) // 3) + 3, len(at) - 1)] + 1
    return mapped(text, first, after, parent)


def digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def mapped(text: str, starts: np.ndarray, ends: np.ndarray, parent: Layer | None) -> Layer:
    """Places within the parent layer turned into places within the document."""
    if parent is None:
        return text, starts, ends
    return text, parent[1][starts], parent[2][ends - 1]


def percent(run: str) -> Iterator[tuple[str, int, int]]:
    """Characters of a run of percent escapes, and the escapes each came from."""
    raw = bytes.fromhex(run.replace("%", ""))
    at = 0
    for character in raw.decode("utf-8", "replace"):
        width = len(character.encode()) if character != "�" or raw[at : at + 3] == b"\xef\xbf\xbd" else 1
        yield character, 3 * at, min(3 * (at + width), len(run))
        at = min(at + width, len(raw) - 1)


def escapes(run: str) -> Iterator[tuple[str, int, int]]:
    """Characters of a run of backslash escapes; surrogate halves are joined."""
    held = None
    for m in ONE_ESCAPE.finditer(run):
        code = int(m[1] or m[2], 16)
        if held and 0xDC00 <= code < 0xE000:
            yield chr(0x10000 + ((held[0] - 0xD800) << 10) + code - 0xDC00), held[1], m.end()
            held = None
            continue
        if held:
            yield "�", held[1], held[2]
        held = (code, m.start(), m.end()) if 0xD800 <= code < 0xDC00 else None
        if held is None:
            yield chr(code) if code < 0x110000 and not 0xDC00 <= code < 0xE000 else "�", m.start(), m.end()
    if held:
        yield "�", held[1], held[2]


def base64_bytes(run: str) -> bytes | None:
    """The bytes of a base64 run of either alphabet; a last incomplete group is left out."""
    body = run.rstrip("=")
    body = body.replace("-", "+").replace("_", "/")
    rest = len(body) % 4
    if rest == 1:
        body = body[:-1]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None


def readable(raw: bytes) -> str | None:
    """The text of the bytes, if they are UTF-8 without control characters other than white space."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and not CONTROL.search(text) else None


CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


def scan_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    for doc_id, text in rows:
        work = Worklist(text or "")
        base, every = work.spans()
        counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
        sha = hashlib.sha256(named(base).encode()).hexdigest()
        yield doc_id, *counts, sha, named(every), len(every), work.layers, work.truncated


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: base counts, a digest of the base spans, and all spans as text.

    A null text counts as empty. Repeated rows and null ids are rows like others; equal spans of
    a kind found in several layers are one span; other columns are not read.
    """
    return map_rows(docs.select("doc_id", "text"), scan_rows, SCHEMA)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by a mark; overlapping spans by one mark.

    Documents without a secret, null texts included, come out as they are. ``n_chars``, where
    there is such a column, is the length of the new text.
    """
    columns = docs.columns

    def redacted(text: str | None) -> str | None:
        """Null where nothing changes, so most texts travel one way only."""
        every = Worklist(text).spans()[1] if text else []
        return masked(text, every, mark) if every else None

    out = docs.withColumn("text", F.coalesce(map_text(docs, "text", redacted), "text"))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("text").isNotNull(), F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed)
    return out.select(*columns)


def masked(text: str, spans: list[Span], mark: str) -> str:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]
