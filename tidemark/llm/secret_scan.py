"""Secrets in text, under any number of encodings.

A worklist holds layers of a document: its text, and whatever unwraps from a layer. Percent runs and
Unicode escapes are decoded in place, giving the whole layer anew; runs of base64 give layers of
their own, and so does what is compressed (gzip, zlib) anywhere in one. Every layer is scanned like the
text itself. A layer knows for each of its characters which code points of the document it came from,
so what is found there is reported in places of the document: exact for decoding in place, whole
groups of four for base64, the whole stream for compressed data. A layer that was met before, with the
same content from the same place, is not unwrapped again; that ends cycles, such as an archive that
holds itself. Decoding in place and base64 shorten, and zlib's expansion is bounded by its format
(about 1,000 times), so no limit is set on depth or size.

Decoded bytes are kept as one character each. Secrets and wrappings are ASCII, which reads the same so
in every 8-bit code and in UTF-8, and compressed data stays whole. What stands before a blob may belong
to the alphabet of base64 and shift its groups of four, so a run is decoded from each of its first four
characters; lines that only a line end separates are one run.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.text import at_work, in_small_batches, map_slices, sha256_hex, with_text

KINDS = ("assign", "access", "hex")
_RANK = {kind: k for k, kind in enumerate(KINDS)}
MIN_VALUE = 12
MIN_BASE64 = 16

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
# In lower case, one of these is in every assignment.
_ASSIGN_HINTS = ("passw", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPES = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
_DIGIT = "[A-Za-z0-9+/_-]"
_LINE_END = r"[ \t]*+\r?\n[ \t]*+"
_BASE64 = re.compile(
    rf"(?<!{_DIGIT})(?:{_DIGIT}{{{MIN_BASE64},}}+|{_DIGIT}++(?={_LINE_END}{_DIGIT}))(?:{_LINE_END}{_DIGIT}++)*+"
)
_DIGITS = re.compile(f"{_DIGIT}+")
_STANDARD = str.maketrans("-_", "+/")
# What a gzip or zlib stream begins with.
_MAGIC = re.compile("\x1f\x8b\x08|x[\x01\x5e\x9c\xda]")
# No secret and no wrapping of one is shorter than this, and all are of these characters.
_TELLING = re.compile(r"[\t\n\r\x20-\x7e]{%d}" % MIN_BASE64)
_WIDE = re.compile("[^\x00-\xff]")


class Found(NamedTuple):
    """A secret: its kind, its place, and the place of the value itself, in code points."""

    start: int
    rank: int
    end: int
    value_start: int
    value_end: int

    def label(self) -> str:
        return f"{KINDS[self.rank]}:{self.start}:{self.end}"


def scan(text: str) -> list[Found]:
    """Secrets that stand openly in a text, leftmost without overlap for each kind, by start and kind."""
    found = []
    lower = text.lower()
    if any(hint in lower for hint in _ASSIGN_HINTS):
        for m in _ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= MIN_VALUE:
                found.append(Found(m.start(), _RANK["assign"], m.end(), m.start(1), m.end(1)))
    if "AKIA" in text:
        found += [Found(m.start(), _RANK["access"], m.end(), m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [Found(m.start(), _RANK["hex"], m.end(), m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


class Layer(NamedTuple):
    """Decoded text; ``starts`` and ``ends`` give the document's code points behind each character."""

    text: str
    starts: np.ndarray
    ends: np.ndarray

    def place(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def _percent_decoded(run: str) -> list[tuple[str, int]]:
    """The bytes of a percent run as characters, and how many characters of the run each took."""
    return [(c, 3) for c in bytes.fromhex(run.replace("%", "")).decode("latin-1")]


def _escapes_decoded(run: str) -> list[tuple[str, int]]:
    """Characters of a run of escapes; U+FFFD for half a surrogate pair and for what is no code point."""
    out: list[tuple[str, int]] = []
    high = None
    for m in _ESCAPE.finditer(run):
        code, width = int(m[1] or m[2] or m[3], 16), m.end() - m.start()
        if high is not None and 0xDC00 <= code < 0xE000:
            before = out.pop()[1]
            out.append((chr(0x10000 + ((high - 0xD800) << 10) + code - 0xDC00), before + width))
            high = None
            continue
        high = code if 0xD800 <= code < 0xDC00 else None
        out.append(("\ufffd" if 0xD800 <= code < 0xE000 or code > 0x10FFFF else chr(code), width))
    return out


def _decoded_in_place(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every run decoded; None if there is none."""
    texts, starts, ends = [], [], []
    at = 0
    for m in pattern.finditer(layer.text):
        made = decode(m[0])
        kept = slice(at, m.start())
        texts.append(layer.text[kept])
        starts.append(layer.starts[kept])
        ends.append(layer.ends[kept])
        begins = m.start() + np.cumsum([0, *(n for _, n in made)])
        texts.append("".join(c for c, _ in made))
        starts.append(layer.starts[begins[:-1]])
        ends.append(layer.ends[begins[1:] - 1])
        at = m.end()
    if not texts:
        return None
    texts.append(layer.text[at:])
    return Layer("".join(texts), np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*ends, layer.ends[at:]]))


_PROBE = 64 * 1024
_STEP = 64


def _inflated(data: bytes) -> tuple[bytes, int]:
    """What comes out of the stream that data begins with, and how much of data it took.

    All members of a gzip file count; a stream that is cut off or damaged gives what stands before,
    to the nearest ``_STEP`` bytes.
    """
    out, at = [], 0
    while at == 0 or data[at : at + 3] == b"\x1f\x8b\x08":
        stream = zlib.decompressobj(47)
        try:
            while not stream.eof and at < len(data):
                part = data[at : at + _STEP]
                out.append(stream.decompress(part))
                at += len(part) - len(stream.unused_data)
        except zlib.error:
            at = min(len(data), at + _STEP)
            break
        if not stream.eof:
            break
    return b"".join(out), at


def _decompressed(data: bytes) -> bytes | None:
    if _MAGIC.match(data[:3].decode("latin-1")):
        return _inflated(data)[0] or None
    return None


def _unpacked(data: bytes) -> tuple[bytes, bool]:
    """Data without its compressed wrappings, and whether there were any."""
    seen = set()
    while (inner := _decompressed(data)) is not None:
        digest = hashlib.sha256(data).digest()
        if digest in seen:
            break
        seen.add(digest)
        data = inner
    return data, bool(seen)


def _runs(text: str) -> Iterator[np.ndarray]:
    """Places of the digits of each run of base64: lines joined, and alone where no encoder broke them."""
    for m in _BASE64.finditer(text):
        lines = [np.arange(*d.span()) for d in _DIGITS.finditer(text, *m.span())]
        digits = lines[0] if len(lines) == 1 else np.concatenate(lines)
        if len(digits) < MIN_BASE64:
            continue
        yield digits
        sizes = {len(line) for line in lines[:-1]}
        if len(lines) > 1 and (len(sizes) > 1 or sizes.pop() % 4 or len(lines[-1]) > len(lines[0])):
            yield from (line for line in lines if len(line) >= MIN_BASE64)


def _from_base64(text: str, digits: np.ndarray) -> Iterator[tuple[np.ndarray, str]]:
    """The bytes of a run, as characters, from each of its first four digits, where they may tell something."""
    first, last = int(digits[0]), int(digits[-1]) + 1
    run = text[first:last]
    if last - first != len(digits):
        run = "".join(_DIGITS.findall(run))
    run = run.translate(_STANDARD)
    for k in range(4):
        size = len(run) - k - ((len(run) - k) % 4 == 1)
        made = base64.b64decode(run[k : k + size] + "=" * (-size % 4)).decode("latin-1")
        if _TELLING.search(made) or _MAGIC.search(made):
            yield digits[k : k + size], made


def _base64_layers(layer: Layer) -> Iterator[Layer]:
    for run in _runs(layer.text):
        for digits, made in _from_base64(layer.text, run):
            byte = np.arange(len(made))
            first, last = digits[byte // 3 * 4], digits[np.minimum(byte // 3 * 4 + 3, len(digits) - 1)]
            yield Layer(made, layer.starts[first], layer.ends[last])


def _compressed_layers(layer: Layer) -> Iterator[Layer]:
    for m in _MAGIC.finditer(layer.text):
        start = m.start()
        wide = _WIDE.search(layer.text, start)
        end = wide.start() if wide else len(layer.text)
        # Most of what looks like the head of a stream is none, which a small part tells.
        if not _inflated(layer.text[start : min(end, start + _PROBE)].encode("latin-1"))[0]:
            continue
        data, used = _inflated(layer.text[start:end].encode("latin-1"))
        text = _unpacked(data)[0].decode("latin-1")
        if _TELLING.search(text) or _MAGIC.search(text):
            begin, finish = layer.place(start, start + used)
            yield Layer(text, np.full(len(text), begin), np.full(len(text), finish))


def _children(layer: Layer) -> Iterator[Layer]:
    if "%" in layer.text:
        made = _decoded_in_place(layer, _PERCENT, _percent_decoded)
        if made is not None:
            yield made
    if "\\" in layer.text:
        made = _decoded_in_place(layer, _ESCAPES, _escapes_decoded)
        if made is not None:
            yield made
    yield from _compressed_layers(layer)
    yield from _base64_layers(layer)


_WRAPPED = re.compile(r"%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f]{2}")


def _may_unwrap(text: str) -> bool:
    """Whether anything in a text decodes, told without the maps of places."""
    if _WRAPPED.search(text) or _MAGIC.search(text):
        return True
    return any(True for run in _runs(text) for _ in _from_base64(text, run))


def find(text: str) -> tuple[list[Found], list[Found]]:
    """Open secrets of a text, and those that only its layers show and that are not open already."""
    base = scan(text)
    if not _may_unwrap(text):
        return base, []
    n = len(text)
    top = Layer(text, np.arange(n), np.arange(1, n + 1))
    work, seen, deeper = [top], {_identity(top)}, set()
    while work:
        layer = work.pop()
        for child in _children(layer):
            key = _identity(child)
            if key in seen:
                continue
            seen.add(key)
            work.append(child)
            for f in scan(child.text):
                start, end = child.place(f.start, f.end)
                deeper.add(Found(start, f.rank, end, *child.place(f.value_start, f.value_end)))
    known = {(f.start, f.rank, f.end) for f in base}
    return base, sorted(f for f in deeper if (f.start, f.rank, f.end) not in known)


def _identity(layer: Layer) -> bytes:
    digest = hashlib.sha256(layer.text.encode())
    digest.update(layer.starts.astype(np.int64).tobytes())
    digest.update(layer.ends.astype(np.int64).tobytes())
    return digest.digest()


def _labels(found: list[Found]) -> str:
    return ",".join(dict.fromkeys(f.label() for f in sorted(found)))


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts of its open secrets, their digest, and the spans of all.

    ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_deeper``; places are code points, the
    end exclusive. A null text counts as empty and has none; repeated rows stay rows of their own; an
    empty table gives an empty result.
    """

    def run(columns: dict[str, list]):
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_deeper")}
        for text in columns["text"]:
            base, deeper = find(text)
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(f.rank == _RANK[kind] for f in base))
            out["base_sha256"].append(sha256_hex(_labels(base).encode()))
            out["spans"].append(_labels(base + deeper))
            out["n_deeper"].append(len(deeper))
        yield {"doc_id": columns["doc_id"], **out}

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_deeper long"
    return map_slices(with_text(docs, ["doc_id"]), run, schema)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with every secret value replaced; values that touch or overlap become one mark."""
    base, deeper = find(text)
    places = sorted((f.value_start, f.value_end) for f in base + deeper)
    out, at = [], 0
    for start, end in places:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced and ``n_chars`` counted anew; columns unchanged.

    Null texts stay null. No row is dropped and nothing is shuffled.
    """

    def run(batches):
        at_work(redact.__module__)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else redact(t) for t in batch.column(at).to_pylist()]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            counted = batch.schema.get_field_index("n_chars")
            if counted >= 0:
                field = batch.schema.field(counted)
                lengths = [None if t is None else len(t) for t in texts]
                batch = batch.set_column(counted, field, pa.array(lengths, field.type))
            yield batch

    return in_small_batches(docs).mapInArrow(run, docs.schema)
