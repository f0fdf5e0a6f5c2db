"""Fill-in-the-middle by secondary sort: pieces keyed by document and output position.

A text is cut into prefix, middle and suffix by its document's hash and written in an order in which
the middle comes last. Nothing but the reading of a row holds a whole text: ``pieces`` emits the output
as chunks of at most ``CHUNK`` code points, each with its place in the output; one shuffle by document,
sorted by place within the partitions, brings them together; a walk over the sorted rows feeds digests
and a parser chunk by chunk. The parser sees the output string alone (and its form), finds the marks and
gives the sections back as chunks, which a second sort within the same partition puts into the order of
the text, where the next walk restores it.

Documents are told apart by id and content, so the key of a piece does not depend on the order in which
a retried task reads its rows. Equal rows have equal pieces: the walk takes one copy and counts the rest.
The number of the task that cut them is part of the key, which spreads a text that a third of all rows
repeat; the copies in one task stay together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tidemark.llm.text import arrow_schema, in_small_batches, map_slices, with_text

CHUNK = 32_768
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PLAIN_FROM, SPM_BELOW = 90, 20

# The marks of a form in output order, each with the section behind it: 0 prefix, 1 middle, 2 suffix.
_ORDER = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

_KEY = ["doc_id", "content", "task"]
_PIECES = (
    "doc_id long, content binary, task int, place int, form string, n long, "
    "prefix_chars long, middle_chars long, piece string"
)
_SECTIONS = (
    "doc_id long, content binary, task int, section int, place int, form string, n long, "
    "prefix_chars long, middle_chars long, output_sha256 string, copies long, piece string"
)
_DIGESTS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
)
_TEXTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def plan(doc_id: int | None, text: str) -> tuple[str, int | None, int | None]:
    """``form, prefix_chars, middle_chars`` of a document; a null id counts as an empty string."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= PLAIN_FROM:
        return "plain", None, None
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return "spm" if h4 % 100 < SPM_BELOW else "psm", a, b - a


def output_chunks(text: str, form: str, prefix: int | None, middle: int | None) -> Iterator[str]:
    """The output of a document in chunks; a plain empty text is one empty chunk."""
    if form == "plain":
        parts = [("", 0, len(text))]
    else:
        end = prefix + middle
        bounds = ((0, prefix), (prefix, end), (end, len(text)))
        parts = [(mark, *bounds[section]) for mark, section in _ORDER[form]]
    for mark, start, end in parts:
        yield mark + text[start : min(end, start + CHUNK)]
        for at in range(start + CHUNK, end, CHUNK):
            yield text[at : min(end, at + CHUNK)]


def pieces(docs: DataFrame) -> DataFrame:
    """The outputs of all rows of ``docs`` (``doc_id``, ``text``) as placed chunks.

    A null text counts as empty; a null ``doc_id`` hashes as ``1:``; repeated rows have equal pieces;
    an empty table has none; other columns are left out. The first piece (place 0) of an output also
    carries its form and lengths.
    """
    names = arrow_schema(_PIECES).names

    def run(columns: dict[str, list]):
        task = TaskContext.get().partitionId()
        out: list[tuple] = []
        size = 0
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            form, prefix, middle = plan(doc_id, text)
            content = xxh3_128_digest(text.encode())
            for place, chunk in enumerate(output_chunks(text, form, prefix, middle)):
                first = (form, len(text), prefix, middle) if place == 0 else (None,) * 4
                out.append((doc_id, content, task, place, *first, chunk))
                size += len(chunk)
                if size > 4_000_000:
                    yield dict(zip(names, zip(*out, strict=True), strict=True))
                    out, size = [], 0
        if out:
            yield dict(zip(names, zip(*out, strict=True), strict=True))

    return map_slices(with_text(docs, ["doc_id"]), run, _PIECES)


class Parser:
    """Finds the marks of an output that arrives in chunks, and gives its sections in chunks."""

    def __init__(self, form: str):
        self.marks = list(_ORDER.get(form, ()))
        self.section = 0
        self.held = ""

    def feed(self, chunk: str) -> Iterator[tuple[int, str]]:
        self.held += chunk
        while self.marks:
            mark, section = self.marks[0]
            at = self.held.find(mark)
            if at < 0:
                # The end may be the beginning of a mark.
                keep = len(mark) - 1
                yield self.section, self.held[:-keep]
                self.held = self.held[-keep:]
                return
            yield self.section, self.held[:at]
            self.held = self.held[at + len(mark) :]
            self.section = section
            self.marks.pop(0)
        yield self.section, self.held
        self.held = ""


def _sorted(df: DataFrame, *order: str) -> DataFrame:
    return in_small_batches(df.sortWithinPartitions(*_KEY, *order))


def _rows(batches: Iterator[pa.RecordBatch], most: int = 256) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, most).columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, text: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most 1,000 rows or about 4 million characters."""
    out: list[tuple] = []
    size = 0

    def batch():
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        out.append(row)
        size += len(row[text]) if text is not None and row[text] else 0
        if len(out) >= 1000 or size > 4_000_000:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def _walk(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted pieces: digest each output and take it apart again."""
    key = parser = None
    for doc_id, content, task, place, form, n, prefix, middle, piece in rows:
        if (doc_id, content, task) != key:
            if key is not None:
                yield (*key, -1, 0, *first, digest.hexdigest(), copies, None)
            key, first = (doc_id, content, task), (form, n, prefix, middle)
            digest, parser, copies, last, seq = hashlib.sha256(), Parser(form), 0, -1, 0
        if place == 0:
            copies += 1
        if place == last:
            continue
        last = place
        digest.update(piece.encode())
        for section, chunk in parser.feed(piece):
            if chunk:
                yield (*key, section, seq, *(None,) * 4, None, None, chunk)
                seq += 1
    if key is not None:
        yield (*key, -1, 0, *first, digest.hexdigest(), copies, None)


def _restore(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sections sorted into the order of the text: digest what was restored."""
    head = digest = None
    for doc_id, _, _, section, _, form, n, prefix, middle, output_sha256, copies, piece in rows:
        if section == -1:
            if head is not None:
                yield from (head[:-1] + (digest.hexdigest(),) for _ in range(head[-1]))
            head, digest = (doc_id, n, form, prefix, middle, output_sha256, copies), hashlib.sha256()
        else:
            digest.update(piece.encode())
    if head is not None:
        yield from (head[:-1] + (digest.hexdigest(),) for _ in range(head[-1]))


def digests(placed: DataFrame) -> DataFrame:
    """One row per document: its form and lengths, the digest of its output and of the text restored from it.

    One shuffle; the second sort stays within the partitions of the first.
    """
    apart, together = arrow_schema(_SECTIONS), arrow_schema(_DIGESTS)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_walk(_rows(batches)), apart, 11)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_restore(_rows(batches)), together)

    sections = _sorted(placed.repartition(*_KEY), "place").mapInArrow(walk, _SECTIONS)
    return _sorted(sections, "section", "place").mapInArrow(restore, _DIGESTS)


def _join(rows: Iterator[tuple]) -> Iterator[tuple]:
    key = None
    for doc_id, content, task, place, form, n, prefix, middle, piece in rows:
        if (doc_id, content, task) != key:
            if key is not None:
                yield from ((*first, "".join(parts)) for _ in range(copies))
            key, first, parts, copies = (doc_id, content, task), (doc_id, n, form, prefix, middle), [], 0
        if place == 0:
            copies += 1
        if place == len(parts):
            parts.append(piece)
    if key is not None:
        yield from ((*first, "".join(parts)) for _ in range(copies))


def outputs(placed: DataFrame) -> DataFrame:
    """One row per document with its whole output as a string (a text must fit a row, as it did before)."""
    schema = arrow_schema(_TEXTS)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_join(_rows(batches)), schema, 5)

    return _sorted(placed.repartition(*_KEY), "place").mapInArrow(join, _TEXTS)
