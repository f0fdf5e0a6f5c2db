"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every distinct shingle hash below a fixed fraction of the 64-bit range, so its size
follows the document and two sketches of very unequal documents still hold the same hashes of what
they share. A document with fewer than ``FLOOR`` such hashes keeps its ``FLOOR`` smallest ones (all,
if it has fewer), so short texts have a sketch as well. Sketches merge: the sketch of two texts
together is made of their sketches alone (``merge``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from tidemark.llm.text import arrow_schema, in_small_batches, slices, with_text, words
from tidemark.session import scratch_path

SHINGLE = 5
SEED = 0
# One hash in 16 is kept.
SCALE = 16
FLOOR = 48
_THRESHOLD = np.uint64(2**64 // SCALE)
_ALL = np.uint64(2**64 - 1)


def normalise(hashes: np.ndarray) -> np.ndarray:
    """A sketch from distinct sorted hashes: those below the threshold, or else the smallest ones."""
    below = int(np.searchsorted(hashes, _THRESHOLD))
    return hashes[: max(below, FLOOR)]


def sketch(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes kept of a text; words are lower-cased in A-Z; none without a word.

    A text of fewer words than a shingle has one shingle, the whole sequence.
    """
    tokens = words(text.encode().lower())
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) > shingle:
        grams = map(b" ".join, zip(*(tokens[k:] for k in range(shingle)), strict=False))
    else:
        grams = [b" ".join(tokens)]
    hashes = np.frombuffer(b"".join(map(xxh64_digest, grams, repeat(SEED))), ">u8").astype(np.uint64)
    kept = hashes[hashes < _THRESHOLD]
    kept = np.unique(kept)
    return kept if len(kept) >= FLOOR else normalise(np.unique(hashes))


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return normalise(np.union1d(a, b))


def _covered(kept: np.ndarray) -> np.uint64:
    """Every shingle hash up to this value is in the sketch."""
    if len(kept) < FLOOR:
        return _ALL
    return max(kept[-1], _THRESHOLD - np.uint64(1))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller shingle set that the other one holds: 0 to 1.

    Both sketches are read up to the hash that both cover. Two empty sketches are alike (1), an empty
    and another one are not (0); so are two that share no covered range with any hash in it.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    limit = min(_covered(a), _covered(b))
    a, b = (s[: int(np.searchsorted(s, limit, side="right"))] for s in (a, b))
    smaller = min(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / smaller if smaller else 0.0


def to_bytes(kept: np.ndarray) -> bytes:
    """Eight bytes for each hash, ascending, the highest byte first."""
    return kept.astype(">u8").tobytes()


def from_string(digits: str) -> np.ndarray:
    """The sketch that the hex digits of a fingerprint stand for."""
    return np.frombuffer(bytes.fromhex(digits), ">u8").astype(np.uint64)


def edited(text: str, following: str) -> str:
    """``text`` whose last third is replaced by as much of the beginning of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
# Between the two passes the edited sketch is kept as what it shares with the other one, a bit for each
# hash of that, and the hashes that it has besides.
_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 binary, kept binary, shared binary, added binary, "
    "near_edited double, near_next double"
)
_STAGED = f"{_COMPARED}, part int, role string, text string"


def _compared(doc_id, text: str, kept: np.ndarray, following: str, kept_following: np.ndarray) -> tuple:
    changed = edited(text, following)
    kept_changed = sketch(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).digest(),
        to_bytes(kept),
        np.packbits(np.isin(kept, kept_changed, assume_unique=True)).tobytes(),
        to_bytes(np.setdiff1d(kept_changed, kept, assume_unique=True)),
        containment(kept, kept_changed),
        containment(kept, kept_following),
    )


def _in_full(doc_id, n_chars, sha: bytes, kept: bytes, shared: bytes, added: bytes, *near) -> tuple:
    hashes = np.frombuffer(kept, ">u8")
    both = hashes[np.unpackbits(np.frombuffer(shared, np.uint8), count=len(hashes)).astype(bool)]
    changed = np.sort(np.concatenate([both, np.frombuffer(added, ">u8")]))
    return doc_id, n_chars, sha.hex(), kept.hex(), to_bytes(changed).hex(), *near


_CHUNK = 256


def _walk(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of one sorted partition, each compared with the next; its first and last stay open."""
    before = None
    for part, doc_id, text in rows:
        kept = sketch(text)
        if before is None:
            yield (doc_id, *[None] * 7, part, "first", text)
        else:
            yield (*_compared(*before, text, kept), part, "done", None)
        before = (doc_id, text, kept)
    if before is not None:
        yield (before[0], *[None] * 7, part, "last", before[1])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= _CHUNK:
            yield flush()
    if held:
        yield flush()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)), strict=True)


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how near to it this and the next one are.

    Fingerprints are hex digits, 16 for each hash.

    The next document is the one after it by descending ``doc_id`` (nulls last, equal ids by a hash of
    the text);
    the last one's is the first. An only document is its own next one. Null texts are empty. An
    empty table gives an empty result.

    Documents are range-sorted once. Each partition is walked through in order; only its first and
    last document are written out with their text, two rows for each partition, and paired after.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ordered = with_text(docs, ["doc_id"]).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    staged = arrow_schema(_STAGED)
    compared, result = arrow_schema(_COMPARED), arrow_schema(_RESULT)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (c for batch in batches for c in slices(batch))
        rows = (row for c in found for row in zip(c["part"], c["doc_id"], c["text"], strict=True))
        yield from _batches(_walk(rows), staged)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (_compared(d, t, sketch(t), f, sketch(f)) for d, t, f in _rows(batches))
        yield from _batches(rows, compared)

    def in_full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((_in_full(*row) for row in _rows(batches)), result)

    path = scratch_path(docs.sparkSession, "fingerprints")
    walked = in_small_batches(numbered).mapInArrow(walk, _STAGED)
    walked.write.option("compression", "zstd").parquet(path)
    walked = docs.sparkSession.read.schema(walked.schema).parquet(path)
    ends = walked.where("role != 'done'")
    # One row for each partition that has rows: the place of the next one in the ring of partitions.
    parts = ends.where("role = 'last'").select("part")
    ring = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = parts.select("part", F.coalesce(F.lead("part").over(ring), F.first("part").over(whole)).alias("next_part"))
    first = ends.where("role = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    open_rows = ends.where("role = 'last'").select("part", "doc_id", "text").join(after, "part").join(first, "next_part")
    paired = open_rows.select("doc_id", "text", "following").mapInArrow(pair, _COMPARED)
    done = walked.where("role = 'done'").select(*compared.names)
    return done.unionByName(paired).mapInArrow(in_full, _RESULT)
