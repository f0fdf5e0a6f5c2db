"""Packing along a space-filling curve: neighbouring documents share a sequence.

A document's token ids are hashed onto ``DIMENSIONS`` random directions; the projection is its place
in a small cube, and its index on the Hilbert curve through that cube (Skilling, "Programming the
Hilbert curve", 2004) is its key. Documents are range-sorted by key; each partition of the sorted
table is packed in order, documents cut wherever a sequence is full. What is left of a partition is
cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.byte_bpe import byte_characters
from tidemark.llm.merges import LONGEST, Merges
from tidemark.llm.text import Recent, arrow_schema, at_work, in_small_batches, map_slices, remembered_by, with_text
from tidemark.session import written

VOCABULARY = "word_bpe_49k.json"
# The vocabulary's own pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = 1
LENGTH = 2048
DIMENSIONS = 4
BITS = 12


# Capital sigma, and blocks with letters that are newer than Python's tables.
_BY_LIBRARY = re.compile("[Σ\u1c89\ua7cb-\ua7dc\U00010d50-\U00010d65\U00016ea0-\U00016eb8]")

# White space to the pattern that is not ASCII.
_SPACES = regex.compile(r"[\s--\x00-\x7f]", regex.VERSION1)
# Marks that often end a word, each a piece of its own behind letters.
_MARKS = frozenset(".,;:!?")
# So many new words are merged together; fewer are left to the library.
MANY = 2_000


class WordBpe:
    """Ids of whole texts, as the vocabulary's tokenizer gives them.

    No piece crosses white space, so what stands between is looked up; what is new is cut into letters,
    digits and marks as the vocabulary's pattern does (by the library, unless it is plain), and new
    pieces are merged by the library; where many texts bring many new words of letters, these are merged
    together (``merges``), as the library would. Texts are normalised whole (lower case, composed form): by Python
    where both agree, which is for composed texts without a capital sigma, whose lower case depends on
    its place; else by the library.
    """

    def __init__(self, path: str):
        whole = Tokenizer.from_file(path)
        self.normaliser = whole.normalizer
        self.cutter = whole.pre_tokenizer
        self.model = whole.model
        self.pattern = regex.compile(PATTERN)
        self.characters = {b: c for b, c in enumerate(byte_characters()) if chr(b) != c}
        self.words = Recent(self._word_ids)
        self.merges = Merges(path)

    def normalised(self, text: str) -> str:
        if text.isascii() or (not _BY_LIBRARY.search(text) and unicodedata.is_normalized("NFC", text)):
            return text.lower()
        return self.normaliser.normalize_str(text)

    def _merged(self, piece: str) -> bytes:
        """Ids of a piece, in the characters that stand for its bytes."""
        ids = [token.id for token in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}H", *ids)

    def _word_ids(self, word: str) -> bytes:
        if word.isalpha():
            return self._merged(word if word.isascii() else word.encode().decode("latin-1").translate(self.characters))
        if len(word) > 1 and word[-1] in _MARKS and word[:-1].isalpha():
            return self.words[word[:-1]] + self.words[word[-1]]
        if word.isascii():
            cut = [p.translate(self.characters) for p in self.pattern.findall(word)]
        else:
            cut = [piece for piece, _ in self.cutter.pre_tokenize_str(word)]
        return b"".join(map(self._merged, cut))

    def _spaced(self, text: str) -> str:
        """The normalised text, its words apart by ASCII white space."""
        text = self.normalised(text)
        return text if text.isascii() or not _SPACES.search(text) else " ".join(regex.split(r"\s+", text))

    def _known(self, word: str) -> bytes | None:
        ids = self.words.get(word)
        return self.words.older.get(word) if ids is None else ids

    def _learned(self, new: list[str]) -> dict[str, bytes]:
        """Ids of those of these words that are of letters, with or without marks behind, if there are many."""
        marked = [(w, stem) for w in new if not w.isalpha() and (stem := w.rstrip(punctuation)).isalpha()]
        stems = {stem: self._known(stem) for _, stem in marked}
        wanted = dict.fromkeys(filter(str.isalpha, new)) | {w: None for w, ids in stems.items() if ids is None}
        pieces = "\n".join(wanted).encode().split(b"\n")
        if len(pieces) < MANY or max(map(len, pieces)) > LONGEST or not self.merges.usable:
            return {}
        ids, counts = self.merges.merged(pieces)
        data, ends = ids.astype("<u2").tobytes(), (2 * np.cumsum(counts)).tolist()
        found = {w: data[i:k] for w, i, k in zip(wanted, [0, *ends], ends, strict=False)}
        # Marks behind letters are one piece.
        stems |= {w: found[w] for w in stems.keys() & found}
        return found | {w: stems[stem] + self.words[w[len(stem) :]] for w, stem in marked}

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found = list(map(self.words.get, words))
        older = self.words.older.get
        found = [older(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        learned = self._learned(new).get
        made = {w: self._word_ids(w) if (ids := learned(w)) is None else ids for w in new}
        found = [made[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
        self.words.put_all(dict(zip(words, found, strict=True)))
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 16-bit numbers, without special tokens."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. A word that occurs often is looked up once."""
        cut = pc.ascii_split_whitespace(pa.array([self._spaced(t) for t in texts], pa.large_string()))
        words = cut.flatten().dictionary_encode()
        found = self._ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(found), "<u2")
        lengths = np.array([len(f) // 2 for f in found], np.int64)
        starts, which = np.cumsum(lengths) - lengths, words.indices.to_numpy(zero_copy_only=False)
        n = lengths[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = ids[np.repeat(starts[which] - ends[:-1], n) + np.arange(ends[-1])]
        bounds = ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        return [ids[i:k] for i, k in zip(bounds, bounds[1:], strict=False)]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One tokenizer for each worker and file."""
    return WordBpe(path)


remembered_by(__name__, word_bpe.cache_clear)


@lru_cache(maxsize=1)
def _directions() -> np.ndarray:
    """For each id one random bit for each dimension, in a lane of 16 bits of one number."""
    mixed = np.arange(2**16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    lanes = np.zeros(2**16, np.uint64)
    for d in range(DIMENSIONS):
        lanes |= ((mixed >> np.uint64(63 - d)) & np.uint64(1)) << np.uint64(16 * d)
    return lanes


def coordinates(ids: np.ndarray) -> np.ndarray:
    """Place in the cube, whole numbers of ``BITS`` bits: the projection of the mean token, squashed."""
    if not len(ids):
        return np.full(DIMENSIONS, 2 ** (BITS - 1), np.int64)
    # A lane holds the sum of fewer than 2**16 bits.
    parts = [_directions()[ids[k : k + 65_535]].sum() for k in range(0, len(ids), 65_535)]
    ones = [sum(int(p) >> (16 * d) & 0xFFFF for p in parts) for d in range(DIMENSIONS)]
    mean = 2 * np.array(ones) / len(ids) - 1
    return np.clip((0.5 + 0.5 * np.tanh(4 * mean)) * 2**BITS, 0, 2**BITS - 1).astype(np.int64)


def hilbert_key(places: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``places`` (n points, d coordinates)."""
    x = places.T.astype(np.int64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            set_bit = (x[i] & q) != 0
            swap = np.where(set_bit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_bit, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[d - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tokenised(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, curve, ids`` of every row: key on the curve, ids (16 bits each) with ``END`` at the end."""

    def run(columns: dict[str, list]):
        tokenizer = word_bpe(path or public_tokenizers.path(VOCABULARY))
        ids = tokenizer.encode_all(columns["text"])
        keys = hilbert_key(np.stack([coordinates(i) for i in ids]))
        end = np.array([END], np.uint16).tobytes()
        yield {"doc_id": columns["doc_id"], "curve": keys, "ids": [i.tobytes() + end for i in ids]}

    return map_slices(with_text(docs, ["doc_id"]), run, "doc_id long, curve long, ids binary")


class _Packer:
    """Pieces of one partition, in order; those of the open sequence are held back."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence = length, first_sequence
        self.held: list[tuple] = []
        self.filled = 0

    def _piece(self, doc_id, start: int, ids: np.ndarray, total: int, offset: int) -> tuple:
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        return doc_id, start, len(ids), crc, total, self.sequence, offset

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.length - self.filled]
            self.held.append((doc_id, start, part, len(ids), self.filled))
            self.filled += len(part)
            start += len(part)
            if self.filled == self.length:
                yield from (self._piece(*p) for p in self.held)
                self.held, self.filled, self.sequence = [], 0, self.sequence + 1

    def finish(self) -> Iterator[tuple]:
        """What is left, as sequences of falling powers of two."""
        rest, self.held = self.held, []
        left = self.filled
        room = 0
        for doc_id, start, ids, total, _ in rest:
            done = 0
            while done < len(ids):
                if room == 0:
                    size = room = 1 << (left.bit_length() - 1)
                    left -= size
                part = ids[done : done + room]
                yield self._piece(doc_id, start + done, part, total, size - room)
                done += len(part)
                room -= len(part)
                if room == 0:
                    self.sequence += 1


_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens (a power of two).

    Each row is a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Every
    sequence is full or has a power of two of tokens. A null text counts as empty and has the end
    token alone; repeated rows are documents of their own; an empty table gives an empty result.
    Documents with equal keys are told apart by id, so copies spread over partitions.
    """
    assert length & (length - 1) == 0
    table = written(tokenised(docs, path), "packing")
    order = ["curve", "doc_id", F.xxhash64("ids")]
    ordered = table.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = arrow_schema(_PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(WordBpe.__module__)
        packer = _Packer(length, TaskContext.get().partitionId() << 40)

        def batch_of(pieces: list[tuple]) -> pa.RecordBatch:
            columns = zip(*pieces, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            pieces: list[tuple] = []
            doc_ids, ids = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "ids"))
            for doc_id, data in zip(doc_ids.to_pylist(), ids, strict=True):
                pieces += packer.add(doc_id, np.frombuffer(data.as_buffer(), np.uint16))
            if pieces:
                yield batch_of(pieces)
        pieces = list(packer.finish())
        if pieces:
            yield batch_of(pieces)

    return in_small_batches(ordered.select("doc_id", "ids")).mapInArrow(run, _PIECES)
