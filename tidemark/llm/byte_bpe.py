"""Byte-level BPE by a rank file: encoding with offsets, and decoding, over Arrow batches.

The ``tokenizers`` library does the merges. Its BPE works on characters, so each byte is written as
the character of a fixed one-to-one table; the merges are derived from the ranks: every split of a
token into two tokens is a merge, in the order of the ranks. Two splits of one token have the same
rank, and then the leftmost place wins; the library takes the merges one after the other instead.
That differs only where the two overlap (``x y z`` with ``xy = yz``), so pieces that hold such a
string are merged by a small loop with the rank rule itself.

Texts are cut by ``PATTERN``; a worker remembers the ids of what it met between spaces lately.
"""

from __future__ import annotations

import base64
import heapq
import struct
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from tokenizers import models

from tidemark.llm.text import Recent, map_slices, remembered_by, sha256_hex, with_text

RANKS = "byte_bpe_multi_50k.tiktoken"
# Marks that often end a word.
_MARKS = frozenset(".,;:!?")
# A space with white space before it, and white space or the end behind it.
_SPACE_INSIDE = regex.compile(r"(?<=\s) (?!\S)")


def byte_characters() -> str:
    """Character of each byte: printable Latin-1 ones stand for themselves, the others from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(others)) for b in range(256))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class ByteBpe:
    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.characters = byte_characters()
        self.from_latin = {b: c for b, c in enumerate(self.characters) if chr(b) != c}
        # Ids of what stands between two spaces, with the first of them.
        self.after_space = Recent(self._ids_after_space)
        self._build()

    def as_characters(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.from_latin)

    def _build(self) -> None:
        merges, self.overlaps = [], ahocorasick.Automaton()
        for token in sorted(self.ranks, key=self.ranks.get):
            cuts = [k for k in range(1, len(token)) if token[:k] in self.ranks and token[k:] in self.ranks]
            merges += [(self.as_characters(token[:k]), self.as_characters(token[k:])) for k in cuts]
            for k in cuts:
                # x = token[:k], y = token[k:], and y z is the token again.
                y = token[k:]
                if len(y) in cuts and token.startswith(y):
                    both = self.as_characters(token + token[len(y) :])
                    self.overlaps.add_word(both, True)
        self.overlaps.make_automaton()
        vocabulary = {self.as_characters(t): r for t, r in self.ranks.items()}
        self.model = models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True)

    def _by_rank(self, data: bytes) -> list[int]:
        """The rank rule itself: merge the adjacent pair of the smallest rank, the leftmost first."""
        if data in self.ranks:
            return [self.ranks[data]]
        ranks, n = self.ranks, len(data)
        # Parts by their first byte: where the next one begins, and where the one before did.
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[data[k : k + 2]], k, k + 2) for k in range(n - 1) if data[k : k + 2] in ranks]
        heapq.heapify(heap)
        ends = dict.fromkeys(range(n))

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n:
                end = after[after[k]]
                if data[k:end] in ranks:
                    heapq.heappush(heap, (ranks[data[k:end]], k, end))

        while heap:
            _, k, end = heapq.heappop(heap)
            # Gone if this part was merged into another one or one of the two has grown since.
            if k not in ends or after[k] >= n or after[after[k]] != end:
                continue
            del ends[after[k]]
            after[k] = end
            if end < n:
                before[end] = k
            offer(before[k])
            offer(k)
        return [ranks[data[k : after[k]]] for k in ends]

    def _piece_ids(self, piece: str) -> bytes:
        spelt = self.as_characters(piece.encode())
        if len(spelt) > 3 and next(self.overlaps.iter(spelt), None):
            return _as_bytes(self._by_rank(piece.encode()))
        return _as_bytes([token.id for token in self.model.tokenize(spelt)])

    def _ids(self, text: str) -> bytes:
        return b"".join(map(self._piece_ids, self.pattern.findall(text)))

    def _ids_after_space(self, chunk: str) -> bytes:
        # What the pattern does with letters, and with letters and one mark.
        if chunk.isalpha():
            return self._piece_ids(" " + chunk)
        if chunk[-1:] in _MARKS and chunk[:-1].isalpha():
            return self.after_space[chunk[:-1]] + self._piece_ids(chunk[-1])
        return self._ids(" " + chunk)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, unsigned 32 bits, little-endian.

        A piece begins at every space that has no white space before it, and at one that has, if none
        follows; a text whose spaces are all like that is cut there and its chunks are looked up.
        """
        if _SPACE_INSIDE.search(text):
            return np.frombuffer(self._ids(text), "<u4")
        head, *rest = text.split(" ")
        return np.frombuffer(self._ids(head) + b"".join(map(self.after_space.__getitem__, rest)), "<u4")

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last code point that each token touches; a split character is in both."""
        data = np.frombuffer(text.encode(), np.uint8)
        place = np.cumsum((data & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        return place[ends - self.lengths[ids]], place[ends - 1] + 1

    def decode(self, ids) -> bytes:
        """The bytes of ids, in order; a character split over tokens comes together again."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def bpe(path: str) -> ByteBpe:
    """One tokenizer for each worker and file."""
    return ByteBpe(path)


remembered_by(__name__, bpe.cache_clear)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, starts, ends`` of every row: token ids and the code points that each touches.

    A null text counts as empty and has no token. Repeated rows stay rows of their own; an empty table
    gives an empty result. ``path``: a rank file on every executor, the public one by default.
    """

    def run(columns: dict[str, list]):
        tokenizer = bpe(path or public_tokenizers.path(RANKS))
        ids = [tokenizer.encode(t) for t in columns["text"]]
        spans = [tokenizer.offsets(t, i) for t, i in zip(columns["text"], ids, strict=True)]
        yield {
            "doc_id": columns["doc_id"],
            "ids": ids,
            "starts": [s for s, _ in spans],
            "ends": [e for _, e in spans],
        }

    return map_slices(with_text(docs, ["doc_id"]), run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, data, text`` of rows with ``doc_id, ids``; null ids count as none.

    ``text`` has U+FFFD where ids end or begin inside a character; ``data`` has the bytes as they are.
    """

    def run(columns: dict[str, list]):
        tokenizer = bpe(path or public_tokenizers.path(RANKS))
        data = [tokenizer.decode(ids or ()) for ids in columns["ids"]]
        yield {"doc_id": columns["doc_id"], "data": data, "text": [d.decode("utf-8", "replace") for d in data]}

    rows = encoded.selectExpr("doc_id", "ids", "'' AS text")
    return map_slices(rows, run, "doc_id long, data binary, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encoded, then decoded, in one pass."""

    def run(columns: dict[str, list]):
        tokenizer = bpe(path or public_tokenizers.path(RANKS))
        ids = [tokenizer.encode(t) for t in columns["text"]]
        yield {
            "doc_id": columns["doc_id"],
            "n_tokens": [len(i) for i in ids],
            "ids_sha256": [sha256_hex(i.tobytes()) for i in ids],
            "decoded_sha256": [sha256_hex(tokenizer.decode(i.tolist())) for i in ids],
        }

    return map_slices(with_text(docs, ["doc_id"]), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
