"""Alignment of two tokenizers, with corpus-wide pair counts by external spill counting.

Tokenizer A is byte-level BPE, tokenizer B a piece model with byte fallback; both see a space and the
text, so their tokens cut the same bytes. Offsets where tokens of both end cut them into groups; an A
and a B token are linked where their byte ranges overlap. The count of an id pair is the number of
documents (rows) that hold it linked.

*Words.* Before a space or a line feed that follows something other than white space, tokens of both
always end: no piece holds a space behind another character or a line feed beside any, and A splits
there. So a text is cut into words at such places, a word is aligned once and remembered, and a
document's groups are those of its words.

*Counting.* A document has many pairs and the corpus more than a memory holds, so they are counted
outside of it. A worker collects documents until they hold about ``RUN_CHARS`` characters and writes a
*run*: its pair-document records, sorted by A id, B id and document, cut by radix (A id modulo
``radix``) into zstd frames. A merge reads the frames of up to ``FAN_IN`` runs of one radix block by
block through a heap, smallest next key first, and adds up equal pairs; merged runs are merged again
until a radix has one. All pairs of an A id lie in one radix and side by side, so the last merge sees
their maximum. Then the counts stream back the way they came: each merged run marks its inputs' pairs
with the final counts, and the first runs turn theirs into contributions per document.

Every run and merged run is a row of a table in the shared folder, so a lost executor costs its tasks
only. A frame of a first run is bounded by ``RUN_CHARS``, a merged one by the number of id pairs of a
radix (the vocabularies, not the corpus); a pair that a third of all documents hold is one entry of
each frame. No row ever meets another of the same pair in a shuffle.
"""

from __future__ import annotations

import heapq
import io
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from string import punctuation

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.byte_bpe import byte_characters
from tidemark.llm.merges import LONGEST, Merges
from tidemark.llm.text import arrow_schema, in_small_batches, map_slices, sha256_hex, slices, with_text
from tidemark.session import written

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
RADIX = 32
FAN_IN = 64
RUN_CHARS = 4_000_000
RUN_DOCS = 1 << 15
BLOCK = 1 << 16

# Words are remembered while they have at most this many characters, all together this many.
LONG_WORD = 64
REMEMBERED_CHARS = 2_500_000

# A space or line feed and what follows, up to one that stands behind something other than white space.
_WORD = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")


_NO_LINKS = np.empty(0, np.uint64)
# So many plain words are merged together; fewer are left to the library.
MANY = 2_000


def _lies_plain(path: str) -> bool:
    """Does A cut a space and letters, and the marks behind them, as GPT-2 does, and change no text?"""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    cutter = whole.get("pre_tokenizer") or {}
    alone = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    specials = all(t["special"] for t in whole.get("added_tokens", ()))
    return bool(alone and specials and whole.get("normalizer") is None)


class Words:
    """Aligned words by number: token and link counts, group string, links."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        merges = Merges(path_a)
        self.merges = merges if merges.usable and _lies_plain(path_a) else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            # An entry with a character outside the table (a special one) never comes from a text.
            self.bytes_a[i] = bytes(of[c] for c in token) if all(c in of for c in token) else b""
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lengths_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.space_b = [self.b.piece_to_id("▁")]
        # An id with what follows it: a comma inside a group, else the mark at the end of its side.
        self.signs_a = np.array([f"{i}{c}" for i in range(len(self.bytes_a)) for c in ",|"], object)
        self.signs_b = np.array([f"{i}{c}" for i in range(len(self.bytes_b)) for c in ",;"], object)
        self.clear()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.stats = np.empty((0, 4), np.int64)
        self.groups: list[str | None] = []
        self.links: list[np.ndarray] = []

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The words of each text as numbers; aligns those not seen yet."""
        cut = [_WORD.findall(" " + text) if text else [] for text in texts]
        missing = list({w: None for words in cut for w in words if w not in self.number})
        if missing:
            self._align(missing)
        return [[self.number[w] for w in words] for words in cut]

    def forget(self) -> None:
        """Between runs: long words go at once, the others when there are too many."""
        if self.chars > REMEMBERED_CHARS:
            self.clear()

    def _plain(self, words: list[str]) -> dict[str, list[int]]:
        """A's ids of those words that are a space and letters, with or without marks behind, if there are many."""
        stems = {w: stem for w in words if w[0] == " " and (stem := w.rstrip(punctuation))[1:].isalpha() and len(w) <= LONGEST // 4}
        if self.merges is None or len(stems) < MANY:
            return {}
        # Letters are one piece, marks behind them another.
        pieces = [x.encode() for w, stem in stems.items() for x in (stem, w[len(stem) :]) if x]
        ids, counts = self.merges.merged(pieces)
        n_pieces = np.array([1 + (len(w) > len(stem)) for w, stem in stems.items()])
        ends = np.cumsum(counts)[np.cumsum(n_pieces) - 1].tolist()
        ids = ids.tolist()
        return {w: ids[i:k] for w, i, k in zip(stems, [0, *ends], ends, strict=False)}

    def _spelt(self, words: list[bytes], all_ids: list[list[int]], spelling: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """Whether the tokens of each word spell it."""
        flat = list(chain.from_iterable(all_ids))
        n_bytes = np.concatenate([[0], np.cumsum(lengths[flat])]).astype(np.int64)
        ends = n_bytes[np.cumsum([len(ids) for ids in all_ids])]
        if (ends == np.cumsum([len(w) for w in words])).all() and b"".join(map(spelling.__getitem__, flat)) == b"".join(words):
            return np.ones(len(words), bool)
        return np.array([b"".join(map(spelling.__getitem__, ids)) == w for w, ids in zip(words, all_ids, strict=True)])

    def _align(self, missing: list[str]) -> None:
        encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        plain = self._plain(missing)
        others = [w for w in missing if w not in plain]
        plain.update(zip(others, (e.ids for e in encode(others, add_special_tokens=False)), strict=True))
        all_a = [plain[w] for w in missing]
        # B puts a space in front itself; before a line feed it is a token of its own, which goes.
        all_b = self.b.encode([w[1:] if w[0] == " " else w for w in missing], num_threads=1)
        # Of no text it makes no token, so a last space stands for itself.
        all_b = [self.space_b if w == " " else ids if w[0] == " " else ids[1:] for w, ids in zip(missing, all_b, strict=True)]
        base = len(self.stats)
        data = [w.encode() for w in missing]
        spelt = self._spelt(data, all_a, self.bytes_a, self.lengths_a) & self._spelt(data, all_b, self.bytes_b, self.lengths_b)
        good = np.flatnonzero(spelt).tolist()
        n = len(missing)
        self.number.update(zip(missing, range(base, base + n), strict=True))
        self.chars += sum(map(len, missing))
        self.stats = np.concatenate([self.stats, np.zeros((n, 4), np.int64)])
        self.groups += [None] * n
        self.links += [_NO_LINKS] * n
        if good:
            self._align_good([all_a[k] for k in good], [all_b[k] for k in good], [base + k for k in good])

    def _align_good(self, all_a: list[list[int]], all_b: list[list[int]], numbers: list[int]) -> None:
        flat_a, flat_b = (np.array(list(chain.from_iterable(side)), np.int64) for side in (all_a, all_b))
        word_a, word_b = (np.repeat(np.arange(len(side)), [len(ids) for ids in side]) for side in (all_a, all_b))
        ends_a, ends_b = np.cumsum(self.lengths_a[flat_a]), np.cumsum(self.lengths_b[flat_b])
        # One link for each stretch between neighbouring ends: the tokens that cover it.
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        link = (flat_a[at_a].astype(np.uint64) << np.uint64(32)) | flat_b[at_b].astype(np.uint64)
        link_word = word_a[at_a]
        both = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        closes_a, closes_b = np.zeros(len(flat_a), bool), np.zeros(len(flat_b), bool)
        closes_a[at_a[both]] = True
        closes_b[at_b[both]] = True
        # A group: its A ids, then its B ids. An id stands behind all ids of earlier groups.
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b))])[group_a]
        until_a = np.cumsum(np.bincount(group_a))[group_b]
        symbols = np.empty(len(flat_a) + len(flat_b), object)
        symbols[np.arange(len(flat_a)) + before_b] = self.signs_a[2 * flat_a + closes_a]
        symbols[np.arange(len(flat_b)) + until_a] = self.signs_b[2 * flat_b + closes_b]
        symbols = symbols.tolist()
        n = len(numbers)
        n_a, n_b, n_links = (np.bincount(w, minlength=n) for w in (word_a, word_b, link_word))
        n_groups = np.bincount(link_word[both], minlength=n)
        ends_at = np.cumsum(n_a + n_b).tolist()
        starts = [0, *ends_at[:-1]]
        links_at = np.cumsum(n_links).tolist()
        self.stats[numbers] = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        links_from = [0, *links_at[:-1]]
        for k, number in enumerate(numbers):
            self.groups[number] = "".join(symbols[starts[k] : ends_at[k]])
            # A copy: the batch's array must not live as long as one of its words.
            self.links[number] = link[links_from[k] : links_at[k]].copy()

    def drop_long(self) -> None:
        for word in [w for w in self.number if len(w) > LONG_WORD]:
            number = self.number.pop(word)
            self.chars -= len(word)
            self.groups[number], self.links[number] = None, _NO_LINKS


@lru_cache(maxsize=1)
def _words(path_a: str, path_b: str) -> Words:
    return Words(path_a, path_b)


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)


def _aligned(words: Words, texts: list[str]) -> Iterator[tuple[list[int], str]]:
    """The word numbers and the group string of each text; none if a word's tokens do not spell it."""
    for numbers in words.numbers(texts):
        parts = [words.groups[k] for k in numbers]
        yield ([], "") if None in parts else (numbers, "".join(parts)[:-1])


def token_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``doc_id, groups`` of every row: groups such as ``a1,a2|b1;a3|b2,b3``, empty without tokens.

    Null and empty texts, and texts that the tokens of A or B do not spell, have none. Repeated rows
    stay; an empty table gives an empty result; other columns are left out.
    """
    paths = _paths(path_a, path_b)

    def run(columns: dict[str, list]):
        words = _words(*paths)
        yield {"doc_id": columns["doc_id"], "groups": [g for _, g in _aligned(words, columns["text"])]}
        words.drop_long()
        words.forget()

    return map_slices(with_text(docs, ["doc_id"]), run, "doc_id long, groups string")


# --- frames -------------------------------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd frame behind a line that says their types and lengths."""
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode() + b"\n"
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(frame: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    at = data.index(b"\n") + 1
    arrays = []
    for kind, n in json.loads(data[:at]):
        arrays.append(np.frombuffer(data, kind, n, at))
        at += arrays[-1].nbytes
    return arrays


class _Pairs:
    """Writes sorted pairs with their values to a zstd stream in blocks: steps between keys, values."""

    def __init__(self):
        self.buffer = io.BytesIO()
        self.out = zstandard.ZstdCompressor(level=1).stream_writer(self.buffer, closefd=False)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        for at in range(0, len(keys), BLOCK):
            block = keys[at : at + BLOCK]
            steps = np.diff(block, prepend=np.uint64(0))
            self.out.write(np.uint64(len(block)).tobytes() + steps.tobytes() + values[at : at + BLOCK].astype(np.uint64).tobytes())

    def done(self) -> bytes:
        self.out.close()
        return self.buffer.getvalue()


def _pairs(frame: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The blocks of what ``_Pairs`` wrote."""
    with zstandard.ZstdDecompressor().stream_reader(frame) as source:
        while head := source.read(8):
            n = int(np.frombuffer(head, np.uint64)[0])
            steps = np.frombuffer(source.read(8 * n), np.uint64)
            yield np.cumsum(steps, dtype=np.uint64), np.frombuffer(source.read(8 * n), np.uint64)


def merged(frames: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted frames; values of equal keys are added up.

    The heap holds the last key of each frame's block in memory. Up to the smallest of them, no frame has
    anything unread, so the blocks' beginnings up to there are merged at once.
    """
    sources = [_pairs(f) for f in frames]
    blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def read(k: int) -> None:
        block = next(sources[k], None)
        if block is None:
            blocks.pop(k, None)
        else:
            blocks[k] = block
            heapq.heappush(heap, (int(block[0][-1]), k))

    for k in range(len(sources)):
        read(k)
    while heap:
        bound = heap[0][0]
        keys, values = [], []
        for k, (own_keys, own_values) in blocks.items():
            n = int(np.searchsorted(own_keys, np.uint64(bound), "right"))
            if n:
                keys.append(own_keys[:n])
                values.append(own_values[:n])
                blocks[k] = (own_keys[n:], own_values[n:])
        found, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(found), np.uint64)
        np.add.at(total, where, np.concatenate(values))
        yield found, total
        while heap and heap[0][0] == bound:
            read(heapq.heappop(heap)[1])


# --- runs ---------------------------------------------------------------------------------------------

_DOCS = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [("groups_sha256", pa.string())])
_RUNS = "run long, radix int, pairs binary, records binary"


def _docs_frame(rows: list[tuple]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        columns = zip(*rows, strict=True)
        out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DOCS, strict=True)], schema=_DOCS))
    return sink.getvalue().to_pybytes()


class _Run:
    """What a worker has collected for its next run."""

    def __init__(self, words: Words):
        self.words, self.rows, self.numbers, self.chars = words, [], [], 0

    def add(self, doc_ids: list, texts: list[str]) -> None:
        aligned = list(_aligned(self.words, texts))
        held = [np.array(numbers, np.int64) for numbers, _ in aligned]
        stats = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(self.words.stats[np.concatenate(held)], axis=0)])
        ends = np.cumsum([len(numbers) for numbers in held])
        sums = np.diff(stats[ends], axis=0, prepend=0).tolist()
        for doc_id, (_, groups), of_doc in zip(doc_ids, aligned, sums, strict=True):
            self.rows.append((doc_id, *of_doc, sha256_hex(groups.encode()) if groups else ""))
        self.numbers += held
        self.chars += sum(map(len, texts))

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair, document and number of links, sorted by pair and document."""
        sizes = [len(n) for n in self.numbers]
        if not sum(sizes):
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        doc, word = np.repeat(np.arange(len(sizes)), sizes), np.concatenate(self.numbers)
        used, word = np.unique(word, return_inverse=True)
        held, times = np.unique(doc * len(used) + word, return_counts=True)
        doc, word = held // len(used), held % len(used)
        links = [self.words.links[k] for k in used.tolist()]
        n_links = np.array([len(x) for x in links])
        pairs, pair = np.unique(np.concatenate(links), return_inverse=True)
        # The links of each held word: a range of ``pair``.
        n = n_links[word]
        first = (np.cumsum(n_links) - n_links)[word]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        both = pair[place] * len(sizes) + np.repeat(doc, n)
        order = np.argsort(both, kind="stable")
        both = both[order]
        starts = np.flatnonzero(np.diff(both, prepend=-1))
        times = np.add.reduceat(np.repeat(times, n)[order], starts)
        both = both[starts]
        return pairs[both // len(sizes)], both % len(sizes), times

    def frames(self, run: int, radix: int) -> Iterator[tuple]:
        yield run, -1, None, _docs_frame(self.rows)
        pairs, docs, times = self.records()
        part = ((pairs >> np.uint64(32)) % np.uint64(radix)).astype(np.int64)
        for k in np.unique(part).tolist():
            mine = part == k
            keys, counts = np.unique(pairs[mine], return_counts=True)
            out = _Pairs()
            out.add(keys, counts)
            yield run, k, out.done(), _pack(counts.astype(np.uint32), docs[mine].astype(np.uint16), times[mine].astype(np.uint32))


def write_runs(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, radix: int = RADIX, run_chars: int = RUN_CHARS) -> DataFrame:
    """Runs as rows: one with the documents (radix -1) and one for each radix that occurs.

    ``pairs`` has the pairs with the number of the run's documents that hold them, ``records`` the
    documents of each pair and how often they hold it.
    """
    paths = _paths(path_a, path_b)
    schema = arrow_schema(_RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(*paths)
        task, n = TaskContext.get().partitionId(), 0
        now = _Run(words)

        def out() -> Iterator[pa.RecordBatch]:
            for row in now.frames((task << 31) + n, radix):
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            for columns in slices(batch):
                now.add(columns["doc_id"], columns["text"])
                if now.chars >= run_chars or len(now.rows) + 1000 > RUN_DOCS:
                    yield from out()
                    words.drop_long()
                    words.forget()
                    now, n = _Run(words), n + 1
        if now.rows:
            yield from out()
            words.drop_long()
            words.forget()

    return written(in_small_batches(with_text(docs, ["doc_id"])).mapInArrow(run, _RUNS), "align-runs")


# --- merging and streaming back -----------------------------------------------------------------------

_NODES = "node long, radix int, pairs binary"


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Sorted rows, grouped by their first ``keys`` columns; rows of a group come one by one."""
    rows = (row for b in batches for k in range(b.num_rows) for row in zip(*(c.to_pylist() for c in b.slice(k, 1).columns), strict=True))
    row = next(rows, None)
    while row is not None:
        key = row[:keys]

        def mine() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[:keys] == key:
                yield row[keys:]
                row = next(rows, None)

        group = mine()
        yield key, group
        for _ in group:
            pass


def _map_sorted(df: DataFrame, by: list[str], then: list[str], fn: Callable, keys: int, ddl: str) -> DataFrame:
    """``fn(key, rows)`` over the groups of ``by``, their rows in the order of ``then``."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _groups(batches, keys):
            for out in fn(key, rows):
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return in_small_batches(df.repartition(*by).sortWithinPartitions(*by, *then)).mapInArrow(run, ddl)


def _merge(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    radix, node = key
    out = _Pairs()
    for keys, counts in merged([pairs for (pairs,) in rows]):
        out.add(keys, counts)
    yield node, radix, out.done()


def _merge_level(nodes: DataFrame, parents: int, start: bool) -> DataFrame:
    above = _parent(start, parents)
    rows = nodes.select("radix", above.alias("above"), "pairs")
    return written(_map_sorted(rows, ["radix", "above"], [], _merge, 2, _NODES), "align-merged")


def _parent(first: bool, parents: int):
    """Merged run that a node goes to: runs are dealt by hash, merged runs by number."""
    return F.pmod(F.xxhash64("node") if first else F.col("node"), F.lit(parents).cast("long"))


def _finish(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    """The last merge: twice the count, plus one if it is the greatest of its A id."""
    (radix,) = key
    frames = [pairs for (pairs,) in rows]
    best: dict[int, int] = {}
    for keys, counts in merged(frames):
        ids = (keys >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.diff(ids, prepend=-1))
        for i, most in zip(ids[starts].tolist(), np.maximum.reduceat(counts, starts).tolist(), strict=True):
            best[i] = max(most, best.get(i, 0))
    out = _Pairs()
    most = np.zeros(max(best, default=0) + 1, np.uint64)
    most[list(best)] = list(best.values())
    for keys, counts in merged(frames):
        is_best = most[(keys >> np.uint64(32)).astype(np.int64)] == counts
        out.add(keys, 2 * counts + is_best)
    yield 0, radix, out.done()


def _looked_up(final: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    return final[1][np.searchsorted(final[0], keys)]


def _whole(frame: bytes) -> tuple[np.ndarray, np.ndarray]:
    blocks = list(_pairs(frame))
    return np.concatenate([k for k, _ in blocks]), np.concatenate([v for _, v in blocks])


def _send_back(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    """First the merged run with final counts, then those it was made of."""
    radix, _ = key
    final = _whole(next(rows)[1])
    for node, pairs in rows:
        out = _Pairs()
        for keys, _ in _pairs(pairs):
            out.add(keys, _looked_up(final, keys))
        yield node, radix, out.done()


def _contribute(key: tuple, rows: Iterator[tuple]) -> Iterator[tuple]:
    """What the pairs of a radix add to the documents of each run."""
    radix, _ = key
    final = _whole(next(rows)[1])
    for run, pairs, records in rows:
        n_docs, docs, times = _unpack(records)
        values = np.repeat(_looked_up(final, np.concatenate([k for k, _ in _pairs(pairs)])), n_docs).astype(np.int64)
        n = int(docs.max()) + 1
        count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(count_sum, docs, (values >> 1) * times)
        np.add.at(n_best, docs, (values & 1) * times)
        yield run, radix, _pack(count_sum, n_best)


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _collect(key: tuple, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """A run's documents (radix -1 comes first) with the sums over all radixes."""
    _, docs = next(rows)
    batch = pa.ipc.open_stream(docs).read_next_batch()
    count_sum, n_best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
    for _, frame in rows:
        some_sum, some_best = _unpack(frame)
        count_sum[: len(some_sum)] += some_sum
        n_best[: len(some_best)] += some_best
    columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
    columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    names = [c.split()[0] for c in _RESULT.split(", ")]
    yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)


def final_counts(runs: DataFrame, fan_in: int = FAN_IN) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """Merge runs level by level; the levels (number of merged runs, their table) and the last merge."""
    first = runs.where("radix >= 0").select(F.col("run").alias("node"), "radix", "pairs")
    n = runs.where("radix = -1").count()
    levels, nodes = [], first
    while n > fan_in:
        n = -(-n // fan_in)
        nodes = _merge_level(nodes, n, nodes is first)
        levels.append((n, nodes))
    last = _map_sorted(nodes.select("radix", "pairs"), ["radix"], [], _finish, 1, _NODES)
    return levels, written(last, "align-final")


def pair_counts(final: DataFrame) -> DataFrame:
    """``a_id, b_id, n_docs, is_best`` of every linked id pair, from the last merge."""
    ddl = "a_id long, b_id long, n_docs long, is_best boolean"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frame in batch.column(0):
                for keys, values in _pairs(frame.as_py()):
                    ids = [(keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]
                    arrays = [*map(pa.array, ids), pa.array((values >> np.uint64(1)).astype(np.int64)), pa.array((values & np.uint64(1)).astype(bool))]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return in_small_batches(final.select("pairs")).mapInArrow(run, ddl)


def align(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    radix: int = RADIX,
    run_chars: int = RUN_CHARS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``n_best`` counts the links whose pair is the most frequent one of its A id (ties included),
    ``count_sum`` adds up the pair counts of all links. Rows without tokens (null or empty text, or one
    that the tokens do not spell) have zeros and an empty ``groups_sha256``. Every row is a document of
    its own, repeated ones too; a null ``doc_id`` stays null; an empty table gives an empty result;
    other columns are left out.
    """
    runs = write_runs(docs, path_a, path_b, radix, run_chars)
    levels, final = final_counts(runs, fan_in)
    above = 1
    for n, nodes in reversed(levels):
        rows = _under(final, nodes.select("radix", _parent(False, above).alias("above"), "node", "pairs"))
        sent = _map_sorted(rows, ["radix", "above"], ["node"], _send_back, 2, _NODES)
        final, above = written(sent, "align-back"), n
    named = runs.where("radix >= 0").withColumnRenamed("run", "node")
    below = named.select("radix", _parent(True, above).alias("above"), "node", "pairs", "records")
    given = _map_sorted(_under(final, below), ["radix", "above"], ["node"], _contribute, 2, "run long, radix int, frame binary")
    held = runs.where("radix = -1").select("run", "radix", F.col("records").alias("frame"))
    return _map_sorted(held.unionAll(given), ["run"], ["radix"], _collect, 1, _RESULT)


def _under(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Children with their parent, which has no ``node`` and so stands first."""
    first = parents.select("radix", F.col("node").alias("above"), F.lit(None).cast("long").alias("node"), "pairs")
    return children.unionByName(first, allowMissingColumns=True)
