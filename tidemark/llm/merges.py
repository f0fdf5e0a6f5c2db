"""Many pieces at once through the merges of a byte-level BPE vocabulary.

Pieces of one length are the columns of a matrix. A round merges in each column the first of the pairs of
least rank, as BPE does; a column without a pair to merge is done, and the others, now one token shorter,
join the pieces of that length. So a round is a handful of operations over all columns.
"""

from __future__ import annotations

import json

import numpy as np

from tidemark.llm.byte_bpe import byte_characters

_NONE = 2**20
_NO_PAIR = 2**32 - 1
_SLOTS, _SHIFT, _FACTOR = 2**18, 14, 0x9E3779B1
# A place in a piece fits into this many bits.
_PLACE = 6
LONGEST = 2**_PLACE


class Merges:
    """The merges of a ``tokenizers`` file whose model is a plain byte-level BPE of fewer than 2**16 ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        odd = ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        self.usable = model.get("type") == "BPE" and not any(model.get(o) for o in odd)
        if not self.usable:
            return
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_characters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = [vocabulary[a] << 16 | vocabulary[b] for a, b in merges]
        # With every byte in the vocabulary no piece has an unknown part; a pair that is listed twice is not looked into.
        self.usable = (
            max(vocabulary.values()) < 2**16 - 1
            and all(c in vocabulary and c + suffix in vocabulary for c in letters)
            and 0 < len(set(keys)) == len(keys) <= _SLOTS // 4
        )
        if not self.usable:
            return
        # Id of a byte inside a piece and at its end.
        self.inside = np.array([vocabulary[c] for c in letters], np.uint32)
        self.final = np.array([vocabulary[c + suffix] for c in letters], np.uint32)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.uint32)
        # An open table of the pairs: each is at its own place or, where that is taken, soon behind it.
        self.keys, self.ranks = np.full(_SLOTS, _NO_PAIR, np.uint32), np.full(_SLOTS, _NONE, np.int32)
        for rank, key in enumerate(keys):
            at = (key * _FACTOR & 0xFFFFFFFF) >> _SHIFT
            while self.keys[at] != _NO_PAIR:
                at = (at + 1) % _SLOTS
            self.keys[at], self.ranks[at] = key, rank

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << np.uint32(16) | right
        at = key * np.uint32(_FACTOR) >> np.uint32(_SHIFT)
        seen = self.keys[at]
        ranks = np.where(seen == key, self.ranks[at], np.int32(_NONE))
        open_ = np.nonzero((seen != key) & (seen != np.uint32(_NO_PAIR)))
        at, key = at[open_], key[open_]
        while len(at):
            at = (at + np.uint32(1)) % np.uint32(_SLOTS)
            seen = self.keys[at]
            ranks[open_] = np.where(seen == key, self.ranks[at], ranks[open_])
            on = (seen != key) & (seen != np.uint32(_NO_PAIR))
            open_, at, key = tuple(x[on] for x in open_), at[on], key[on]
        return ranks

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (of 1 to ``LONGEST`` bytes) one after the other, and how many each has."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(lengths)
        symbols = self.inside[data]
        symbols[ends - 1] = self.final[data[ends - 1]]
        starts, by_length = ends - lengths, np.argsort(lengths, kind="stable")
        bounds = np.searchsorted(lengths[by_length], np.arange(lengths.max(initial=0) + 2))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rows, ids, ranks = np.empty(0, np.int64), np.empty((len(bounds), 0), np.uint32), np.empty((len(bounds), 0), np.int32)
        for n in range(len(bounds) - 2, 0, -1):
            own = by_length[bounds[n] : bounds[n + 1]]
            new = symbols[starts[own] + np.arange(n)[:, None]]
            rows = np.concatenate([rows, own])
            ids = np.concatenate([ids[:n], new], axis=1)
            ranks = np.concatenate([ranks[: n - 1], self._rank(new[:-1], new[1:])], axis=1)
            if n == 1:
                done.append((rows, ids))
                break
            # Rank and place in one number.
            first = ((ranks << _PLACE) + np.arange(n - 1, dtype=np.int32)[:, None]).min(axis=0)
            go = np.flatnonzero(first < _NONE << _PLACE)
            if len(go) < len(rows):
                over = np.flatnonzero(first >= _NONE << _PLACE)
                done.append((rows[over], ids[:, over]))
                rows, ids, ranks, first = rows[go], ids[:, go], ranks[:, go], first[go]
            place, every = first & (LONGEST - 1), np.arange(len(rows))
            behind = np.arange(n - 1, dtype=np.int32)[:, None] > place
            ids = np.where(behind, ids[1:], ids[:-1])
            ids[place, every] = made = self.made[first >> _PLACE]
            behind = np.arange(n - 2, dtype=np.int32)[:, None] >= place
            ranks = np.where(behind, ranks[1:], ranks[:-1])
            k = np.flatnonzero(place > 0)
            ranks[place[k] - 1, k] = self._rank(ids[place[k] - 1, k], made[k])
            k = np.flatnonzero(place < n - 2)
            ranks[place[k], k] = self._rank(made[k], ids[place[k] + 1, k])
        counts = np.zeros(len(pieces), np.int64)
        for rows, ids in done:
            counts[rows] = len(ids)
        first = np.cumsum(counts) - counts
        flat = np.empty(counts.sum(), np.uint32)
        for rows, ids in done:
            flat[first[rows] + np.arange(len(ids))[:, None]] = ids
        return flat, counts
