"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton finds every vocabulary piece that ends at each character; dynamic
programming carries the best score and its number of pieces. The rules are those of the unigram model
of the ``tokenizers`` library behind its ``Metaspace`` pre-tokenizer:

* spaces become ``MARK``; a text that does not begin with one gets one; it is cut before each mark;
* a score only gives way to a greater one, and of equal ones that with the earlier start is met first;
* a character without a piece of its own may also be unknown, at the smallest score less 10; an
  unknown character counts as many tokens as it has UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from tidemark.llm.text import Recent, map_slices, remembered_by, with_text

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, in the order of their ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.remembered = Recent(lambda chunk: self.count_chunk(MARK + chunk))

    def _steps(self, chunk: str):
        """``end, start, score, pieces`` of every match and unknown character, by end, then by start."""
        alone = [k for k, c in enumerate(chunk) if c not in self.single]
        if not alone:
            for end, (length, score) in self.automaton.iter(chunk):
                yield end + 1, end + 1 - length, score, 1
            return
        found: list[list[tuple]] = [[] for _ in range(len(chunk) + 1)]
        for end, (length, score) in self.automaton.iter(chunk):
            found[end + 1].append((end + 1, end + 1 - length, score, 1))
        for k in alone:
            found[k + 1].append((k + 1, k, self.unknown, len(chunk[k].encode())))
        for steps in found:
            yield from steps

    def count_chunk(self, chunk: str) -> int:
        best: list[float | None] = [None] * (len(chunk) + 1)
        pieces = [0] * (len(chunk) + 1)
        best[0] = 0.0
        for end, start, score, n in self._steps(chunk):
            total = best[start] + score
            if best[end] is None or total > best[end]:
                best[end] = total
                pieces[end] = pieces[start] + n
        return pieces[-1]

    def count(self, text: str) -> int:
        """Tokens of a whole text; an empty one has none."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        head, *rest = marked.split(MARK)
        # A text that begins with a mark has an empty head; else the head gets its own mark.
        return sum(map(self.remembered.__getitem__, [head, *rest] if head else rest))


@lru_cache(maxsize=2)
def counter(path: str) -> UnigramCounter:
    """One automaton for each worker and file."""
    return UnigramCounter(read_vocabulary(path))


remembered_by(__name__, counter.cache_clear)


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_chars, n_tokens`` of every row, whole texts, in one pass without a shuffle.

    A null text counts as empty: no characters, no tokens. Repeated rows stay rows of their own; an
    empty table gives an empty result. ``path``: a model file on every executor, the public one by
    default; its pieces and scores are read as a unigram vocabulary.
    """

    def run(columns: dict[str, list]):
        tokens = counter(path or public_tokenizers.path(MODEL))
        yield {
            "doc_id": columns["doc_id"],
            "n_chars": [len(t) for t in columns["text"]],
            "n_tokens": [tokens.count(t) for t in columns["text"]],
        }

    return map_slices(with_text(docs, ["doc_id"]), run, "doc_id long, n_chars long, n_tokens long")
