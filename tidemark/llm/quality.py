"""Quality rules: counted signals, and a calibrated classifier on hashed word and character n-grams.

The classifier is a logistic regression fitted on labelled rows (quality 0 or 1). A document's
features are the shares of its words, word pairs and character 4-grams that fall into each of
``2**BITS`` hash slots, as square roots and scaled to length one, so long and short texts weigh
alike. It is fitted on a bounded sample of the labelled rows (``max_train`` whole texts, taken by hash
of the id); every document is scored on its whole text. A fifth of the sample is held back from the
fit: on it, a one-dimensional logistic fit (Platt scaling) turns scores into probabilities. A document
is kept if its probability of being good is at least ``MIN_GOOD``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.text import at_work, in_small_batches, map_slices, remembered_by, with_text, words

BITS = 16
# Fixed threshold on the calibrated probability that a document is good.
MIN_GOOD = 0.5
# Bound of the training sample, in labelled rows.
MAX_TRAIN = 3_000

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
_A_WORD = re.compile(r"[^\x20\x09-\x0D]")


def _word_ids(tokens: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, in order of first appearance."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(t, len(known)) for t in tokens), np.int64, len(tokens))


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, the first occurrence included."""
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    ids = _word_ids(tokens)
    size = int(ids.max()) + 1
    keys = ids[:n]
    for k in range(1, window):
        _, keys = np.unique(keys * size + ids[k : n + k], return_inverse=True)
    again = np.bincount(keys)[keys] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(tokens), bool)
    for k in range(window):
        covered[k : n + k] |= again
    return int(covered.sum())


def signals(text: str, tokens: list[bytes]) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a whole text."""
    lines = [line for line in text.split("\n") if _A_WORD.search(line)]
    return (
        len(tokens),
        len(text) - sum(text.count(c) for c in " \t\n\v\f\r"),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeated_words(tokens),
    )


def _mixed(values: np.ndarray) -> np.ndarray:
    """The top bits of a multiplicative hash: slot numbers."""
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights of a text: words, word pairs and character 4-grams, each kind of length one."""
    slots, weights = [], []

    def add(values: np.ndarray) -> None:
        if len(values):
            found, counts = np.unique(_mixed(values), return_counts=True)
            slots.append(found)
            weights.append(np.sqrt(counts / len(values)))

    if tokens:
        ids = np.array(list(map(_word_hash, tokens)), np.uint64)
        add(ids + np.uint64(1))
        add(ids[:-1] * np.uint64(31) + ids[1:] * np.uint64(17) + np.uint64(2))
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(points) > 3:
        gram = points[:-3]
        for k in (1, 2, 3):
            gram = gram * np.uint64(1_000_003) + points[k : len(points) - 3 + k]
        add(gram + np.uint64(3))
    if not slots:
        return np.empty(0, np.int64), np.empty(0)
    return np.concatenate(slots), np.concatenate(weights) / np.sqrt(len(slots))


_word_hash = lru_cache(maxsize=150_000)(xxh64_intdigest)
remembered_by(__name__, _word_hash.cache_clear)


@dataclass
class Model:
    """Weights by slot (the last one is the intercept) and the calibration of scores."""

    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(self.weights[slots] @ values + self.weights[-1])

    def probability(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(_sigmoid(self.slope * self.score(slots, values) + self.shift))


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _newton(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> tuple[float, float]:
    """Platt scaling: slope and shift of a logistic fit of ``y`` on the scores ``x``."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    design = np.stack([x, np.ones_like(x)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = _sigmoid(design @ theta)
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        theta = theta + np.linalg.solve(hessian, design.T @ (target - p) - 1e-3 * (theta - [1.0, 0.0]))
    return float(theta[0]), float(theta[1])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 120, penalty: float = 1e-4) -> Model | None:
    """Fit on ``(slots, weights, label)`` rows; every fifth row calibrates. None without both labels.

    Accelerated gradient descent on the mean log loss, both labels weighted alike.
    """
    train = [r for k, r in enumerate(rows) if k % 5]
    held = [r for k, r in enumerate(rows) if k % 5 == 0]
    if len({r[2] for r in train}) < 2:
        return None
    size = 2**BITS
    at = np.repeat(np.arange(len(train), dtype=np.int32), [len(r[0]) for r in train])
    slots = np.concatenate([r[0] for r in train])
    values = np.concatenate([r[1] for r in train]).astype(np.float32)
    y = np.array([r[2] for r in train], float)
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w = look = np.zeros(size + 1)
    for k in range(rounds):
        p = _sigmoid(np.bincount(at, look[slots] * values, len(y)) + look[-1])
        error = share * (p - y)
        gradient = np.append(np.bincount(slots, error[at] * values, size) + penalty * look[:-1], error.sum())
        step = look - 2.0 * gradient
        look = step + k / (k + 3) * (step - w)
        w = step
    model = Model(w)
    if len({r[2] for r in held}) == 2:
        scores = np.array([model.score(s, v) for s, v, _ in held])
        model.slope, model.shift = _newton(scores, np.array([r[2] for r in held], float))
    return model


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model | None:
    """Fit on a bounded sample of labelled rows; None (no verdict) if they do not show both labels.

    Rows without a label, id or text take no part. The sample is the ``max_train`` labelled ids
    smallest by hash, so it is the same in every run. Features are made on the executors from whole
    texts; what reaches the driver is bounded by the sample and the number of slots.
    """
    chosen = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    rows = (
        docs.select("doc_id", "text")
        .where("text is not null")
        .join(F.broadcast(chosen), "doc_id")  # at most ``max_train`` rows of two numbers
        .select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    )

    def run(columns: dict[str, list]):
        made = [features(t, words(t.encode())) for t in columns["text"]]
        yield {
            "doc_id": columns["doc_id"],
            "quality": columns["quality"],
            "slots": [s.astype(np.uint16).tobytes() for s, _ in made],
            "weights": [v.astype(np.float16).tobytes() for _, v in made],
        }

    made = map_slices(rows, run, "doc_id long, quality int, slots binary, weights binary").toArrow()
    sample = sorted(zip(*(made[name].to_pylist() for name in made.column_names), strict=True))
    return fit([(np.frombuffer(s, np.uint16), np.frombuffer(w, np.float16), q) for _, q, s, w in sample])


_RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, good double"
)
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, model: Model | None, min_good: float = MIN_GOOD) -> DataFrame:
    """One row per document: its signals, the base rule's verdict, the probability and ``kept``.

    A null text has no word and fails the base rule (fewer than 50 words). Without a model the base
    rule alone decides and ``good`` is null; for a document that fails the base rule ``good`` is null
    too. Repeated rows are judged row by row; an empty table gives an empty result.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS + 1 numbers, whatever the data

    def run(columns: dict[str, list]):
        fitted = weights.value
        out: dict[str, list] = {name: [] for name in ("doc_id", *_NAMES, "base_failed", "kept", "good")}
        for text in columns["text"]:
            tokens = words(text.encode())
            found = signals(text, tokens)
            failed = found[0] < MIN_WORDS or 100 * found[4] > MAX_REPEAT_PERCENT * found[0]
            good = None if failed or fitted is None else fitted.probability(*features(text, tokens))
            for name, value in zip(_NAMES, found, strict=True):
                out[name].append(value)
            out["base_failed"].append(failed)
            out["good"].append(good)
            out["kept"].append(not failed and (good is None or good >= min_good))
        out["doc_id"] = columns["doc_id"]
        yield out

    return map_slices(with_text(docs, ["doc_id"]), run, f"doc_id long, {_RESULT}")


def keep_good(docs: DataFrame, model: Model | None, min_good: float = MIN_GOOD) -> DataFrame:
    """The documents that are kept, all columns unchanged, without a shuffle."""
    weights = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.schema

    def run(batches):
        at_work(Model.__module__)
        fitted = weights.value
        for batch in batches:
            verdicts = []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                tokens = words((text or "").encode())
                failed = len(tokens) < MIN_WORDS
                failed = failed or 100 * repeated_words(tokens) > MAX_REPEAT_PERCENT * len(tokens)
                passes = not failed and (fitted is None or fitted.probability(*features(text or "", tokens)) >= min_good)
                verdicts.append(passes)
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return in_small_batches(docs).mapInArrow(run, kept)
