"""Line deduplication over a corpus: equal lines, and lines one edit apart, keep only the earliest.

Lines are compared in lower case with white space made single; a line without a word is none. A line goes
if an equal or near line stands earlier (by ``doc_id``, nulls last, then by line number; under one id, by
text). Lines of fewer than ``MIN_CHARS`` characters, where one letter makes another word, are near no other
line; equal ones go at any length. The edit unit is the word for lines of more than ``LONG_CHARS``
characters and at least ``MIN_UNITS`` words, else the character; two lines are near if at most one unit of
either of them is substituted, inserted or deleted, so lines on both sides of these bounds are compared.

Near lines are found by their deletion neighbourhood: each line is written under the hash of every
variant with one unit left out, and under its own; equal variants are joined and the distance is
verified on the texts. Hashes of variants come from rolling hashes of what stands before and behind the
unit, so a line costs its length. Variants of all lines would be as many as there are words, so a first
round leaves out half a line instead of a unit: of two near lines either the first or the last half is
equal. Only lines that share such a half with a different line, a few in a hundred, have their
variants made, and only for units outside that half; no near pair is lost. A line near a bound is also
written in the other's unit, as a guest there: guests are compared with lines at home only. Keys keep
their earliest line, and the earliest at home (a partial aggregate), so a line or a template that stands
everywhere makes no pairs; each line is then compared with that one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from xxhash import xxh64_intdigest

from tidemark.llm.text import free_name, in_small_batches, map_slices
from tidemark.session import written

MIN_CHARS = 16
LONG_CHARS = 64
MIN_UNITS = 8
# Lines whose lengths in units fall into one class of this width share the size of their halves.
CLASS_WIDTH = 16

_LAST_ID = 2**63 - 1


def normalised(line: str) -> str:
    return " ".join(line.lower().split())


class Form(NamedTuple):
    """A line as a sequence of units; ``home`` if they are the line's own, else it is a guest among lines of these."""

    kind: str
    parts: list[str] | str
    home: bool


def forms(line: str) -> list[Form]:
    """The forms under which a normalised line can be near another, its own first."""
    if len(line) < MIN_CHARS:
        return []
    found = line.split(" ")
    if len(line) > LONG_CHARS and len(found) >= MIN_UNITS:
        own = [Form("word", found, True)]
        return [*own, Form("char", line, False)] if len(line) == LONG_CHARS + 1 or len(found) == MIN_UNITS else own
    own = [Form("char", line, True)]
    return [*own, Form("word", found, False)] if len(found) >= MIN_UNITS - 1 else own


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _joined(parts: list[str] | str) -> str:
    return parts if isinstance(parts, str) else " ".join(parts)


FIRST, LAST = 0, 1


def _half_sizes(n: int) -> dict[int, int]:
    """Classes of a line of ``n`` units, and how many units their halves have.

    A half is at most half of every line of a class, and of the lines one unit shorter than its
    shortest, which are in both classes.
    """
    classes = {n // CLASS_WIDTH}
    if (n + 1) % CLASS_WIDTH == 0:
        classes.add((n + 1) // CLASS_WIDTH)
    return {c: (c * CLASS_WIDTH - 1) // 2 if c else (MIN_UNITS - 1) // 2 for c in classes}


# A half key's low bits tell its side and its unit.
_UNIT = {"char": 0, "word": 2}


def half_keys(kind: str, parts: list[str] | str) -> list[int]:
    """Keys of the first and last half; two near lines share one."""
    keys = []
    for c, q in _half_sizes(len(parts)).items():
        for side, half in ((FIRST, parts[:q]), (LAST, parts[len(parts) - q :])):
            hashed = xxh64_intdigest(f"{kind}{c}\x1f{_joined(half)}")
            keys.append(_signed(hashed >> 2 << 2 | _UNIT[kind] | side))
    return keys


WHOLE, SHORTER, REPLACED = 0, 1, 2

# Rolling hashes are polynomials in _BASE modulo a prime.
_PRIME = 2**61 - 1
_BASE = 0x9E3779B97F4A7C15 % _PRIME
_BACK = pow(_BASE, -1, _PRIME)


def _values(parts: list[str] | str) -> Iterator[int]:
    if isinstance(parts, str):
        return (ord(c) + 1 for c in parts)
    return (xxh64_intdigest(word) % _PRIME for word in parts)


def variant_keys(kind: str, parts: list[str] | str, shared: int = 3) -> Iterator[tuple[int, int]]:
    """Key and role of each variant: the line itself, one unit left out, or replaced at its place.

    ``shared`` has a bit for each side (first, last) on which a different line has an equal half. With
    an equal first half the edit comes after it, and before an equal last half. Keys of replaced units
    never equal those of the other two roles.
    """
    n, q = len(parts), min(_half_sizes(len(parts)).values())
    first, end = (0 if shared >> LAST & 1 else q), (n if shared >> FIRST & 1 else n - q)
    unit = _UNIT[kind] >> 1
    total, power = 0, 1
    for value in _values(parts):
        total = (total + value * power) % _PRIME
        power = power * _BASE % _PRIME
    yield total << 2 | unit, WHOLE
    before, power, last = 0, 1, -1
    for k, value in enumerate(_values(parts)):
        if k >= end:
            break
        term = value * power % _PRIME
        if k >= first:
            rest = (before + (total - before - term) * _BACK) % _PRIME
            if rest != last:
                yield rest << 2 | unit, SHORTER
                last = rest
            at_place = ((n << 32 | k + 1) * 0x9E3779B97F4A7C15 & 2**64 - 1) >> 3
            yield (rest ^ at_place) << 2 | 2 | unit, REPLACED
        before = (before + term) % _PRIME
        power = power * _BASE % _PRIME


def _one_apart(x: list[str] | str, y: list[str] | str) -> bool:
    if abs(len(x) - len(y)) > 1:
        return False
    if len(x) > len(y):
        x, y = y, x
    head = 0
    while head < len(x) and x[head] == y[head]:
        head += 1
    return x[head + (len(x) == len(y)) :] == y[head + 1 :]


def within_one(a: str, b: str) -> bool:
    """Whether two normalised lines are at most one unit of either of them apart."""
    others = {form.kind: form for form in forms(b)}
    return any(
        (form.home or other.home) and _one_apart(form.parts, other.parts)
        for form in forms(a)
        if (other := others.get(form.kind))
    )


def _with_key(docs: DataFrame) -> DataFrame:
    """``doc_id`` (nulls last), ``doc_key`` and ``text``; rows equal in both are one document here."""
    key = F.xxhash64("doc_id", "text").alias("doc_key")
    return docs.select(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("doc_id"), key, "text").where("text is not null")


def _lines(docs: DataFrame) -> DataFrame:
    """One row for each line with a word: two hashes, its place, and its half keys, at home and as a guest."""

    def run(columns: dict[str, list]):
        out: dict[str, list] = {k: [] for k in ("h1", "h2", "doc_id", "doc_key", "line", "halves", "guest")}
        for doc_id, key, text in zip(columns["doc_id"], columns["doc_key"], columns["text"], strict=True):
            for number, raw in enumerate(text.split("\n")):
                line = normalised(raw)
                if not line:
                    continue
                data = line.encode()
                out["h1"].append(_signed(xxh64_intdigest(data)))
                out["h2"].append(_signed(xxh64_intdigest(data, 1)))
                out["doc_id"].append(doc_id)
                out["doc_key"].append(key)
                out["line"].append(number)
                keys: dict[bool, list[int]] = {True: [], False: []}
                for form in forms(line):
                    keys[form.home] += half_keys(form.kind, form.parts)
                out["halves"].append(keys[True])
                out["guest"].append(keys[False])
        yield out

    return map_slices(
        _with_key(docs), run, "h1 long, h2 long, doc_id long, doc_key long, line int, halves array<long>, guest array<long>"
    )


def _place() -> Column:
    return F.struct("doc_id", "line", "h1", "h2")


def _active(lines: DataFrame) -> DataFrame:
    """``h1`` of the lines that share a half with a different line, and a bit for each such unit and side.

    One of the lines that share it must be at home there.
    """
    keys = F.expr("concat(transform(halves, k -> struct(k AS half, true AS home)), transform(guest, k -> struct(k AS half, false AS home)))")
    halves = lines.select("h1", F.explode(keys).alias("key")).select("h1", "key.*")
    least = (F.min("h1").alias("a"), F.max("h1").alias("b"), F.bool_or("home").alias("at_home"))
    shared = halves.groupBy("half").agg(*least).where("a != b AND at_home")
    met = halves.join(shared.select("half"), "half")
    return met.groupBy("h1").agg(F.expr("bit_or(shiftleft(1, cast(half & 3 as int)))").alias("shared"))


def _texts(docs: DataFrame, first: DataFrame) -> DataFrame:
    """The normalised text of each line of ``first``, fetched from its document."""
    line = F.struct("line", "h1", "h2", "doc_id", "shared")
    wanted = first.groupBy("doc_key").agg(F.collect_list(line).alias("wanted"))
    found = _with_key(docs).select("doc_key", "text").join(wanted, "doc_key")
    names = ("line", "h1", "h2", "doc_id", "shared")

    def run(columns: dict[str, list]):
        out: dict[str, list] = {k: [] for k in (*names, "content")}
        for text, rows in zip(columns["text"], columns["wanted"], strict=True):
            split = text.split("\n")
            for row in rows:
                out["content"].append(normalised(split[row["line"]]))
                for name in names:
                    out[name].append(row[name])
        yield out

    return map_slices(found, run, "h1 long, h2 long, doc_id long, line int, shared int, content string")


_VARIANT_ROWS = 50_000


def _variants(texts: DataFrame) -> DataFrame:
    names = ("h1", "h2", "doc_id", "line")

    def run(columns: dict[str, list]):
        out: dict[str, list] = {k: [] for k in ("variant", "role", "home", *names)}
        for k, content in enumerate(columns["content"]):
            for form in forms(content):
                sides = columns["shared"][k] >> _UNIT[form.kind] & 3
                keys = variant_keys(form.kind, form.parts, sides) if sides else iter(())
                # A very long line has many variants; not all of them are held at once.
                while some := list(islice(keys, _VARIANT_ROWS)):
                    out["variant"] += [v for v, _ in some]
                    out["role"] += [r for _, r in some]
                    out["home"] += [form.home] * len(some)
                    for name in names:
                        out[name] += [columns[name][k]] * len(some)
                    if len(out["variant"]) >= _VARIANT_ROWS:
                        yield out
                        out = {name: [] for name in out}
        yield out

    ddl = "variant long, role byte, home boolean, h1 long, h2 long, doc_id long, line int"
    return map_slices(texts, run, ddl, text="content")


def _candidates(variants: DataFrame) -> DataFrame:
    """``h1, h2`` of a line and ``e1, e2`` of an earlier one with an equal variant."""
    place = _place()
    whole = F.col("role") == WHOLE

    def earliest(test: Column, name: str) -> Column:
        return F.min(F.when(test, place)).alias(name)

    kept = variants.groupBy("variant").agg(
        earliest(whole, "whole"),
        earliest(~whole, "edited"),
        earliest(whole & F.col("home"), "whole_home"),
        earliest(~whole & F.col("home"), "edited_home"),
        F.min("h1").alias("a"),
        F.max("h1").alias("b"),
    )
    # A line meets others under one of its variants in three ways: it is the longer one; it is the shorter
    # one; both have the unit at the same place replaced.
    shorter = F.col("role") == SHORTER
    met = F.when(shorter, F.col("whole")).otherwise(F.col("edited"))
    met_home = F.when(shorter, F.col("whole_home")).otherwise(F.col("edited_home"))
    pairs = variants.join(kept.where("a != b"), "variant")
    pairs = pairs.withColumn("earlier", F.when(F.col("home"), met).otherwise(met_home))
    pairs = pairs.where(F.col("earlier") < place)
    return pairs.selectExpr("h1", "h2", "earlier.h1 AS e1", "earlier.h2 AS e2").distinct()


def _verified(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """``h1, h2`` of the lines that are near an earlier one, by their texts."""
    own = texts.select("h1", "h2", "content")
    other = texts.selectExpr("h1 AS e1", "h2 AS e2", "content AS earlier")
    both = candidates.join(own, ["h1", "h2"]).join(other, ["e1", "e2"]).select("h1", "h2", "content", "earlier")

    def run(columns: dict[str, list]):
        pairs = zip(columns["h1"], columns["h2"], columns["content"], columns["earlier"], strict=True)
        found = [(a, b) for a, b, content, earlier in pairs if within_one(content, earlier)]
        yield {"h1": [a for a, _ in found], "h2": [b for _, b in found]}

    return map_slices(both, run, "h1 long, h2 long", text="content").distinct()


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, dropped``: the numbers (from 0) of a document's lines that go, in order.

    Only documents that lose a line have a row. ``doc_key`` is ``xxhash64(doc_id, text)``. Rows equal
    in id and text are one document: they lose the same lines, and none because of each other. Null
    texts have no lines. An empty table gives an empty result.
    """
    lines = written(_lines(docs), "lines")
    firsts = lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "doc_key", "line")).alias("first"), F.count("*").alias("n"))
    active = firsts.join(_active(lines), "h1").select("h1", "h2", "first.*", "shared")
    texts = written(_texts(docs, active), "line-texts")
    variants = written(_variants(texts), "line-variants")
    near = _verified(_candidates(variants), texts).withColumn("near", F.lit(True))
    repeated = firsts.where("n > 1").select("h1", "h2", "first")
    judged = written(near.join(repeated, ["h1", "h2"], "full"), "line-verdicts")
    place = F.struct("doc_id", "doc_key", "line")
    goes = F.coalesce("near", F.lit(False)) | (F.col("first") != place)
    dropped = lines.select("h1", "h2", "doc_id", "doc_key", "line").join(judged, ["h1", "h2"]).where(goes)
    return dropped.groupBy("doc_id", "doc_key").agg(F.array_sort(F.collect_set("line")).alias("dropped"))


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped`` of every document; a null text has no lines."""
    every = docs.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("doc_key"),
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    found = duplicate_lines(docs).select("doc_key", "dropped")
    none = F.array().cast("array<int>")
    return every.join(found, "doc_key", "left").select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", none).alias("dropped"),
    )


@F.pandas_udf(StringType())
def _cut(text: pd.Series, gone: pd.Series) -> pd.Series:
    """The text without the lines of these numbers; null where the text is null."""

    def kept(text: str, gone) -> str:
        numbers = set(gone)
        return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in numbers)

    return pd.Series([None if t is None else kept(t, g) for t, g in zip(text, gone, strict=True)], dtype=object)


def without_duplicate_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go, ``n_chars`` counted anew; columns unchanged.

    A document that loses all its text goes; one that loses no line stays as it is.
    """
    key, other, gone = (free_name(docs, name) for name in ("doc_key", "dropped_key", "dropped_lines"))
    found = duplicate_lines(docs).select(F.col("doc_key").alias(other), F.col("dropped").alias(gone))
    joined = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(found, F.col(key) == F.col(other), "left")
    unchanged = F.col(gone).isNull()
    left, made = F.when(~unchanged, F.col("text")), free_name(docs, "text_left")
    joined = in_small_batches(joined).withColumn(made, _cut(left, gone))
    text = F.when(unchanged, F.col("text")).otherwise(F.col(made))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        counted = F.length(text).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(unchanged, F.col("n_chars")).otherwise(counted)
    stays = unchanged | text.rlike("[^\\x20\\x09-\\x0D]")
    return joined.where(stays).withColumns(changed).select(*docs.columns)
