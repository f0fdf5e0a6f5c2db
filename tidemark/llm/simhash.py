"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, verified Hamming distance.

A fingerprint of 64 bits is cut into ``max_bits + 3`` blocks. Fingerprints that differ in at most
``max_bits`` bits agree in at least three whole blocks, so every such pair meets under one of the
keys (three block numbers, their bits). Equal fingerprints are one node from the start, so groups of
copies never meet in a join.

Keys that more than ``crowd`` different fingerprints share would make pairs by the square. Their
fingerprints are linked without pairs instead: each one is written under all values within
``max_bits - max_bits // 2`` flipped bits; those within ``max_bits // 2`` flips may be centres. Each
row of a value links to its smallest centre, and every such link joins texts of one component:
centre and member differ in at most ``max_bits`` bits, and so do any member and any centre. A value
has only as many members as there are fingerprints within that many flips.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_digest

from tidemark.llm.components import components
from tidemark.llm.crowds import confirmed, links_in_groups, marks, most_common
from tidemark.llm.text import arrow_schema, at_work, map_slices, with_text, words
from tidemark.session import written

SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included; 0 without words."""
    tokens = words(text.encode().lower())
    if not tokens:
        return 0
    if len(tokens) > shingle:
        grams = map(b" ".join, zip(*(tokens[k:] for k in range(shingle)), strict=False))
    else:
        grams = [b" ".join(tokens)]
    digests = np.frombuffer(b"".join(map(xxh64_digest, grams, repeat(SEED))), np.uint8)
    bits = np.unpackbits(digests).reshape(-1, 64)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(bits)
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` (signed long) of every row; a null text counts as empty."""

    def run(columns: dict[str, list]):
        values = np.array([fingerprint(t, shingle) for t in columns["text"]], np.uint64)
        yield {"doc_id": columns["doc_id"], "fp": values.view(np.int64)}

    return map_slices(with_text(docs, ["doc_id"]), run, "doc_id long, fp long")


def _block_masks(max_bits: int) -> list[int]:
    """Signed masks that keep three of ``max_bits + 3`` blocks."""
    n = max_bits + 3
    edges = [64 * k // n for k in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _under_block_keys(distinct: DataFrame, max_bits: int) -> DataFrame:
    keys = [
        F.struct(F.lit(k).alias("blocks"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits"))
        for k, mask in enumerate(_block_masks(max_bits))
    ]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.*")


def _flipped(fps: DataFrame, flips: int) -> DataFrame:
    """``fp, value, n``: every value within ``flips`` flipped bits, and how many were flipped."""
    rows = fps.select("fp", F.col("fp").alias("value"), F.lit(0).alias("n"), F.lit(-1).alias("last"))
    out = rows
    for n in range(1, flips + 1):
        rows = rows.where(F.col("last") < 63).withColumn("bit", F.explode(F.sequence(F.col("last") + 1, F.lit(63))))
        flip = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
        rows = rows.select("fp", F.col("value").bitwiseXOR(flip).alias("value"), F.lit(n).alias("n"), F.col("bit").alias("last"))
        out = out.unionByName(rows)
    return out.select("fp", "value", "n")


def _links_in_crowds(fps: DataFrame, max_bits: int) -> DataFrame:
    near, far = max_bits // 2, max_bits - max_bits // 2
    at_value = Window.partitionBy("value")
    centre = F.min(F.when(F.col("n") <= near, F.col("fp"))).over(at_value)
    return _flipped(fps, far).withColumn("b", centre).where("b != fp").select(F.col("fp").alias("a"), "b").distinct()


def links(distinct: DataFrame, max_bits: int = 3, crowd: int = 256) -> DataFrame:
    """Edges ``a, b`` that connect the same fingerprints as all pairs within ``max_bits`` bits do."""
    keyed = _under_block_keys(distinct, max_bits)
    counts = keyed.groupBy("blocks", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keyed.join(counts, ["blocks", "bits"]), "simhash-shared")
    few = shared.where(F.col("n") <= crowd)
    a = few.select("blocks", "bits", F.col("fp").alias("a"))
    b = few.select("blocks", "bits", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = a.join(b, ["blocks", "bits"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    crowded = shared.where(F.col("n") > crowd).select("fp").distinct()
    return pairs.unionByName(_links_in_crowds(crowded, max_bits))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, crowd: int = 256) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` in the row's component; rows whose ``doc_id`` is null
    take part but name no component. Repeated rows and ids stay rows of their own. Empty and null
    texts have fingerprint 0 and are linked like any other. An empty table gives an empty result.
    """
    table = written(fingerprints(docs, shingle), "simhash")
    distinct = table.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(distinct, max_bits, crowd), "a", "b").withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return table.join(named, "fp").select("doc_id", "fp", "component_id")


# Documents are near at this Jaccard likeness of their sets of word shingles, of this many words.
SHINGLE = 5
SIMILAR_PERCENT = 80
# Whole fingerprints of such a pair differ in about 10 of 64 bits; 18 are three deviations more.
SIMILAR_BITS = 18
SLICES = 32
# A document is first compared with so many before it under a key, in the order of fingerprints.
NEIGHBOURS = 4
# Sets up to this size are compared by marks before their shingles are.
SMALL = 512


def _shingle_set(text: str) -> np.ndarray:
    """Hashes of the different 5-word shingles, sorted; fewer words are one shingle, none are none."""
    tokens = words(text.encode().lower())
    if not tokens:
        return np.array([], np.uint64)
    grams = [b" ".join(tokens)]
    if len(tokens) > SHINGLE:
        grams = map(b" ".join, zip(*(tokens[k:] for k in range(SHINGLE)), strict=False))
    digests = b"".join(map(xxh64_digest, grams, repeat(SEED)))
    return np.unique(np.frombuffer(digests, ">u8").astype(np.uint64))


def _least_size(cut: int) -> float:
    """The smallest set that is cut into so many slices: 1.5 to 3 shingles each, from 96 on 3 to 6."""
    return 1.5 * cut if cut <= 16 else 3 * cut


def cuts(size: int) -> list[int]:
    """Into how many slices a set is cut. Two sets with a likeness of 0.8 share one of these numbers.

    Their sizes differ by a quarter at most, so a set less than a quarter above the least size for its
    number is cut into half as many as well.
    """
    cut = 1
    while _least_size(2 * cut) <= size:
        cut *= 2
    return [cut, cut // 2] if cut > 1 and size < 1.25 * _least_size(cut) else [cut]


def _majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of each run of hashes."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
    sizes = np.diff(np.append(starts, len(hashes)))
    over = 2 * np.add.reduceat(bits, starts, axis=0, dtype=np.int64) > sizes[:, None]
    return np.packbits(over, axis=1).reshape(-1).view(">u8").astype(np.uint64)


def slice_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each of the first ``SLICES`` slices of a shingle set: its SimHash, number and count."""
    keys = [np.array([], np.uint64)]
    for cut in cuts(len(hashes)) if len(hashes) else []:
        at = hashes & np.uint64(cut - 1)
        chosen = at < SLICES
        order = np.argsort(at[chosen], kind="stable")
        numbers, starts = np.unique(at[chosen][order], return_index=True)
        if len(numbers):
            place = (numbers + np.uint64(SLICES * cut + 1)) * np.uint64(0x9E3779B97F4A7C15)
            keys.append(_majority(hashes[chosen][order], starts) ^ place)
    return np.concatenate(keys)


def _sliced(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, copy, fp, n, marks, keys`` of every row; equal shingle sets have one ``copy``."""

    def run(columns: dict[str, list]):
        sets = [_shingle_set(t) for t in columns["text"]]
        whole = [int(_majority(h, np.array([0])).view(np.int64)[0]) if len(h) else 0 for h in sets]
        yield {
            "doc_id": columns["doc_id"],
            "text_key": columns["text_key"],
            "copy": [xxh3_128_digest(h.tobytes()) for h in sets],
            "fp": whole,
            "n": [len(h) for h in sets],
            "marks": [marks(h) for h in sets],
            "keys": [slice_keys(h).view(np.int64) for h in sets],
        }

    rows = with_text(docs, ["doc_id", F.xxhash64("text").alias("text_key")])
    return map_slices(rows, run, "doc_id long, text_key long, copy binary, fp long, n long, marks array<long>, keys array<long>")


def _neighbours(keyed: DataFrame) -> DataFrame:
    """``a, b``: each node with those just before it under a key, and with the key's first.

    Rows are range-sorted by key and fingerprint and streamed, so a key that stands everywhere is cut
    into ranges, and makes a fixed number of pairs a row.
    """
    order = ["key", "fp", "node"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = arrow_schema("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(fingerprint.__module__)
        key, first, last = None, None, deque(maxlen=NEIGHBOURS)
        for batch in batches:
            found = set()
            for k, fp, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    key, first = k, (fp, node)
                    last.clear()
                for other, before in {first, *last}:
                    if before != node and ((fp ^ other) & (1 << 64) - 1).bit_count() <= SIMILAR_BITS:
                        found.add((min(node, before), max(node, before)))
                last.append((fp, node))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

    return ranged.mapInArrow(run, "a long, b long").distinct()


def _full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, full``: the shingle sets of these nodes, each made from one of its texts."""
    texts = with_text(docs, [F.xxhash64("text").alias("text_key")]).join(nodes, "text_key")

    def run(columns: dict[str, list]):
        yield {"node": columns["node"], "full": [_shingle_set(t).tobytes() for t in columns["text"]]}

    # Rows with equal texts give equal sets: one of them is read.
    once = texts.groupBy("node").agg(F.first("text").alias("text"))
    return written(map_slices(once, run, "node long, full binary"), "simhash-sets")


def similar_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, component_id`` of every row: near copies at a Jaccard likeness of 0.8.

    Shingles are five words. The bits of one SimHash are too few to tell 0.8 from less, so the
    fingerprint is a wide one: a document's shingles are dealt by hash into slices of a few, and each
    slice has a SimHash of its own. The slices are its blocks: near documents share one (of pairs at
    0.8, 98 in 100 or more). Documents that share a block are compared with their neighbours by
    SimHash first, those whose whole fingerprints lie within 18 bits; then all of a block's pairs that
    this has not brought together are (``crowds``: exactly, without a row for each pair). Links are
    confirmed on the full sets. Equal sets are one node from the start. ``component_id`` is the smallest
    ``doc_id`` of those linked; rows without a ``doc_id`` take part but name none. Texts without words (null
    ones too) are copies of each other. Repeated rows stay; an empty table gives an empty result.
    """
    table = written(_sliced(docs), "simhash-sliced")
    least = [F.min(c).alias(c) for c in ("text_key", "fp", "n", "marks", "keys")]
    grouped = table.groupBy("copy").agg(F.min("doc_id").alias("first_id"), *least)
    nodes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "simhash-nodes")
    keyed = nodes.select(F.explode("keys").alias("key"), "fp", "node")
    company = keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least != most")
    held = written(keyed.join(company.select("key"), "key", "left_semi"), "simhash-held")
    sets = _full_sets(docs, nodes.select("text_key", "node").join(held.select("node").distinct(), "node", "left_semi"))
    near = confirmed(_neighbours(held), sets, SIMILAR_PERCENT)
    labels = written(components(near, "a", "b").withColumnRenamed("root", "label"), "simhash-labels")
    label = F.coalesce("label", "node").alias("label")
    groups = held.select("key", "node").join(nodes.select("node", "n", "marks"), "node").join(labels, "node", "left")
    groups = groups.select(F.col("key").alias("group"), "node", label, "n", "marks")
    enough = (100 + SIMILAR_PERCENT) * most_common("n") >= SIMILAR_PERCENT * (F.col("n") + F.col("n_x"))
    small = F.greatest("n", "n_x") <= SMALL
    across = links_in_groups(groups, sets, SIMILAR_PERCENT, ~small | enough, ["marks"])
    rooted = nodes.join(components(near.unionByName(across), "a", "b"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("copy", "root").join(least, "root").select("copy", "component_id")
    return table.select("doc_id", "copy").join(named, "copy").select("doc_id", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without all but the first of each group of near copies, by ``doc_id`` (columns unchanged).

    Groups are those of ``similar_documents``. Rows without a ``doc_id`` cannot be told apart and stay;
    of rows that share the kept ``doc_id`` all stay.
    """
    found = similar_documents(docs)
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
