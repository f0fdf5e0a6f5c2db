"""MinHash near-duplicates by an LSH forest over word shingles.

A document's set is its distinct shingles of ``shingle`` words. Two sets are linked if they are alike by
``percent`` (100 x intersection >= percent x union), always confirmed on the full sets. Equal sets are
one node from the start.

*Forest.* Each node has ``HASHES`` minhashes. A tree is a rotation of them, so a node's path in a tree
is the sequence from the tree's own place on; sorted by path, nodes that are alike stand together, and
those that share a beginning of some depth form a region. Regions start at depth ``DEPTH``; nodes
without company there in a tree leave that tree.

*Neighbours.* The paths of the first ``SORTED`` trees are sorted, by range, so a crowd is cut over
partitions like anything else. Each node meets the one before it, the one with the longest common
beginning; what is alike becomes one component.

*Regions.* After that the regions of all trees are looked at for pairs across components. Where they are at
most ``FEW``, or ``LIMIT`` for each node, all of them are compared: first by marks of sets up to ``SMALL``
shingles, which bound what they share, and ``BITS`` bits of each minhash of others; where more of these differ than
six standard deviations above the mean of barely alike sets, the sets are not looked at. A region with more pairs is a crowd, compared by its members' differences from one of them (``crowds``),
which loses no pair: a crowd of copies of one text costs a link for each member, and documents just outside of
it are compared in tiles, by arithmetic on marks and not by rows.

A pair of likeness s shares a region of depth d in one of the trees with probability
``1 - (1 - s^d)^trees``: at 0.8 and 32 trees 1 - 1e-10 at depth 3.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from tidemark.llm.components import components
from tidemark.llm.crowds import LIMIT, confirmed, links_in_groups, marks, most_common
from tidemark.llm.text import arrow_schema, in_small_batches, map_slices, with_text, words
from tidemark.session import written

HASHES = 128
TREES = 32
DEPTH, DEEPEST = 3, 16
SORTED = 16
SMALL = 512
BITS = 4
SHINGLE = 2
PERCENT = 80

_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, (2, HASHES), dtype=np.uint64)
_FACTORS, _SHIFTS = _SEEDS[0] * np.uint64(2) + np.uint64(1), _SEEDS[1]


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words make one shingle, no word none."""
    tokens = words(text.encode().lower())
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) > shingle:
        grams = set(map(b" ".join, zip(*(tokens[k:] for k in range(shingle)), strict=False)))
    else:
        grams = {b" ".join(tokens)}
    return np.sort(np.frombuffer(b"".join(map(xxh64_digest, grams)), ">u8").astype(np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        block = hashes[at : at + 1024, None] * _FACTORS + _SHIFTS
        np.minimum(least, block.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _least_size(percent: int) -> int:
    """Sets smaller than this are linked to equal ones only: one shingle more or less is too much."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def few_bits(minhashes: np.ndarray) -> list[int]:
    """The lowest ``BITS`` bits of all minhashes as signed longs."""
    low = np.unpackbits(minhashes.astype("<u4").view(np.uint8).reshape(HASHES, 4)[:, :1], axis=1)[:, 8 - BITS :]
    return np.packbits(low.reshape(-1)).view(np.int64).tolist()


def most_bits_apart(percent: int = PERCENT) -> int:
    """Bits in which the few bits of alike sets differ at most, but for one pair in many millions.

    A minhash differs with probability 1 - s, and then each bit with 1/2.
    """
    apart = 1 - percent / 100
    mean, variance = apart * BITS / 2, apart * (BITS + BITS * BITS) / 4 - (apart * BITS / 2) ** 2
    return math.ceil(HASHES * mean + 6 * math.sqrt(HASHES * variance))


def _bits_apart(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(HASHES * BITS // 64)), F.lit(0))


_NODES = "doc_id long, text_id binary, n_shingles long, node binary, signature binary, bits array<long>"


def nodes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The node of every row: a digest of its set (null: no shingle), its size, minhashes and marks or few bits."""
    least = _least_size(percent)
    names = arrow_schema(_NODES).names

    def run(columns: dict[str, list]):
        out = []
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            found = shingle_set(text, shingle)
            node = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None
            minhashes = bits = None
            if len(found) >= least:
                own = signature(found)
                minhashes = own.astype(">u4").tobytes()
                bits = few_bits(own) if len(found) > SMALL else marks(found).tolist()
            text_id = hashlib.blake2b(text.encode(), digest_size=16).digest()
            out.append((doc_id, text_id, len(found), node, minhashes, bits))
        yield dict(zip(names, zip(*out, strict=True), strict=True))

    return map_slices(with_text(docs, ["doc_id"]), run, _NODES)


# --- the forest ---------------------------------------------------------------------------------------


def _path(tree: Column) -> Column:
    """The minhashes from the tree's place on, around the end: 4 bytes each, in byte order."""
    ring = F.concat(F.col("signature"), F.substring(F.col("signature"), 1, 4 * DEEPEST))
    return F.substring(ring, tree * F.lit(4 * HASHES // TREES) + F.lit(1), F.lit(4 * DEEPEST))


def _beginning(depth: int) -> Column:
    return F.substring(F.col("path"), 1, 4 * depth)


def forest(table: DataFrame) -> DataFrame:
    """``tree, path, node, n, bits`` of the nodes that have company at depth ``DEPTH``, one row for each tree."""
    every = table.where(F.col("signature").isNotNull())
    trees = every.select("node", F.col("n_shingles").alias("n"), "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    keyed = trees.withColumn("region", F.xxhash64("tree", F.substring(_path(F.col("tree")), 1, 4 * DEPTH)))
    # Nodes by a hash of theirs: numbers are summed up without sorting.
    own = F.xxhash64("node")
    seen = keyed.groupBy("region").agg(F.min(own).alias("least"), F.max(own).alias("most"))
    shared = written(seen.where("least != most").select("region"), "forest-regions")
    held = keyed.select("node", "n", "tree", "region").join(shared, "region", "left_semi").drop("region")
    # Copies of a text are rows of one node: one of them stays, before paths are added.
    held = written(held.distinct(), "forest-nodes")
    minhashes = every.select("node", "signature", "bits").join(held.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    return held.join(minhashes, "node").select("tree", _path(F.col("tree")).alias("path"), "node", "n", "bits")


_NEIGHBOURS = "tree int, a binary, b binary"


def neighbours(trees: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``tree, a, b``: each node and the one before it in the sorted order of a tree, if they share a region.

    Nodes at the borders of partitions miss a neighbour; regions make up for it.
    """
    schema = arrow_schema(_NEIGHBOURS)
    order = ["tree", "path", "node"]
    ordered = trees.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if before is not None and before[0] == row[0] and before[1][: 4 * DEPTH] == row[1][: 4 * DEPTH]:
                    if 100 * min(before[3], row[3]) >= percent * max(before[3], row[3]):
                        found.append((row[0], *sorted((before[2], row[2]))))
                before = row
            if found:
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return in_small_batches(ordered.select("tree", "path", "node", "n")).mapInArrow(run, _NEIGHBOURS)


# --- full sets ----------------------------------------------------------------------------------------


def _full_sets(docs: DataFrame, table: DataFrame, trees: DataFrame, shingle: int) -> DataFrame:
    """``node, full``: the whole set of each node of the forest, made from one of its texts."""
    wanted = table.join(trees.select("node").distinct(), "node", "left_semi")
    # Written, so that Spark knows its size and broadcasts it only if it is small.
    chosen = written(wanted.groupBy("node").agg(F.min("text_id").alias("text_id")), "forest-chosen")
    texts = with_text(docs, ["doc_id"]).select("doc_id", "text")

    def run(columns: dict[str, list]):
        ids = [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in columns["text"]]
        yield {"text_id": ids, "text": columns["text"]}

    # Copies of a text become one before they meet; the join on the same key shuffles no text again, and its
    # rows are one for each node. So as much is shuffled for each text whatever Spark broadcasts.
    marked = map_slices(texts, run, "text_id binary, text string").groupBy("text_id").agg(F.first("text").alias("text"))
    found = marked.join(chosen, "text_id")

    def sets(columns: dict[str, list]):
        full = [shingle_set(t, shingle).tobytes() for t in columns["text"]]
        yield {"node": columns["node"], "full": full}

    return written(map_slices(found.select("node", "text"), sets, "node binary, full binary"), "forest-sets")


# --- components ---------------------------------------------------------------------------------------


def _labels(found: DataFrame) -> DataFrame:
    """``node, label`` of the nodes that have a link."""
    return written(components(found, "a", "b").withColumnRenamed("root", "label"), "forest-labels")


def _region_links(trees: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, limit: int) -> DataFrame:
    """Links across components in all regions."""
    label = F.coalesce("label", "node").alias("label")
    region = F.xxhash64("tree", _beginning(DEPTH)).alias("group")
    groups = trees.join(labels, "node", "left").select(region, "node", label, "n", "bits")
    both_small, both_large = F.greatest("n", "n_x") <= SMALL, F.least("n", "n_x") > SMALL
    enough = (100 + percent) * most_common("n", "bits") >= percent * (F.col("n") + F.col("n_x"))
    few_apart = _bits_apart("bits", "bits_x") <= most_bits_apart(percent)
    near = F.when(both_small, enough).when(both_large, few_apart).otherwise(True)
    return links_in_groups(groups, sets, percent, near, ["bits"], limit)


def links(docs: DataFrame, table: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, limit: int = LIMIT) -> DataFrame:
    """Links ``a, b`` between nodes that connect them as all alike pairs of the forest do."""
    trees = written(forest(table), "forest")
    sets = _full_sets(docs, table, trees, shingle)
    near = neighbours(trees.where(F.col("tree") < SORTED), percent)
    found = confirmed(near.select("a", "b").distinct(), sets, percent)
    labels = _labels(found)
    return found.unionByName(_region_links(trees, sets, labels, percent, limit))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links reach from the row, ``kept`` says that it is
    the row's own. Rows without words (null, empty or blank texts) have no shingle, are linked with
    nothing, not even with each other, and are kept. Rows whose ``doc_id`` is null take part but name no
    component; alone they are kept, without a ``component_id``. Repeated rows and ids stay rows of their
    own. An empty table gives an empty result; other columns are left out.
    """
    table = written(nodes(docs, shingle, percent), "forest-table")
    roots = components(links(docs, table, shingle, percent, limit), "a", "b")
    distinct = table.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("first_id"))
    rooted = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.select("node", "root").join(least, "root").select("node", "component_id")
    rows = table.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
