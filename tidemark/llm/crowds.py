"""Alike sets in groups of any size: every pair of a group that could be alike, without a row for each.

Sets are alike at ``percent`` (100 x intersection >= percent x union). A group holds nodes that may be, each
with the label of the component it is known to be in; only pairs across labels are of interest. Where
they are few, all are compared.

*Crowds.* A group with more gets a centre, a member of the component that holds half of it or more (else the
empty set), and each member is reduced to its difference from the centre: ``removed`` elements it lacks, ``added`` ones it has instead. With
``weight = 100 removed + percent added`` and ``slack = (100 - percent) x size of the centre``, a member is
alike to the centre if its weight is at most the slack (it is near), and two members are alike exactly if
``(100 + percent) x common >= weight + weight - slack``, ``common`` being what their differences share. So near
members are linked to the centre, not to each other, and all other pairs, those with a member that is not near,
are compared in tiles: members are dealt by size and hash, pairs of tiles over tasks, and a task compares the
members of two tiles as matrices of marks. Each difference sets one of 512 marks: marks that only one of two
members has bound what they can have in common from above. What passes does so with 4,096 marks and is then
compared exactly, unless found links connect it already. No pair is lost. Pairs of members that are not near still
grow with the square of a crowd, but each costs a few words of arithmetic, not a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import arrow_schema, at_work, in_small_batches
from tidemark.session import written

LIMIT = 16
FEW = 4096
MARKS = 512
FINE_MARKS = 4096
SALTS = 16
# Members of a tile, and differences that they have in all, on average at most.
TILE_ROWS = 4096
TILE_ELEMENTS = 1 << 20
_ROWS = 256
_CELLS = 1 << 20


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are alike, as a table; ``sets`` are ``node, full``."""
    pairs = written(pairs, "crowd-pairs")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("full").alias("full_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("full").alias("full_b")), "b")
    ddl = ", ".join(f"{c} {_kind(pairs, c)}" for c in "ab")
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(alike.__module__)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                columns = [c.to_pylist() for c in batch.slice(at, _ROWS).columns]
                good = [
                    (a, b)
                    for a, b, x, y in zip(*columns, strict=True)
                    if alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                ]
                if good:
                    columns = zip(*good, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return written(in_small_batches(both.select("a", "b", "full_a", "full_b")).mapInArrow(run, ddl), "crowd-links")


def marks(delta: np.ndarray) -> np.ndarray:
    """``MARKS`` bits as signed longs, one of them set by each element."""
    bits = np.zeros(MARKS, np.uint8)
    bits[(delta % np.uint64(MARKS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _lacking(a: str, b: str) -> Column:
    """How many marks of ``a`` are not in ``b``."""
    return sum((F.bit_count(F.col(a)[k].bitwiseAND(F.bitwise_not(F.col(b)[k]))) for k in range(MARKS // 64)), F.lit(0))


def most_common(size: str = "size", own: str = "marks") -> Column:
    """What a row and its ``_x`` twin can have in common at most, by their sizes and marks."""
    return F.least(F.col(size) - _lacking(own, f"{own}_x"), F.col(f"{size}_x") - _lacking(f"{own}_x", own))


def difference(own: np.ndarray, centre: np.ndarray, percent: int) -> tuple:
    """``size, weight, slack, needed, marks, delta`` of a set against the centre's."""
    delta = np.setxor1d(own, centre, assume_unique=True)
    removed = int(np.isin(delta, centre, assume_unique=True).sum())
    weight, slack = 100 * removed + percent * (len(delta) - removed), (100 - percent) * len(centre)
    needed = weight // (100 + percent) + 1 if weight <= slack else -((slack - weight) // 100)
    return len(delta), weight, slack, needed, marks(delta), delta.view(np.int64)


def _deltas(held: DataFrame, sets: DataFrame, percent: int, crowd: Column) -> DataFrame:
    """The members of each crowd with their difference from its centre, as a table."""
    members = held.withColumn("crowd", crowd).groupBy("crowd", "node").agg(
        F.count("*").alias("seen"), F.first("label").alias("label"), F.first("n").alias("n"), F.first("main").alias("main")
    )
    members = written(members, "crowd-members")
    inside = F.col("label") == F.col("main")
    most = F.max_by(F.when(inside, F.struct("node", "label")), F.when(inside, F.struct("seen", "node")))
    half = 2 * F.count_if(inside) >= F.count("*")
    centres = members.groupBy("crowd").agg(F.when(half, most).alias("best"))
    centres = centres.select("crowd", F.col("best.node").alias("centre"), F.col("best.label").alias("centre_label"))
    full = sets.select(F.col("node").alias("centre"), F.col("full").alias("full_c"))
    centres = centres.join(full, "centre", "left").withColumn("full_c", F.coalesce("full_c", F.lit(b"")))
    # A crowd is dealt over tasks, each with a copy of its centre.
    copies = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = members.join(sets, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    both = salted.join(copies, ["crowd", "salt"])
    names = ["crowd", "node", "label", "n", "centre", "centre_label"]
    ddl = ", ".join(f"{c} {_kind(both, c)}" for c in names)
    ddl += ", size long, weight long, slack long, needed long, marks array<long>, delta array<long>"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(alike.__module__)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                *columns, full, centre = (c.to_pylist() for c in batch.slice(at, _ROWS).columns)
                found = [
                    difference(np.frombuffer(x, np.uint64), np.frombuffer(c, np.uint64), percent)
                    for x, c in zip(full, centre, strict=True)
                ]
                columns += zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return written(in_small_batches(both.select(*names, "full", "full_c")).mapInArrow(run, ddl), "crowd-deltas")


def _tiled(deltas: DataFrame, percent: int) -> DataFrame:
    """Members of crowds with one that is not near, once for each pair of tiles to compare.

    ``side`` is 0 in a tile that is compared with itself, else 1 or 2. Sets of a size class are alike only to
    those of the same class or the next one.
    """
    far = F.col("weight") > F.col("slack")
    # A little wider than the ratio of sizes, so rounding moves no set by two classes.
    width = math.log(100 / min(percent, 99)) * 1.001
    inside = F.coalesce(F.col("label") == F.col("centre_label"), F.lit(False))
    usable = deltas.where("needed <= size").withColumns({"far": far, "inside": inside, "class": F.floor(F.log("n") / F.lit(width))})
    tiles = F.ceil(F.greatest(F.count("*") / TILE_ROWS, F.sum("size") / TILE_ELEMENTS)).cast("long")
    classes = usable.groupBy("crowd", "class").agg(tiles.alias("tiles"), F.max(F.expr("far and not inside")).alias("outside"))
    classes = written(classes, "crowd-classes")
    other = classes.select(
        "crowd",
        F.explode(F.sequence(F.col("class") - 1, F.col("class") + 1)).alias("class"),
        F.struct(F.col("class"), F.col("tiles"), F.col("outside")).alias("other"),
    )
    met = classes.join(other, ["crowd", "class"]).where("outside or other.outside").select("crowd", "class", "tiles", "other")
    held = usable.join(met, ["crowd", "class"])
    tile = F.pmod(F.xxhash64("node"), F.col("tiles"))
    held = held.withColumn("tile", tile).withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other.tiles") - 1)))
    one, two = F.struct(F.col("class"), F.col("tile")), F.struct(F.col("other.class"), F.col("met").alias("tile"))
    pair = F.xxhash64("crowd", F.least(one, two), F.greatest(one, two)).alias("pair")
    side = F.when(one == two, 0).when(one < two, 1).otherwise(2).alias("side")
    # A near member is in the component of the centre; another one of it has only others to meet.
    label = F.when(F.col("far"), F.col("label")).otherwise(F.col("centre_label")).alias("label")
    return held.select(pair, side, "node", label, "n", "size", "weight", "slack", "far", "inside", "marks", "delta")


class _Members:
    """Members of a tile as arrays."""

    def __init__(self, rows: pa.Table, codes: dict):
        self.node = rows.column("node").to_pylist()
        self.code = np.array([codes.setdefault(x, len(codes)) for x in rows.column("label").to_pylist()], np.int64)
        self.n, self.size, self.weight, self.slack = (rows.column(c).to_numpy() for c in ("n", "size", "weight", "slack"))
        self.far, self.inside = (np.array(rows.column(c).to_pylist(), bool) for c in ("far", "inside"))
        self.marks = rows.column("marks").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, MARKS // 64)
        # What a member has more than marks: no mark tells whether another has it too.
        self.unmarked = self.size - np.bitwise_count(self.marks).sum(axis=1, dtype=np.int64)
        delta = rows.column("delta").combine_chunks()
        self.elements, ends = delta.flatten().to_numpy().view(np.uint64), np.cumsum(self.size)
        self.begin, self.end = ends - self.size, ends
        bits = np.zeros((len(self.node), FINE_MARKS), bool)
        bits[np.repeat(np.arange(len(self.node)), self.size), (self.elements % np.uint64(FINE_MARKS)).astype(np.int64)] = True
        self.fine_marks = np.packbits(bits, axis=1).view(np.uint64)
        self.unmarked_finely = self.size - bits.sum(axis=1)

    def delta(self, k: int) -> np.ndarray:
        return self.elements[self.begin[k] : self.end[k]]


def _may_be_alike(a: _Members, i: np.ndarray, b: _Members, j: np.ndarray, percent: int) -> np.ndarray:
    """Which members ``i`` of a and ``j`` of b marks and sizes let be alike."""
    marks = np.ascontiguousarray(b.marks[j].T)
    common = np.zeros((len(i), len(j)), np.uint16)
    for k in range(MARKS // 64):
        common += np.bitwise_count(a.marks[i, k][:, None] & marks[k])
    most = common + np.minimum(a.unmarked[i][:, None], b.unmarked[j])
    near = (100 + percent) * most >= (a.weight[i] - a.slack[i])[:, None] + b.weight[j]
    small, large = np.minimum(a.n[i][:, None], b.n[j]), np.maximum(a.n[i][:, None], b.n[j])
    return near & (100 * small >= percent * large)


def _links_of_tiles(rows: pa.Table, percent: int) -> list[tuple]:
    """Links ``a, b`` that connect the members of one or two tiles as all alike pairs with one not near do."""
    codes: dict = {}
    side = rows.column("side").to_numpy()
    if side.max() == 0:
        a = b = _Members(rows, codes)
    else:
        a, b = (_Members(rows.filter(pa.array(side == k)), codes) for k in (1, 2))
    # The component of each label, as far as links are found.
    root = np.arange(len(codes))
    found = []

    def connect(x: int, others: np.ndarray) -> None:
        own, needed = a.delta(x), a.weight[x] - a.slack[x] + b.weight
        common = np.bitwise_count(a.fine_marks[x] & b.fine_marks[others]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(a.unmarked_finely[x], b.unmarked_finely[others])
        others = others[(100 + percent) * most >= needed[others]]
        while len(others := others[root[b.code[others]] != root[a.code[x]]]):
            for k, y in enumerate(others.tolist()):
                common = len(np.intersect1d(own, b.delta(y), assume_unique=True))
                if (100 + percent) * common >= needed[y]:
                    found.append((min(a.node[x], b.node[y]), max(a.node[x], b.node[y])))
                    root[root == root[b.code[y]]] = root[a.code[x]]
                    break
            others = others[k + 1 :]

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        step = max(1, _CELLS // max(1, len(j)))
        for own in (i[at : at + step] for at in range(0, len(i), step)):
            near = _may_be_alike(a, own, b, j, percent)
            near &= root[a.code[own]][:, None] != root[b.code[j]]
            for k in np.flatnonzero(near.any(axis=1)):
                connect(own[k], j[near[k]])

    (far_a, near_a), (far_b, near_b) = ((np.flatnonzero(m.far), np.flatnonzero(~m.far)) for m in (a, b))
    compare(far_a[~a.inside[far_a]], near_b)
    if a is b:
        for at in range(0, len(far_a), _ROWS):
            compare(far_a[at : at + _ROWS], far_a[at:])
    else:
        compare(far_a, far_b)
        compare(near_a, far_b[~b.inside[far_b]])
    return found


def _links_in_tiles(deltas: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` of crowds but for those to their centres, as a table."""
    tiled = _tiled(deltas, percent)
    ddl = ", ".join(f"{c} {_kind(tiled, 'node')}" for c in "ab")
    schema = arrow_schema(ddl)

    def tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, last = [], None
        for batch in batches:
            pair = batch.column(0).to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(pair)) + 1).tolist(), len(pair)]
            for start, end in zip(starts, starts[1:], strict=False):
                if start == end:
                    continue
                if held and pair[start] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, end - start))
                last = pair[start]
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(alike.__module__)
        for rows in tile_pairs(batches):
            good = _links_of_tiles(rows, percent)
            if good:
                columns = zip(*good, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    streamed = tiled.repartition("pair").sortWithinPartitions("pair")
    return written(in_small_batches(streamed).mapInArrow(run, ddl), "crowd-tiles")


def _all_across(doing: DataFrame, percent: int, near: Column, compared: Sequence[str]) -> DataFrame:
    """All pairs across labels of each group that pass ``near`` (over columns and their ``_x`` twins)."""
    left = doing.select("group", *(F.col(c).alias(f"{c}_x") for c in ("node", "label", "n", *compared)))
    right = doing.where("label != main").select("group", "main", "node", "label", "n", *compared)
    once = (F.col("label_x") == F.col("main")) | (F.col("node_x") < F.col("node"))
    sizes = 100 * F.least("n", "n_x") >= percent * F.greatest("n", "n_x")
    pairs = left.join(right, "group").where((F.col("label") != F.col("label_x")) & once & sizes & near)
    return pairs.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b"))


def links_in_groups(
    groups: DataFrame,
    sets: DataFrame,
    percent: int,
    near: Column | None = None,
    compared: Sequence[str] = (),
    limit: int = LIMIT,
    few: int = FEW,
) -> DataFrame:
    """Links ``a, b`` that connect the nodes of each group as all alike pairs in it do, as tables.

    ``groups`` are ``group, node, label, n`` (``n``: size of the set, ``label``: a node of the component)
    and columns ``compared`` that ``near`` needs to leave out pairs of small groups; ``sets`` are ``node, full``.
    """
    near = F.lit(True) if near is None else near
    own = groups.groupBy("group", "label").agg(F.count("*").alias("n_own"))
    sizes = own.groupBy("group").agg(
        F.sum("n_own").alias("n_all"),
        F.sum(F.col("n_own").cast("double") * F.col("n_own")).alias("squares"),
        F.max_by("label", F.struct("n_own", "label")).alias("main"),
    )
    across = (F.col("n_all").cast("double") * F.col("n_all") - F.col("squares")) / 2
    crowded = across > F.greatest(limit * F.col("n_all"), F.lit(few))
    mixed = sizes.where(across > 0).select("group", "main", crowded.alias("crowded"))
    mixed = written(mixed, "crowd-groups")
    held = groups.join(mixed, "group")
    pairs = written(_all_across(held.where("not crowded"), percent, near, compared).distinct(), "crowd-compared")
    found = confirmed(pairs, sets, percent)
    if mixed.where("crowded").isEmpty():
        return found
    # The groups of one component are one crowd.
    deltas = _deltas(held.where("crowded"), sets, percent, F.xxhash64("main"))
    joined = deltas.where((F.col("weight") <= F.col("slack")) & (F.col("label") != F.col("centre_label")))
    joined = joined.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    return found.unionByName(joined).unionByName(_links_in_tiles(deltas, percent))
