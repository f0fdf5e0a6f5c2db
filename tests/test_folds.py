"""One-pass folds and single-batch merges against a brute-force replay."""

from __future__ import annotations

import random

import model
import pytest
from conftest import day
from pyspark.sql import functions as F

from tidemark.functions.hashing import with_row_hash
from tidemark.names import ARCHIVED, BATCH, CURRENT, DELETED, END, MODIFIED, START
from tidemark.operators import fold, merge, scd2
from tidemark.operators.common import with_audit
from tidemark.session import written

pytestmark = pytest.mark.usefixtures("interpreted")

SCHEMA = "k int, v string, g string"
N_KEYS = 14


def random_batches(seed: int, n: int, scoped: bool = False) -> list[list[dict]]:
    """Batches over few keys, one of them NULL; some empty, some partial, with NULL values."""
    rng = random.Random(seed)
    keys = [None, *range(1, N_KEYS)]
    home = {k: rng.choice(["a", "b", "c", None]) for k in keys}
    batches = []
    for _ in range(n):
        if rng.random() < 0.12:
            batches.append([])
            continue
        reach = set(rng.sample(["a", "b", "c", None], 2)) if scoped else {"a", "b", "c", None}
        rows = []
        for k in keys:
            if rng.random() < 0.1:
                home[k] = rng.choice(["a", "b", "c"])
            if home[k] in reach and rng.random() < 0.7:
                rows.append({"k": k, "v": rng.choice(["x", "y", None]), "g": home[k]})
        batches.append(rows)
    return batches


def frame(spark, rows):
    return spark.createDataFrame([(r["k"], r["v"], r["g"]) for r in rows], SCHEMA)


def tagged(spark, rows, i):
    df = with_row_hash(frame(spark, rows))
    return with_audit(df, day(i), day(i), f"f{i}", f"n{i}")


def backlog(spark, batches):
    rows = [(r["k"], r["v"], r["g"], i) for i, b in enumerate(batches, 1) for r in b]
    df = spark.createDataFrame(rows, SCHEMA + f", {BATCH} int")
    df = with_row_hash(df, ["k", "v", "g"])
    at = F.expr(f"TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, {BATCH})")
    return with_audit(df, at, at, F.concat(F.lit("f"), BATCH), F.concat(F.lit("n"), BATCH))


def log(spark, n):
    rows = [(i, day(i), day(i)) for i in range(1, n + 1)]
    return spark.createDataFrame(
        rows, f"{BATCH} int, {ARCHIVED} timestamp_ntz, {MODIFIED} timestamp_ntz"
    )


def key_order(t):
    return tuple((x is not None, str(x)) for x in t)


def found(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key_order)


def expected(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=key_order)


@pytest.mark.parametrize("seed", range(2))
def test_scd1(spark, seed):
    first, *rest = random_batches(seed, 5)
    want = model.scd1({}, first, day(0))
    target = tagged(spark, first, 0)
    looped = target
    for i, b in enumerate(rest, 1):
        want = model.scd1(want, b, day(i))
        looped = written(merge.scd1_merge(looped, tagged(spark, b, i), ["k"]), "step")
    expect = expected(want.values(), "k", "v", "g", "at")
    folded = fold.scd1_fold(target, backlog(spark, rest), ["k"])
    assert found(folded, "k", "v", "g", ARCHIVED) == expect
    assert found(looped, "k", "v", "g", ARCHIVED) == expect


def test_scd1_without_table(spark):
    batches = random_batches(11, 4)
    want: dict = {}
    for i, b in enumerate(batches, 1):
        want = model.scd1(want, b, day(i))
    folded = fold.scd1_fold(None, backlog(spark, batches), ["k"])
    assert found(folded, "k", "v", "g", ARCHIVED) == expected(want.values(), "k", "v", "g", "at")


@pytest.mark.parametrize("deletes", ["none", "full", "scoped"])
@pytest.mark.parametrize("seed", range(2))
def test_fact(spark, seed, deletes):
    scoped = deletes == "scoped"
    first, *rest = random_batches(100 + seed, 5, scoped)
    table = model.fact({}, first, day(-1), "none")
    rng = random.Random(seed)
    for row in table.values():
        row["gone"] = day(-1) if rng.random() < 0.3 else None
    target = tagged(spark, first, -1).drop(DELETED)
    stamps = spark.createDataFrame(
        [(k, r["gone"]) for k, r in table.items()], f"k2 int, {DELETED} timestamp_ntz"
    )
    target = target.join(stamps, target.k.eqNullSafe(stamps.k2)).drop("k2")
    looped, want = target, table
    how = ["g"] if scoped else deletes
    for i, b in enumerate(rest, 1):
        want = model.fact(want, b, day(i), "full" if deletes == "full" else deletes)
        step = merge.fact_apply(looped, tagged(spark, b, i), ["k"], day(i), how)
        looped = written(step, "step")
    expect = expected(want.values(), "k", "v", "g", "at", "gone")
    folded = fold.fact_fold(target, backlog(spark, rest), ["k"], log(spark, len(rest)), how)
    assert found(folded, "k", "v", "g", ARCHIVED, DELETED) == expect
    assert found(looped, "k", "v", "g", ARCHIVED, DELETED) == expect


def versions(df):
    df = df.withColumn(
        "until", F.when(F.col(CURRENT), F.lit(model.OPEN)).otherwise(F.col(END).cast("string"))
    )
    return found(df, "k", "v", "g", START, "until")


def wanted_versions(rows):
    rows = [{**r, "until": model.OPEN if r["end"] == model.OPEN else str(r["end"])} for r in rows]
    return expected(rows, "k", "v", "g", "start", "until")


@pytest.mark.parametrize("deletes", ["none", "full", "scoped"])
@pytest.mark.parametrize("seed", range(2))
def test_scd2(spark, seed, deletes):
    scoped = deletes == "scoped"
    first, *rest = random_batches(200 + seed, 5, scoped)
    want = model.scd2([], first, day(0), "none")
    target = scd2.scd2_init(tagged(spark, first, 0), day(0))
    looped = target
    how = ["g"] if scoped else deletes
    for i, b in enumerate(rest, 1):
        want = model.scd2(want, b, day(i), deletes)
        step = scd2.scd2_merge(looped, tagged(spark, b, i), ["k"], day(i), how)
        looped = written(step, "step")
    folded = fold.scd2_fold(target, backlog(spark, rest), ["k"], log(spark, len(rest)), how)
    assert versions(folded) == wanted_versions(want)
    assert versions(looped) == wanted_versions(want)
    check_intervals(folded)


def check_intervals(df):
    """One current version per key at most; intervals of a key do not overlap."""
    by_key: dict = {}
    for r in df.collect():
        by_key.setdefault(r["k"], []).append((r[START], r[END], r[CURRENT]))
    for spans in by_key.values():
        spans.sort()
        assert sum(c for _, _, c in spans) <= 1
        for (_, end, current), (start, _, _) in zip(spans, spans[1:], strict=False):
            assert not current and end <= start


def test_scd2_on_table_with_closed_versions(spark):
    """A second fold starts from the result of the first one."""
    batches = random_batches(31, 8)
    want: list = []
    for i, b in enumerate(batches, 1):
        want = model.scd2(want, b, day(i), "full")
    head = fold.scd2_fold(None, backlog(spark, batches[:4]), ["k"], log(spark, 4), "full")
    tail = backlog(spark, [[], [], [], [], *batches[4:]])
    tail = tail.withColumn(BATCH, F.col(BATCH) - 4)
    later = log(spark, 8).where(F.col(BATCH) > 4).withColumn(BATCH, F.col(BATCH) - 4)
    both = fold.scd2_fold(head, tail, ["k"], later, "full")
    assert versions(both) == wanted_versions(want)


@pytest.mark.parametrize("seed", range(2))
def test_append(spark, seed):
    first, *rest = random_batches(300 + seed, 5)
    want = model.append([], first, day(0))
    target = tagged(spark, first, 0).withColumn(START, F.col(ARCHIVED))
    looped = target
    for i, b in enumerate(rest, 1):
        want = model.append(want, b, day(i))
        looped = written(scd2.scd2_append(looped, tagged(spark, b, i), ["k"], day(i)), "step")
    fresh = fold.append_fold(target, backlog(spark, rest), ["k"])
    expect = expected(want, "k", "v", "g", "start")
    assert found(target.unionByName(fresh), "k", "v", "g", START) == expect
    assert found(looped, "k", "v", "g", START) == expect
    current = scd2.current_versions(looped, ["k"])
    assert current.groupBy("k").count().where("count > 1").count() == 0


def test_append_keeps_repeated_keys_of_a_batch(spark):
    rows = [{"k": 1, "v": "x", "g": None}, {"k": 1, "v": "y", "g": None}, {"k": 1, "v": "x", "g": None}]
    first = scd2.scd2_append(None, tagged(spark, rows, 0), ["k"], day(0))
    assert first.count() == 3
    again = scd2.scd2_append(first, tagged(spark, rows, 1), ["k"], day(1))
    assert again.count() == 3


@pytest.mark.parametrize("rule", ["t.v <> 'x'", "s.v > t.v", "s.g IS NULL OR t.v IS NULL"])
def test_filtered_fold(spark, rule):
    """A filter on the stored row: the fold equals merging batch by batch."""
    first, *rest = random_batches(700 + len(rule), 6)
    target = tagged(spark, first, 0).withColumn("own", F.lit(1))
    looped = target
    for i, b in enumerate(rest, 1):
        looped = written(merge.scd1_merge(looped, tagged(spark, b, i), ["k"], rule), "step")
    once = fold.scd1_filtered_fold(target, backlog(spark, rest), ["k"], rule)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    columns = ("k", "v", "g", "own", MODIFIED, ARCHIVED)
    assert found(once, *columns) == found(looped, *columns)
    none = fold.scd1_filtered_fold(None, backlog(spark, [first, *rest]), ["k"], rule)
    assert none.count() == looped.select("k").distinct().count()


def test_filtered_fold_refuses_repeated_keys(spark):
    rows = [{"k": 1, "v": "x", "g": None}, {"k": 1, "v": "y", "g": None}]
    with pytest.raises(Exception, match="more than one row"):
        fold.scd1_filtered_fold(None, backlog(spark, [rows]), ["k"], "true").collect()


@pytest.mark.parametrize("turned", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_append_to_tied_current_versions(spark, seed, turned):
    """Two current versions of one start, in either order: a row equal to any of them is not appended."""
    rng = random.Random(seed)
    first = [{"k": k, "v": v, "g": None} for k in range(6) for v in ("x", "y")]
    if turned:
        first.reverse()
    rest = [[{"k": k, "v": rng.choice("xyz"), "g": None} for k in range(7) if rng.random() < 0.8] for _ in range(5)]
    want = model.append([], first, day(0))
    for i, b in enumerate(rest, 1):
        want = model.append(want, b, day(i))
    target = tagged(spark, first, 0).withColumn(START, F.col(ARCHIVED))
    fresh = fold.append_fold(target, backlog(spark, rest), ["k"])
    assert found(target.unionByName(fresh), "k", "v", "g", START) == expected(want, "k", "v", "g", "start")


def test_applying_twice_changes_nothing(spark):
    first, second = random_batches(5, 2)
    target = scd2.scd2_init(tagged(spark, first, 0), day(0))
    once = scd2.scd2_merge(target, tagged(spark, second, 1), ["k"], day(1), "full")
    twice = scd2.scd2_merge(once, tagged(spark, second, 2), ["k"], day(2), "full")
    assert versions(once) == versions(twice)


def test_empty_full_extract_deletes_everything(spark):
    rows = random_batches(8, 1)[0] or [{"k": 1, "v": "x", "g": "a"}]
    target = tagged(spark, rows, 0)
    empty = tagged(spark, [], 1)
    gone = merge.fact_apply(target, empty, ["k"], day(1), "full")
    assert gone.where(F.col(DELETED).isNull()).count() == 0
    folded = fold.fact_fold(target, backlog(spark, [[]]), ["k"], log(spark, 1), "full")
    assert folded.where(F.col(DELETED) == F.lit(day(1)).cast("timestamp_ntz")).count() == len(rows)


def test_repeated_key_in_a_batch_fails(spark):
    rows = [{"k": 1, "v": "x", "g": "a"}, {"k": 1, "v": "y", "g": "a"}]
    target = tagged(spark, rows[:1], 0)
    for run in (
        lambda: merge.scd1_merge(target, tagged(spark, rows, 1), ["k"]),
        lambda: fold.scd1_fold(target, backlog(spark, [rows]), ["k"]),
        lambda: fold.scd2_fold(None, backlog(spark, [rows]), ["k"], log(spark, 1)),
        lambda: fold.fact_fold(None, backlog(spark, [rows]), ["k"], log(spark, 1)),
    ):
        with pytest.raises(Exception, match="more than one row for a business key"):
            run().collect()
    assert fold.scd1_fold(None, backlog(spark, [rows]), ["k"], on_duplicate="any").count() == 1
    newest = merge.scd1_merge(
        target, tagged(spark, rows, 1), ["k"], on_duplicate="latest", newest_by="v"
    )
    assert found(newest, "k", "v") == [(1, "y")]


def test_null_shift_collision_keeps_stored_content_on_return(spark):
    """('x', NULL) and (NULL, 'x') hash alike: a returning row refreshes the audit columns only."""
    before = [{"k": 1, "v": "x", "g": None}]
    after = [{"k": 1, "v": None, "g": "x"}]
    want = model.fact({}, before, day(1), "full")
    for i, b in ((2, []), (3, after)):
        want = model.fact(want, b, day(i), "full")
    folded = fold.fact_fold(None, backlog(spark, [before, [], after]), ["k"], log(spark, 3))
    got = found(folded, "k", "v", "g", ARCHIVED, DELETED)
    assert got == expected(want.values(), "k", "v", "g", "at", "gone")


def test_scope_on_audit_column_needs_replay(spark):
    rows = backlog(spark, [[{"k": 1, "v": "x", "g": "a"}]])
    with pytest.raises(fold.NeedsReplay):
        fold.fact_fold(None, rows, ["k"], log(spark, 1), ["__OriginalStagingFileName"])


def test_type_2_merge_refuses_other_policies(spark):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    for policy in ("latest", "allow"):
        with pytest.raises(ValueError):
            scd2.scd2_merge(rows, rows, ["k"], day(1), on_duplicate=policy)
