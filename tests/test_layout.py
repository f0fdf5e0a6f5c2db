"""Key buckets and closed versions apart: the same table, and nothing written that need not be."""

from __future__ import annotations

import hashlib
import re
from dataclasses import replace
from datetime import datetime

import pytest
from test_runs import logged, put, spec_for

from tidemark.names import BATCH, BUCKET, CURRENT, HASH, OPEN, PRIMARY_KEY, START
from tidemark.operators import fold, scd2
from tidemark.operators.common import packed, unpacked
from tidemark.plans import incremental
from tidemark.sources.store import Layout, SnapshotStore
from tidemark.spec import PurgePolicy, TableSpec

pytestmark = pytest.mark.usefixtures("interpreted")

NOW = datetime(2024, 1, 20, 9, 30)

EXTRACTS = [
    [(i, "a") for i in range(30)],
    [(i, "b" if i % 3 == 0 else "a") for i in range(0, 28)] + [(40, "a")],
    [(7, "c")],
    [],
    [(7, "a"), (41, "x"), (3, "b")],
]
KINDS = [
    {"kind": "scd1"},
    {"kind": "scd2"},
    {"kind": "scd2", "deletes": "full"},
    {"kind": "fact", "deletes": "full"},
    {"kind": "scd2_append"},
    {"kind": "scd2_append", "on_duplicate": "allow"},
    {"kind": "scd1", "update_filter": "t.v <> 'b'"},
]


def extracts(spark, folder):
    for n, rows in enumerate(EXTRACTS):
        put(f"{folder}/x/{n}.csv", "id;v\n" + "".join(f"{i};{v}\n" for i, v in rows))
    logged(spark, folder, *[(n + 1, f"{folder}/x/{n}.csv") for n in range(len(EXTRACTS))])


def content(spark, spec):
    table = incremental.store_of(spark, spec).read()
    assert BUCKET not in table.columns and OPEN not in table.columns
    kept = [c for c in table.columns if c not in ("__ArchiveFilePath",)]
    return sorted(map(str, table.select(*sorted(kept)).collect()))


@pytest.mark.parametrize("options", KINDS, ids=str)
def test_a_layout_changes_no_result(spark, folder, options):
    layout = {"key_buckets": 5, "closed_apart": options["kind"] == "scd2"}
    options = {"reader_options": {"sep": ";"}, "max_files": 3, **options}
    found = []
    for name, more in (("plain", {}), ("dealt", layout)):
        extracts(spark, f"{folder}/{name}")
        spec = spec_for(f"{folder}/{name}", **options, **more)
        incremental.run_incremental(spark, spec, NOW)
        found.append(content(spark, spec))
    assert found[0] == found[1]


def test_one_row_rewrites_one_bucket(spark, folder):
    extracts(spark, folder)
    spec = spec_for(folder, reader_options={"sep": ";"}, key_buckets=8, max_files=2)
    incremental.run_incremental(spark, spec, NOW)
    store = incremental.store_of(spark, spec)
    before = store.version().folders
    put(f"{folder}/x/9.csv", "id;v\n5;new\n")
    logged(spark, folder, (10, f"{folder}/x/9.csv"))
    done = incremental.run_incremental(spark, spec, NOW)
    after = store.version().folders
    new = set(after) - set(before)
    assert len(new) == 1 and len(set(before) - set(after)) == 1
    assert next(iter(new)).split("/")[1] == next(iter(set(before) - set(after))).split("/")[1]
    assert done.carried_folders == len(before) - 1
    assert 0 < done.written_bytes < store._folder.size("data")


def test_closed_versions_are_added_to_and_not_read(spark, folder):
    extracts(spark, folder)
    spec = spec_for(folder, kind="scd2", deletes="full", reader_options={"sep": ";"}, closed_apart=True, max_files=2)
    incremental.run_incremental(spark, spec, NOW)
    store = incremental.store_of(spark, spec)
    closed = [f for f in store.version().folders if f"{OPEN}=false" in f]
    assert closed
    put(f"{folder}/x/9.csv", "id;v\n7;a\n41;y\n")
    logged(spark, folder, (10, f"{folder}/x/9.csv"))
    read = []
    scan = SnapshotStore._scan

    def seen(self, folders, schema):
        read.extend(folders)
        return scan(self, folders, schema)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(SnapshotStore, "_scan", seen)
        incremental.run_incremental(spark, spec, NOW)
    assert read and not any(f"{OPEN}=false" in f for f in read)
    after = store.version().folders
    assert set(closed) <= set(after)
    table = store.read()
    assert table.where(CURRENT).count() == 2 and table.where(f"NOT {CURRENT}").count() > 30


def test_a_bucket_whose_open_versions_all_close_keeps_none(spark, folder):
    put(f"{folder}/x/0.csv", "id;v\n1;a\n2;a\n")
    put(f"{folder}/x/1.csv", "id;v\n")
    logged(spark, folder, (1, f"{folder}/x/0.csv"), (2, f"{folder}/x/1.csv"))
    spec = spec_for(
        folder, kind="scd2", deletes="full", reader_options={"sep": ";"}, closed_apart=True, key_buckets=3, max_files=1,
        schema="id string, v string",
    )
    incremental.run_incremental(spark, spec, NOW)
    table = incremental.store_of(spark, spec).read()
    assert [r[CURRENT] for r in table.collect()] == [False, False]


def test_a_new_layout_rewrites_the_table(spark, folder):
    extracts(spark, folder)
    plain = spec_for(folder, reader_options={"sep": ";"})
    incremental.run_incremental(spark, plain, NOW)
    want = content(spark, plain)
    dealt = spec_for(folder, reader_options={"sep": ";"}, key_buckets=4)
    put(f"{folder}/x/9.csv", "id;v\n3;b\n")
    logged(spark, folder, (10, f"{folder}/x/9.csv"))
    incremental.run_incremental(spark, dealt, NOW)
    assert content(spark, dealt) == want
    store = incremental.store_of(spark, dealt)
    assert all(f"{BUCKET}=" in f for f in store.version().folders)
    with pytest.raises(ValueError, match="replace it as a whole"):
        SnapshotStore(spark, plain.target).commit(store.read(), mode="partitions")
    store.compact(now=NOW)
    store.vacuum(now=NOW)
    assert content(spark, dealt) == want


def test_buckets_of_null_and_widened_keys(spark):
    layout = Layout(("k", "l"), 7)
    narrow = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, null), (null, null) AS t(k, l)")
    wide = narrow.selectExpr("cast(k AS long) AS k", "l")
    buckets = [[r[0] for r in df.select(layout.bucket()).collect()] for df in (narrow, wide)]
    assert buckets[0] == buckets[1] and all(0 <= b < 7 for b in buckets[0])


def test_purge_without_a_log_has_the_columns_of_a_summary(spark, folder):
    extracts(spark, folder)
    policy = PurgePolicy(include_prefixes=())
    some = incremental.run_purge(spark, {"archive_x": f"{folder}/log"}, policy, NOW)
    none = incremental.run_purge(spark, {"archive_x": f"{folder}/missing"}, policy, NOW)
    assert none.columns == some.columns and none.where("ArchiveTable IS NOT NULL").count() == 0


def exchanges_by_key(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(set(re.findall(r"Exchange hashpartitioning.*plan_id=(\d+)", plan)))


def test_hashes_cross_a_shuffle_as_bytes_and_come_back(spark):
    rows = spark.sql(f"SELECT id, IF(id % 4 = 0, sha2(cast(id AS string), 256), element_at(array('ABCD', 'x', ''), cast(id % 4 AS int))) AS {HASH} FROM range(9)")
    rows = rows.unionByName(spark.createDataFrame([(9, None), (10, "abc"), (11, "0abc")], f"id long, {HASH} string"))
    narrow = packed(rows)
    assert narrow.where(f"{HASH} IS NULL").count() == 7
    assert sorted(unpacked(narrow).collect()) == sorted(rows.collect())


def test_hashes_of_a_run_are_those_of_its_files(spark, folder):
    """One schema: hashed behind the shuffle. A wider column, or files that differ: before it."""
    put(f"{folder}/x/0.csv", "id;v\n1;1\n2;2\n")
    put(f"{folder}/x/1.csv", "id;v\n1;1\n2;3\n;4\n")
    logged(spark, folder, (1, f"{folder}/x/0.csv"))
    spec = spec_for(folder, reader_options={"sep": ";"}, key_buckets=3, max_files=1)
    incremental.run_incremental(spark, spec, NOW)
    logged(spark, folder, (2, f"{folder}/x/1.csv"))
    incremental.run_incremental(spark, spec, NOW)
    want = {k: hashlib.sha256(f"{k}||{v}".encode()).hexdigest() for k, v in (("1", "1"), ("2", "3"))}
    assert {r["id"]: r[HASH] for r in incremental.store_of(spark, spec).read().collect()} == want


def test_hashed_late_only_where_the_files_agree(spark):
    spec = TableSpec(target="", process_log="", archive_log="", keys=["id"])
    one, other = (spark.createDataFrame([], s) for s in ("id int, v int", "id int, v long"))
    odd = spark.createDataFrame([], f"id int, {HASH} string")
    batches = incremental.shape_extract(one, spec)
    late = incremental._late_hashes
    assert list(late([one, one], spec, None, batches)) == [HASH]
    keyed = replace(spec, with_primary_key=True)
    assert list(late([one], keyed, None, incremental.shape_extract(one, keyed))) == [HASH, PRIMARY_KEY]
    assert late([one, other], spec, None, batches) == {}
    assert late([one], spec, other, batches) == {}
    assert late([odd], spec, None, incremental.shape_extract(odd, spec)) == {}


def test_a_bucketed_run_shuffles_once(spark, folder):
    """What a fold deals by bucket is written as it is."""
    rows = spark.range(50).selectExpr("id AS k", f"cast(id AS string) AS {HASH}", f"1 AS {BATCH}")
    layout = Layout(("k",), 4)
    dealt = fold.scd1_fold(None, rows, ["k"], deal_by=layout.dealing(8))
    assert exchanges_by_key(dealt) == 1 and dealt.columns == ["k", HASH]
    store = SnapshotStore(spark, f"{folder}/t", layout=layout)
    seen = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("tidemark.sources.store.rebalanced", lambda df, by: seen.append(by) or df)
        store.commit(dealt, dealt=True)
    assert not seen and sorted(r["k"] for r in store.read().collect()) == list(range(50))
    assert len(store.version().folders) == 4


def test_current_versions_shuffle_once(spark):
    rows = spark.sql(
        f"SELECT k, cast(s AS timestamp_ntz) AS {START}, sha2(s, 256) AS {HASH} FROM VALUES"
        " (1, '2024-01-01'), (1, '2024-01-02'), (1, '2024-01-02'), (null, '2024-01-01'), (2, null) AS t(k, s)"
    )
    current = scd2.current_versions(rows, ["k"])
    assert exchanges_by_key(current) == 1 and current.columns == rows.columns
    assert sorted((str(r["k"]), r[START].day) for r in current.collect()) == [("1", 2), ("1", 2), ("None", 1)]
