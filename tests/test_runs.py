"""Files, stores, whole runs and streams in a temporary folder."""

from __future__ import annotations

import os
import pathlib
from datetime import datetime, timedelta

import pytest
from conftest import day
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import ARCHIVE_LOG, CONFIG_SILVER, CURRENT, DELETED
from tidemark.operators import logs
from tidemark.operators.evolve import conform
from tidemark.plans import incremental
from tidemark.sources import blocks, files, readers, sinks
from tidemark.sources.hadoop import Folder
from tidemark.sources.store import SnapshotStore
from tidemark.spec import PurgePolicy, TableSpec
from tidemark.streaming.archive import stream_archive

pytestmark = pytest.mark.usefixtures("interpreted")

NOW = datetime(2024, 1, 20, 9, 30)


def put(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="iso-8859-1") as f:
        f.write(text)


def logged(spark, folder, *rows):
    """Append archive-log rows ``(day, path)``."""
    df = spark.createDataFrame([(day(i), p) for i, p in rows], "at timestamp_ntz, path string")
    name = F.element_at(F.split("path", "/"), -1)
    files.append_log(
        df.select(
            F.col("at").alias("ArchiveDatetimeUTC"),
            F.date_format("at", "yyyyMMdd").cast("int").alias("ArchiveyyyyMMddUTC"),
            F.year("at").alias("ArchiveYearUTC"),
            F.month("at").alias("ArchiveMonthUTC"),
            F.dayofmonth("at").alias("ArchiveDayUTC"),
            F.lit(10).alias("OriginalStagingFileSize"),
            name.alias("OriginalStagingFileName"),
            F.col("path").alias("ArchiveFilePath"),
            name.alias("ArchiveFileName"),
            F.lit(False).alias("IsPurged"),
            F.lit(False).alias("IsIgnorable"),
        ),
        f"{folder}/log",
    )


def spec_for(folder, **options):
    settings = {"keys": ["id"], "file_format": "csv", "default_lookback_days": 60, **options}
    return TableSpec(f"{folder}/table", f"{folder}/process", f"{folder}/log", **settings)


def table(spark, spec):
    return SnapshotStore(spark, spec.target, spec.partition_by).read()


# --- files ----------------------------------------------------------------------------------------


def test_archive_moves_ready_files_once(spark, folder):
    put(f"{folder}/in/a b+c.csv", "id\n1\n")
    put(f"{folder}/in/noext", "x")
    put(f"{folder}/in/busy.csv.partial", "id\n")
    put(f"{folder}/in/empty.csv", "")
    put(f"{folder}/in/sub/deep.csv", "id\n")
    catalog = files.file_catalog(spark, f"{folder}/in")
    copies = files.archive_files(catalog, f"{folder}/archive", f"{folder}/log", NOW)
    assert copies.where("ok").count() == 2
    assert sorted(os.listdir(f"{folder}/in")) == ["busy.csv.partial", "empty.csv", "sub"]
    log = {r["OriginalStagingFileName"]: r for r in files.read_log(spark, f"{folder}/log").collect()}
    assert set(log) == {"a b+c.csv", "noext"}
    row = log["a b+c.csv"]
    assert row["ArchiveFilePath"].startswith(f"{folder}/archive/2024/01/20/09_30_")
    assert row["ArchiveFileName"].endswith(".csv") and "." not in log["noext"]["ArchiveFileName"]
    assert (row["ArchiveyyyyMMddUTC"], row["IsPurged"]) == (20240120, False)
    with open(row["ArchiveFilePath"]) as f:
        assert f.read() == "id\n1\n"


def test_archive_after_a_run_that_did_not_remove_originals(spark, folder):
    put(f"{folder}/in/a.csv", "id\n1\n")
    catalog = files.file_catalog(spark, f"{folder}/in")
    files.append_log(files.archive_plan(catalog, f"{folder}/archive", NOW), f"{folder}/log")
    copies = files.archive_files(catalog, f"{folder}/archive", f"{folder}/log", NOW)
    assert copies.count() == 0 and os.listdir(f"{folder}/in") == []
    assert files.read_log(spark, f"{folder}/log").count() == 1


def test_a_failed_copy_keeps_its_original_and_is_not_logged(spark, folder):
    put(f"{folder}/in/good.csv", "id\n1\n")
    catalog = files.file_catalog(spark, f"{folder}/in")
    ghost = catalog.withColumns({"path": F.lit(f"{folder}/in/ghost.csv"), "name": F.lit("ghost.csv")})
    copies = files.archive_files(
        catalog.unionByName(ghost), f"{folder}/archive", f"{folder}/log", NOW
    )
    bad = copies.where("NOT ok").collect()
    assert len(bad) == 1 and "ghost" in bad[0]["source"] and "FileNotFound" in bad[0]["error"]
    assert files.read_log(spark, f"{folder}/log").count() == 1


def test_publish_as_is_and_clear(spark, folder):
    put(f"{folder}/archive/x.csv", "id\n1\n")
    put(f"{folder}/out/old.txt", "old")
    put(f"{folder}/out/log/keep.txt", "keep")
    assert files.clear_folder(spark, f"{folder}/out") == 1
    pending = spark.createDataFrame(
        [(f"{folder}/archive/x.csv", "x.csv")], "ArchiveFilePath string, ArchiveFileName string"
    )
    files.publish_as_is(pending, f"{folder}/out", ".txt").collect()
    assert sorted(os.listdir(f"{folder}/out")) == ["log", "x.txt"]


def test_publish_runs(spark, folder):
    for i in (1, 2, 3):
        put(f"{folder}/x/{i}.csv", f"row id;v\n{i};a\n")
    logged(spark, folder, *[(i, f"{folder}/x/{i}.csv") for i in (1, 2, 3)], (4, f"{folder}/x/no.csv"))
    spec = spec_for(folder, max_files=2)
    with pytest.raises(RuntimeError, match="could not be delivered"):
        incremental.run_publish_files(spark, spec, NOW, f"{folder}/out", ".txt", True)
    assert sorted(os.listdir(f"{folder}/out")) == ["1.txt", "2.txt", "3.txt"]
    log = incremental.read_process_log(spark, spec.process_log)
    assert log.where("ArchiveFilePath IS NOT NULL").count() == 3  # the missing file is not logged
    put(f"{folder}/x/no.csv", "row id;v\n4;a\n")
    assert incremental.run_publish_files(spark, spec, NOW, f"{folder}/out", ".txt").files == 1
    assert len(os.listdir(f"{folder}/out")) == 4

    other = f"{folder}/other"
    logged(spark, other, *[(i, f"{folder}/x/{i}.csv") for i in (1, 2, 3)])
    spec = spec_for(other, max_files=2, select="[row id]", reader_options={"sep": ";"})
    frames = []
    incremental.run_publish(spark, spec, NOW, lambda df: frames.append(df.collect()), whole=True)
    assert [sorted(r["row_id"] for r in rows) for rows in frames] == [["1", "2", "3"]]


def test_failed_publish_is_not_logged(spark, folder):
    put(f"{folder}/x/1.csv", "id\n1\n")
    logged(spark, folder, (1, f"{folder}/x/1.csv"))
    spec = spec_for(folder)

    def broken(df):
        raise OSError("sink is down")

    with pytest.raises(OSError):
        incremental.run_publish(spark, spec, NOW, broken)
    log = incremental.read_process_log(spark, spec.process_log)
    assert log.where("ArchiveFilePath IS NOT NULL").count() == 0


def test_csv_with_different_headers(spark, folder):
    put(f"{folder}/a.csv", "id,v\n1,\xe9\n")
    put(f"{folder}/b.csv", "v,id,w\nx,2,y\n")
    df = readers.read_csv(spark, [f"{folder}/a.csv", f"{folder}/b.csv"], same_header=False)
    rows = {r["id"]: (r["v"], r["w"]) for r in df.collect()}
    assert rows == {"1": ("\xe9", None), "2": ("x", "y")}
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, [f"{folder}/a.csv", f"{folder}/b.csv"]).collect()


def test_jdbc_options():
    read = readers.jdbc_query_options("jdbc:x", "SELECT 1 AS a")
    assert read["query"] == "SELECT 1 AS a"
    split = readers.jdbc_query_options("jdbc:x", "SELECT a FROM t", "a", (1, 9), 4)
    assert split["dbtable"] == "(SELECT a FROM t) tidemark_source" and split["upperBound"] == "9"
    with pytest.raises(ValueError):
        readers.jdbc_query_options("jdbc:x", "q", "a")
    schema = T.StructType().add("a", T.StringType()).add("n", T.IntegerType())
    write = sinks.jdbc_write_options(schema, "jdbc:x", "dbo.t", 200, "HASH(n)")
    assert write["createTableColumnTypes"] == "`a` VARCHAR(200)"
    assert write["createTableOptions"] == "WITH(DISTRIBUTION = HASH(n), HEAP)"
    assert "createTableColumnTypes" not in sinks.jdbc_write_options(schema, "jdbc:x", "t")


def test_register_table(spark, folder):
    logged(spark, folder, (1, "/a"), (2, "/b"))
    assert sinks.archive_table_name("/sales/Orders/") == "archive_sales_orders"
    sinks.register_table(spark, "archive_sales_orders", f"{folder}/log")
    try:
        assert spark.table("archive_sales_orders").count() == 2
        listed = readers.list_tables(spark, "default")
        assert listed.where("tableName = 'archive_sales_orders'").count() == 1
    finally:
        spark.sql("DROP TABLE archive_sales_orders")


# --- store ----------------------------------------------------------------------------------------


def test_store_versions(spark, folder):
    store = SnapshotStore(spark, f"{folder}/t", ["p"])
    assert store.read() is None
    base = spark.createDataFrame([(1, "a"), (2, "b c"), (3, None)], "k int, p string")
    store.commit(base, now=NOW)
    assert sorted(r["k"] for r in store.read().collect()) == [1, 2, 3]
    store.commit(spark.createDataFrame([(9, "a")], "k int, p string"), mode="partitions", now=NOW)
    assert sorted(r["k"] for r in store.read().collect()) == [2, 3, 9]
    more = spark.createDataFrame([(10, "a", 1.5)], "k long, p string, x double")
    store.commit(more, mode="append", now=NOW)
    rows = {r["k"]: (r["p"], r["x"]) for r in store.read().collect()}
    assert rows == {2: ("b c", None), 3: (None, None), 9: ("a", None), 10: ("a", 1.5)}
    assert sorted(r["k"] for r in store.read(1).collect()) == [1, 2, 3]
    assert store.compact(now=NOW) == 2  # the two folders of partition a
    assert store.read().count() == 4
    assert store.vacuum(now=NOW) == 0  # all versions are young
    assert store.vacuum(now=NOW + timedelta(days=9000), min_age=timedelta(0)) > 0
    assert {r["k"] for r in store.read().collect()} == set(rows)
    assert store.history().where("operation = 'VACUUM END'").count() == 2
    assert not incremental.run_upkeep(store, NOW + timedelta(days=9001))


def test_commit_file_is_never_replaced(spark, folder):
    f = Folder(spark, folder)
    f.write_text("c/1.json", "{}")
    with pytest.raises(FileExistsError):
        f.write_text("c/1.json", "{}")
    assert f.read_text("c/1.json") == "{}"


# --- runs -----------------------------------------------------------------------------------------


def test_fact_run_with_chunks_ties_and_empty_extract(spark, folder):
    extracts = {1: "id,v\n1,a\n2,b\n", 2: "id,v\n1,a\n", 3: "id,v\n", 4: "id,v\n2,b\n,z\n"}
    for i, text in extracts.items():
        put(f"{folder}/x/{i}.csv", text)
    # Files 2 and 3 share their archive time: the order of their paths decides.
    logged(spark, folder, (1, f"{folder}/x/1.csv"), (2, f"{folder}/x/2.csv"), (2, f"{folder}/x/3.csv"), (4, f"{folder}/x/4.csv"))
    spec = spec_for(folder, kind="fact", deletes="full", max_files=2)
    result = incremental.run_incremental(spark, spec, NOW)
    assert (result.files, result.folds, result.watermark) == (4, 2, day(4))
    rows = {r["id"]: r[DELETED] for r in table(spark, spec).collect()}
    assert rows == {"1": NOW, "2": None}
    assert incremental.run_incremental(spark, spec, NOW).files == 0
    log = incremental.read_process_log(spark, spec.process_log)
    assert log.where("ArchiveFilePath IS NOT NULL").count() == 4


def test_partitioned_run_leaves_other_partitions_alone(spark, folder):
    for i, rows in ((1, "1,a,x\n2,b,x\n"), (2, "1,a,y\n3,a,z\n")):
        put(f"{folder}/x/{i}.csv", "id,p,v\n" + rows)
    spec = spec_for(folder, kind="scd2", partition_by=["p"], immutable_partitions=True)
    logged(spark, folder, (1, f"{folder}/x/1.csv"))
    incremental.run_incremental(spark, spec, NOW)
    store = SnapshotStore(spark, spec.target, ["p"])
    before = [f for f in store.version().folders if f.endswith("p=b")]
    logged(spark, folder, (2, f"{folder}/x/2.csv"))
    incremental.run_incremental(spark, spec, NOW)
    assert [f for f in store.version().folders if f.endswith("p=b")] == before
    rows = sorted((r["id"], r["v"], r[CURRENT]) for r in store.read().collect())
    assert rows == [("1", "x", False), ("1", "y", True), ("2", "x", True), ("3", "z", True)]


@pytest.mark.parametrize("kind, deletes", [("scd1", "none"), ("scd2", ["g"]), ("fact", ["g"])])
def test_rows_out_of_reach_bypass_the_fold(spark, folder, kind, deletes):
    """With and without the bypass the table is the same."""
    first = "id,g,v\n" + "".join(f"{k},g{k % 5},a\n" for k in range(40)) + ",,n\n"
    put(f"{folder}/x/1.csv", first)
    put(f"{folder}/x/2 +.csv", "id,g,v\n1,g1,b\n2,g2,a\n50,g9,c\n")
    states = []
    for name, limit in (("bypass", 0), ("plain", 1 << 60)):
        root = f"{folder}/{name}"
        logged(spark, root, (1, f"{folder}/x/1.csv"), (2, f"{folder}/x/2 +.csv"))
        spec = spec_for(root, kind=kind, deletes=deletes, max_files=1, bypass_min_bytes=limit)
        incremental.run_incremental(spark, spec, NOW)
        rows = table(spark, spec)
        states.append(sorted(map(str, rows.select(*sorted(rows.columns)).collect())))
    assert states[0] == states[1] and len(states[0]) >= 41


def test_run_cut_off_before_its_log_append(spark, folder):
    put(f"{folder}/x/1.csv", "id,v\n1,a\n")
    logged(spark, folder, (1, f"{folder}/x/1.csv"))
    spec = spec_for(folder, kind="scd2", deletes="full")
    store = SnapshotStore(spark, spec.target)
    archive = files.read_log(spark, spec.archive_log)
    chunk = incremental.next_chunk(archive, 10)
    incremental.apply_chunk(spark, spec, store, chunk, NOW)
    result = incremental.run_incremental(spark, spec, NOW)
    assert result.files == 0 and store.version().number == 1
    assert incremental.read_process_log(spark, spec.process_log).count() >= 1


def test_new_column_mid_stream_and_json(spark, folder):
    put(f"{folder}/x/1.json", '{"id": 1, "n": {"a": 1}}\n{"id": 2, "n": {"a": 2}}\n')
    put(f"{folder}/x/2.json", '{"id": 1, "n": {"a": 1}, "w": "new"}\n{"id": 2, "n": {"a": 2}}\n')
    logged(spark, folder, (1, f"{folder}/x/1.json"), (2, f"{folder}/x/2.json"))
    spec = spec_for(folder, file_format="json", hash_mode="json", max_files=1)
    assert incremental.run_incremental(spark, spec, NOW).folds == 2
    rows = {r["id"]: (r["w"], r["__ArchiveDatetimeUTC"]) for r in table(spark, spec).collect()}
    assert rows == {1: ("new", day(2)), 2: (None, day(1))}


def test_scope_by_file_name_is_replayed(spark, folder):
    """The same file name delivered again deletes the keys it no longer holds."""
    for i, (name, rows) in enumerate((("a", "1\n2\n"), ("b", "3\n"), ("a", "1\n")), start=1):
        put(f"{folder}/x{i}/{name}.csv", "id\n" + rows)
        logged(spark, folder, (i, f"{folder}/x{i}/{name}.csv"))
    spec = spec_for(folder, kind="fact", deletes=["__OriginalStagingFileName"])
    incremental.run_incremental(spark, spec, NOW)
    rows = {r["id"]: r[DELETED] is not None for r in table(spark, spec).collect()}
    assert rows == {"1": False, "2": True, "3": False}


def test_append_run_with_repeated_keys(spark, folder):
    put(f"{folder}/x/1.csv", "id,v\n1,a\n1,b\n")
    put(f"{folder}/x/2.csv", "id,v\n1,b\n1,c\n")
    logged(spark, folder, (1, f"{folder}/x/1.csv"), (2, f"{folder}/x/2.csv"))
    spec = spec_for(folder, kind="scd2_append", on_duplicate="allow", with_primary_key=True)
    incremental.run_incremental(spark, spec, NOW)
    assert sorted(r["v"] for r in table(spark, spec).collect()) == ["a", "b", "c"]


def test_config_run(spark, folder):
    put(f"{folder}/x/1.csv", "id\n1\n")
    spark.range(3).withColumnRenamed("id", "row id").write.parquet(f"{folder}/x/rows.parquet")
    logged(spark, folder, (1, f"{folder}/x/rows.parquet"))
    os.makedirs(f"{folder}/archive/b")
    files.append_log(files.read_log(spark, f"{folder}/log"), f"{folder}/archive/b/t")
    row = Row(IsActive=True, Type="SCD1", BronzeSchema="b", BronzeTable="t", SilverSchema="s", SilverTable="u", BusinessKeyColumns="[row id]", ExtractColumns="*", ExcludeColumns=None, DeleteFilterColumns=None, Tag="Daily, x")
    table_rows = spark.createDataFrame([row], CONFIG_SILVER)
    done = incremental.run_config(spark, table_rows, "DAILY", f"{folder}/tables", f"{folder}/archive", f"{folder}/process", NOW)
    assert [r.files for r in done.values()] == [1]
    twice = [row, Row(**{**row.asDict(), "SilverTable": "v"}), Row(**{**row.asDict(), "SilverTable": "w", "Type": "??"})]
    again = incremental.run_config(spark, spark.createDataFrame(twice, CONFIG_SILVER), "x", f"{folder}/tables", f"{folder}/archive", f"{folder}/process", NOW)
    assert {k[-1]: (r.files, r.error is None) for k, r in again.items()} == {"u": (0, True), "v": (1, True), "w": (0, False)}
    loaded = SnapshotStore(spark, f"{folder}/tables/s/u").read()
    assert loaded.count() == 3 and "row_id" in loaded.columns and "__PrimaryKey" in loaded.columns
    assert incremental.run_config(spark, table_rows, "other", f"{folder}/tables", f"{folder}/archive", f"{folder}/process", NOW) == {}


def test_export_run(spark, folder):
    source = spark.createDataFrame(
        [(1, day(1)), (2, day(3)), (3, day(30))], "k int, __ModifiedDatetimeUTC timestamp_ntz"
    )
    seen = []
    write = lambda df: seen.append(sorted(r["k"] for r in df.collect()))
    assert incremental.run_export(spark, source, f"{folder}/exp", day(10), write) == day(3)
    incremental.run_export(spark, source, f"{folder}/exp", day(40), write)
    assert incremental.run_export(spark, source, f"{folder}/exp", day(50), write, lookback_days=28)
    # The log now ends at day 30; the third run looks 28 days back from there.
    assert seen == [[1, 2, 3], [3], [2, 3]]


def test_purge_run(spark, folder):
    for i in (1, 2, 3):
        put(f"{folder}/x/{i}.csv", "0123456789")
    logged(spark, folder, (1, f"{folder}/x/1.csv"), (1, f"{folder}/x/2.csv"), (2, f"{folder}/x/3.csv"))
    logs_by_name = {"archive_x": f"{folder}/log", "other_x": f"{folder}/log"}
    policy = PurgePolicy(age_days=5, keep_year=False, keep_month=False, keep_week=False)
    dry = incremental.run_purge(spark, logs_by_name, policy, NOW)
    total = {r["ArchiveTable"]: (r["BytesToPurge"], r["BytesToRetain"], r["BytesToPurgeText"]) for r in dry.collect()}
    assert total == {"archive_x": (10, 20, "10.0 B"), None: (10, 20, "10.0 B")}
    assert len(os.listdir(f"{folder}/x")) == 3
    incremental.run_purge(spark, logs_by_name, policy, NOW, dry_run=False)
    assert len(os.listdir(f"{folder}/x")) == 2
    log = files.read_log(spark, f"{folder}/log")
    assert log.count() == 3 and log.where("IsPurged AND PurgeDatetimeUTC IS NOT NULL").count() == 1
    after = incremental.run_purge(spark, logs_by_name, policy, NOW).where("ArchiveTable IS NOT NULL")
    assert after.first()["BytesPurged"] == 10


def log_files(folder):
    return {p: p.stat().st_mtime_ns for p in pathlib.Path(f"{folder}/log").rglob("*.parquet") if "_purged" not in p.parts}


@pytest.mark.parametrize("step", ["removal", "marks"])
def test_purge_cut_off_at_a_step_loses_no_row(spark, folder, monkeypatch, step):
    for i in (1, 2, 3):
        put(f"{folder}/x/{i}.csv", "0123456789")
    logged(spark, folder, (1, f"{folder}/x/1.csv"), (1, f"{folder}/x/2.csv"), (2, f"{folder}/x/3.csv"))
    before = log_files(folder)
    policy = PurgePolicy(age_days=5, keep_year=False, keep_month=False, keep_week=False)

    def purge():
        return incremental.run_purge(spark, {"archive_x": f"{folder}/log"}, policy, NOW, dry_run=False)

    def broken(*args, **kwargs):
        raise RuntimeError("cut off")

    with monkeypatch.context() as cut:
        cut.setattr(files, "remove_files" if step == "removal" else "append_purge_marks", broken)
        with pytest.raises(RuntimeError, match="cut off"):
            purge()
    log = files.read_log(spark, f"{folder}/log")
    assert log.count() == 3 and log.where("IsPurged").count() == 0
    purge()
    log = files.read_log(spark, f"{folder}/log")
    assert log.count() == 3 and log.where("IsPurged").count() == 1
    assert log_files(folder) == before
    # Marked again by a purge that was retried, and twice: nothing changes.
    files.append_purge_marks(log.where("IsPurged"), f"{folder}/log", day(30))
    again = files.read_log(spark, f"{folder}/log")
    assert sorted(map(str, again.collect())) == sorted(map(str, log.collect()))
    assert {r[0] for r in again.where("IsPurged").select("PurgeDatetimeUTC").collect()} == {NOW}
    summary = incremental.run_purge(spark, {"archive_x": f"{folder}/log"}, policy, NOW)
    assert summary.where("ArchiveTable IS NOT NULL").first()["BytesPurged"] == 10


def test_purge_marks_are_read_for_the_days_asked_for(spark, folder):
    logged(spark, folder, (1, "/a/1.csv"), (2, "/a/2.csv"), (3, "/a/3.csv"))
    log = files.read_log(spark, f"{folder}/log")
    for i in (1, 3):
        files.append_purge_marks(log.where(F.col("ArchiveFilePath") == f"/a/{i}.csv"), f"{folder}/log", NOW)
    for old in pathlib.Path(f"{folder}/log").rglob("*20240102/*.parquet"):
        old.write_bytes(b"no longer readable")
    pending = logs.pending_files(files.read_log(spark, f"{folder}/log"), day(2), include_previous=True)
    assert [r["ArchiveFilePath"] for r in pending.collect()] == ["/a/2.csv"]


def test_a_run_reads_the_archive_log_from_its_watermark_on(spark, folder):
    for i in (1, 2, 3):
        put(f"{folder}/x/{i}.csv", f"id,v\n1,{i}\n")
    logged(spark, folder, (1, f"{folder}/x/1.csv"), (2, f"{folder}/x/2.csv"))
    spec = spec_for(folder)
    assert incremental.run_incremental(spark, spec, NOW).files == 2
    logged(spark, folder, (3, f"{folder}/x/3.csv"))
    for old in pathlib.Path(f"{folder}/log").rglob("*20240102/*.parquet"):
        old.write_bytes(b"no longer readable")
    assert incremental.run_incremental(spark, spec, NOW).files == 1
    assert incremental.run_incremental(spark, spec, NOW).files == 0
    applied = incremental.read_process_log(spark, spec.process_log).where("ArchiveFilePath IS NOT NULL")
    assert applied.count() == 3


def test_first_lines_of_any_length_are_told_apart(folder, monkeypatch):
    monkeypatch.setattr(blocks, "_LINE_BLOCK", 4)
    texts = ["id,v\n1", "id,v\r\n2", "id,v", "id,v\r", "id,vv\n", "id\r,v\n", "idid\r\r\n", "idid\n", "", "\n1"]
    seen = {}
    for k, text in enumerate(texts):
        put(f"{folder}/x/{k}.csv", text)
        line = text.split("\n")[0].rstrip("\r")
        digest = blocks.first_line_digest(f"{folder}/x/{k}.csv")
        assert seen.setdefault(line, digest) == digest
    assert len(set(seen.values())) == len(seen)


def test_archive_stream_restarts_from_its_checkpoint(spark, folder):
    def run():
        stream_archive(
            spark, f"{folder}/in", f"{folder}/archive", f"{folder}/log", f"{folder}/cp",
            available_now=True, clock=lambda: NOW,
        ).awaitTermination()
        return files.read_log(spark, f"{folder}/log").count()

    put(f"{folder}/in/a.csv", "id\n1\n")
    assert run() == 1
    put(f"{folder}/in/b.csv", "id\n2\n")
    assert run() == 2
    assert os.listdir(f"{folder}/in") == []
    # The same name with new content, and a file that was empty at first.
    put(f"{folder}/in/a.csv", "id\n3\n")
    put(f"{folder}/in/late.csv", "")
    assert run() == 3
    put(f"{folder}/in/late.csv", "id\n4\n")
    assert run() == 4


def test_files_archived_together_have_times_of_their_own(spark, folder):
    for k in range(5):
        put(f"{folder}/in/{k}.csv", f"id,v\n1,{k}\n")
        os.utime(f"{folder}/in/{k}.csv", (1_700_000_000 + k, 1_700_000_000 + k))
    catalog = files.file_catalog(spark, f"{folder}/in")
    files.archive_files(catalog, f"{folder}/archive", f"{folder}/log", day(19))
    times = [r[0] for r in files.read_log(spark, f"{folder}/log").orderBy("OriginalStagingFileName").select("ArchiveDatetimeUTC").collect()]
    assert times == [day(19) + timedelta(microseconds=k) for k in range(5)]
    put(f"{folder}/in/5.csv", "id,v\n1,5\n")
    files.archive_files(files.file_catalog(spark, f"{folder}/in"), f"{folder}/archive", f"{folder}/log", day(19))
    assert files.read_log(spark, f"{folder}/log").agg(F.max("ArchiveDatetimeUTC")).first()[0] == day(19) + timedelta(microseconds=5)
    spec = spec_for(folder, kind="scd2_append")
    incremental.run_incremental(spark, spec, NOW)
    current = incremental.scd2.current_versions(table(spark, spec), ["id"]).collect()
    assert [r["v"] for r in current] == ["5"]


def test_a_failing_copy_fails_the_stream(spark, folder, monkeypatch):
    put(f"{folder}/in/a.csv", "id\n1\n")
    real = files.archive_files

    def one_fails(catalog, *args):
        ghost = catalog.withColumns({"path": F.lit(f"{folder}/in/ghost.csv"), "name": F.lit("ghost.csv")})
        return real(catalog.unionByName(ghost), *args)

    monkeypatch.setattr(files, "archive_files", one_fails)
    with pytest.raises(Exception, match="ghost"):
        stream_archive(
            spark, f"{folder}/in", f"{folder}/archive", f"{folder}/log", f"{folder}/cp",
            available_now=True, clock=lambda: NOW,
        ).awaitTermination()
    assert files.read_log(spark, f"{folder}/log").count() == 1


def test_schemes():
    from tidemark.sources.blocks import arrow_uri

    for path, want in {
        "/a//b": "/a/b",
        "file:///a": "/a",
        "s3a://b/k": "s3://b/k",
        "gs://b/k": "gs://b/k",
        "hdfs://h:8020/k": "hdfs://h:8020/k",
        "wasbs://c@acc.blob.core.windows.net/k": "abfss://c@acc.dfs.core.windows.net/k",
        "abfss://c@acc.dfs.core.windows.net/k": "abfss://c@acc.dfs.core.windows.net/k",
        "dbfs:/mnt/k": "/dbfs/mnt/k",
    }.items():
        assert arrow_uri(path) == want
    with pytest.raises(ValueError, match="oss"):
        arrow_uri("oss://b/k")


def test_conform_adds_log_columns(spark):
    df = conform(spark.range(1).select(F.lit("x").alias("Notes")), ARCHIVE_LOG)
    assert df.columns == ARCHIVE_LOG.names


def test_clear_scratch_removes_only_this_applications_tables(spark):
    from tidemark import session

    kept = session.written(spark.range(3).toDF("n"), "kept")
    assert kept.count() == 3
    root = Folder(spark, session._scratch_root(spark))
    assert any(n.startswith("kept-") for n in root.names())
    session.clear_scratch(spark)
    assert not root.exists() and Folder(spark, session.shared_dir(spark)).exists()


# --- nothing is lost, and the size of a chunk changes nothing ------------------------------------------


def test_previous_files_do_not_starve_newer_ones(spark, folder):
    for i, v in ((1, "a"), (2, "b"), (3, "c")):
        put(f"{folder}/f{i}", f"id,v\n1,{v}\n")
    logged(spark, folder, (1, f"{folder}/f1"))
    spec = spec_for(folder, include_previous=True, max_files=1)
    incremental.run_incremental(spark, spec, NOW)
    logged(spark, folder, (2, f"{folder}/f2"), (3, f"{folder}/f3"))
    result = incremental.run_incremental(spark, spec, NOW)
    assert result.files == 3
    assert [r["v"] for r in table(spark, spec).collect()] == ["c"]
    published = []
    again = spec_for(f"{folder}", include_previous=True, max_files=1)
    incremental.run_publish(spark, again, NOW, lambda rows: published.append(rows.count()))
    assert published == [1]


def test_odd_paths_find_their_rows(spark, folder):
    names = ["a b.csv", "p%20q.csv", "x+y.csv", "ü.csv"]
    for k, name in enumerate(names):
        put(f"{folder}/odd/{name}", f"id,v\n{k},{k}\n")
    logged(spark, folder, *[(k + 1, f"{folder}//odd/{name}") for k, name in enumerate(names)])
    spec = spec_for(folder)
    assert incremental.run_incremental(spark, spec, NOW).files == 4
    assert table(spark, spec).count() == 4


def test_a_row_without_lineage_fails_the_run(spark, folder):
    put(f"{folder}/f1", "id\n1\n")
    frame = incremental.chunk_frame(
        spark,
        [
            Row(
                ArchiveDatetimeUTC=day(1),
                OriginalStagingFilePath="",
                OriginalStagingFileName="",
                OriginalStagingFileSize=1,
                ArchiveFilePath="/elsewhere",
                ArchiveFileName="",
            )
        ],
    )
    spec = spec_for(folder)
    rows = incremental.load_batches(incremental._read(spark, spec, [f"{folder}/f1"]), spec, frame, 1, NOW)
    with pytest.raises(Exception, match="no pending file has the path"):
        rows.collect()


EVOLVING = [
    [{"id": 1, "v": "a", "w": "x"}, {"id": 2, "v": "b", "w": "y"}],
    [{"v": "a", "id": 1, "w": "x"}, {"v": "b", "id": 2, "w": "y"}],
    [{"id": 1, "v": "c"}, {"id": 2, "v": "b"}, {"id": 3, "v": "d"}],
    [{"id": 2**40, "v": "e", "w": "z", "more": "1"}, {"id": 1, "v": "c", "w": "q", "more": "2"}],
    [{"id": 2, "v": "f"}],
]


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json"])
@pytest.mark.parametrize("kind", ["scd1", "fact", "scd2", "scd2_append"])
def test_chunk_size_changes_nothing(spark, folder, file_format, kind):
    for i, rows in enumerate(EVOLVING, 1):
        wide = any(r["id"] > 2**31 for r in rows)
        types = {"id": "bigint" if wide else "int"}
        schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in rows[0])
        df = spark.createDataFrame([tuple(r.values()) for r in rows], schema).coalesce(1)
        writer = df.write.option("header", "true")
        writer.format(file_format).save(f"{folder}/in/f{i}")
    logged(spark, folder, *[(i, f"{folder}/in/f{i}") for i in range(1, len(EVOLVING) + 1)])
    results = []
    for max_files in (1, 2, 1000):
        spec = spec_for(
            folder, kind=kind, file_format=file_format, max_files=max_files, deletes="none"
        )
        spec = TableSpec(**{**vars(spec), "target": f"{folder}/t{max_files}", "process_log": f"{folder}/p{max_files}"})
        incremental.run_incremental(spark, spec, NOW)
        got = table(spark, spec)
        results.append(sorted(map(str, got.select(*sorted(got.columns)).collect())))
    assert results[0] == results[1] == results[2]
    if kind == "scd1":
        last = {r["id"]: (r["v"], r["w"]) for r in got.select(F.col("id").cast("long").alias("id"), "v", "w").collect()}
        assert last == {1: ("c", "q"), 2: ("f", "y"), 3: ("d", None), 2**40: ("e", "z")}


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tidemark import session

    class Unset:
        def isDefined(self):  # noqa: N802
            return False

    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Unset()})()})()

    fake = type("Session", (), {"sparkContext": Context(), "conf": type("C", (), {"get": lambda self, k, d=None: d})()})()
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.ensure_checkpoint_dir(fake)


def test_invalid_options_are_refused():
    for options in ({"on_duplicate": "latest"}, {"kind": "scd1", "touch_modified": True}, {"kind": "scd1", "on_duplicate": "allow"}):
        with pytest.raises(ValueError):
            spec_for("/nowhere", **options)


def test_skip_applied_and_null_token(spark, folder):
    put(f"{folder}/f1", "id,v,w\n1,,b\n2,b,\n")
    logged(spark, folder, (1, f"{folder}/f1"))
    spec = spec_for(folder, null_token="~", skip_applied=True, include_previous=True)
    incremental.run_incremental(spark, spec, NOW)
    assert incremental.run_incremental(spark, spec, NOW).files == 0
    hashes = {r["__HashDiff"] for r in table(spark, spec).collect()}
    assert len(hashes) == 2
