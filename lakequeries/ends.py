"""Sources, sinks, whole runs and streams, on files that Spark derives from the shared tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from lakequeries.extracts import (
    ORDER_COLUMNS,
    SNAPSHOTS,
    T0_SQL,
    T1_SQL,
    TAGGED_COLUMNS,
    names,
    orders_at_t0,
    orders_at_t1,
    read,
    snapshot,
    snapshot_sql,
    snapshot_time,
    ts,
)
from lakequeries.folds import (
    append_step,
    fact_step,
    opened_sql,
    replay_sql,
    scd1_step,
    scd2_step,
    unstamped_sql,
)
from tidemark.names import ARCHIVE_LOG, CONFIG_SILVER, DELETED
from tidemark.operators.evolve import conform
from tidemark.plans.incremental import (
    run_config,
    run_incremental,
    run_publish,
    run_query_source,
    store_of,
)
from tidemark.session import scratch_path
from tidemark.sources import files, readers, sinks
from tidemark.sources.store import SnapshotStore
from tidemark.spec import TableSpec
from tidemark.streaming.apply import stream_apply
from tidemark.streaming.archive import stream_archive as start_archive

_RUN_AT = datetime(2024, 3, 15, 12, 0, 0)


# --- scans ----------------------------------------------------------------------------------------


def _orders_as_text(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order key"),
        "o_orderstatus",
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


def extract_parquet(spark, sf_dir):
    """Several part files in one scan, with the folder each row came from."""
    path = scratch_path(spark, "extract-parquet")
    read(spark, sf_dir, "lineitem").write.parquet(path)
    df = readers.read_extracts(spark, [path])
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        (F.col(readers.SOURCE_PATH) == path.replace("file:", "")).alias("from_folder"),
    )


def extract_csv(spark, sf_dir):
    path = scratch_path(spark, "extract-csv")
    _orders_as_text(spark, sf_dir).write.csv(path, header=True, encoding="ISO-8859-1")
    return readers.read_csv(spark, [path]).withColumnRenamed("order key", "order_key")


def extract_json(spark, sf_dir):
    path = scratch_path(spark, "extract-json")
    events = read(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.from_json("props", "struct<k:int>").alias("props")
    )
    events.write.json(path)
    df = readers.read_json(spark, [path])
    return df.select("event_id", "event_type", "value", F.col("props.k").alias("k"))


def merge_schema_scan(spark, sf_dir):
    """Two extracts, the later one with a new column."""
    items = read(spark, sf_dir, "lineitem")
    paths = [scratch_path(spark, f"merge-schema-{i}") for i in (1, 2)]
    recent = F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    items.where(~recent).select("l_orderkey", "l_linenumber").write.parquet(paths[0])
    items.where(recent).select("l_orderkey", "l_linenumber", "l_shipdate").write.parquet(paths[1])
    return readers.read_parquet(spark, paths)


def file_catalog(spark, sf_dir):
    """Folders of a partitioned write, listed as files."""
    path = scratch_path(spark, "catalog")
    orders = read(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    sinks.rebalanced(orders, ["o_year"]).write.partitionBy("o_year").parquet(path)
    listed = files.ready_files(files.file_catalog(spark, path, recursive=True))
    folder = F.regexp_extract("path", r"(o_year=[^/]+)/[^/]+$", 1)
    return listed.select(folder.alias("folder")).distinct()


# --- archive plan -----------------------------------------------------------------------------------


def archive_plan(spark, sf_dir):
    """One event is one ingest file; small ones are still being uploaded or empty."""
    events = read(spark, sf_dir, "events")
    suffix = F.expr("CASE WHEN value < 5 THEN '.json.partial' ELSE '.json' END")
    name = F.concat(F.lit("event_"), F.col("event_id").cast("string"), suffix)
    catalog = events.select(
        F.concat(F.lit("/lake/ingest/"), F.col("event_type"), F.lit("/"), name).alias("path"),
        name.alias("name"),
        F.expr("CASE WHEN value < 6 THEN 0 ELSE cast(floor(value * 1000) AS bigint) END").alias(
            "size"
        ),
        F.col("ts").alias("modificationTime"),
    )
    return files.archive_plan(catalog, "/lake/archive", _RUN_AT).select(
        "ArchiveDatetimeUTC",
        "ArchiveyyyyMMddUTC",
        "OriginalStagingFilePath",
        "OriginalStagingFileSize",
        "ArchiveFilePath",
        "ArchiveFileName",
        "IsPurged",
    )


# --- publish and stage ------------------------------------------------------------------------------


def _archived_texts(spark, sf_dir):
    """One CSV extract per priority, and the log of these files."""
    path = scratch_path(spark, "staged")
    orders = _orders_as_text(spark, sf_dir).withColumn("p", F.col("o_orderpriority"))
    writer = sinks.rebalanced(orders, ["p"]).write.partitionBy("p")
    writer.csv(path, header=True, sep=readers.PUBLISH_SEPARATOR)
    listed = files.file_catalog(spark, path, recursive=True)
    day = F.regexp_extract("path", "/p=([0-9])-", 1)
    return conform(
        listed.select(
            F.concat(F.lit("2024-02-0"), day).cast("timestamp_ntz").alias("ArchiveDatetimeUTC"),
            F.col("path").alias("ArchiveFilePath"),
            F.col("name").alias("ArchiveFileName"),
            F.concat(F.lit("orders_"), day, F.lit(".csv")).alias("OriginalStagingFileName"),
            F.concat(F.lit("2024020"), day).cast("int").alias("ArchiveyyyyMMddUTC"),
            F.lit(False).alias("IsPurged"),
            F.lit(False).alias("IsIgnorable"),
        ),
        ARCHIVE_LOG,
    )


def stage_union(spark, sf_dir):
    """All pending CSV files in one frame: selected columns, clean names, lineage."""
    log = _archived_texts(spark, sf_dir)
    paths = [r[0] for r in log.select("ArchiveFilePath").collect()]
    extracts = readers.read_extracts(
        spark, paths, "csv", {"sep": readers.PUBLISH_SEPARATOR, "encoding": "UTF-8"}
    )
    return sinks.staged_rows(extracts, log, "[order key], o_orderdate, [o_totalprice]")


def publish_select(spark, sf_dir):
    """Pending CSV files published as Parquet by a run, and read back."""
    root = scratch_path(spark, "publish")
    files.append_log(_archived_texts(spark, sf_dir), f"{root}/log")
    spec = TableSpec(
        target="",
        process_log=f"{root}/process",
        archive_log=f"{root}/log",
        keys=["order key"],
        file_format="csv",
        select="[order key], o_orderstatus",
        reader_options={"sep": readers.PUBLISH_SEPARATOR, "encoding": "UTF-8"},
        default_lookback_days=90,
    )
    run_publish(spark, spec, _RUN_AT, lambda rows: sinks.publish(rows, f"{root}/out"))
    return spark.read.parquet(f"{root}/out")


# --- whole runs -------------------------------------------------------------------------------------


def _archive_of_snapshots(spark, sf_dir, root, folder="archive", log="log", logged=None):
    """Every snapshot of the orders as an archived extract, and the log (of some of them)."""
    numbers = (0, *SNAPSHOTS)
    extracts = [
        snapshot(spark, sf_dir, i).select(*ORDER_COLUMNS).withColumn("extract", F.lit(i))
        for i in numbers
    ]
    together = reduce(lambda a, b: a.unionByName(b), extracts)
    together.write.partitionBy("extract").parquet(f"{root}/{folder}")
    _log_snapshots(spark, f"{root}/{folder}", f"{root}/{log}", numbers if logged is None else logged)


def _log_snapshots(spark, archive, log_path, numbers):
    rows = [(snapshot_time(i), f"{archive}/extract={i}", f"orders_{i}.parquet") for i in numbers]
    extracts = spark.createDataFrame(rows, "at string, ArchiveFilePath string, name string")
    at = F.col("at").cast("timestamp_ntz")
    files.append_log(
        extracts.select(
            at.alias("ArchiveDatetimeUTC"),
            F.date_format(at, "yyyyMMdd").cast("int").alias("ArchiveyyyyMMddUTC"),
            F.col("name").alias("OriginalStagingFileName"),
            "ArchiveFilePath",
            F.col("name").alias("ArchiveFileName"),
            F.lit(False).alias("IsPurged"),
            F.lit(False).alias("IsIgnorable"),
        ),
        log_path,
    )


def _spec(root, kind, **options):
    return TableSpec(
        target=f"{root}/table",
        process_log=f"{root}/process",
        archive_log=f"{root}/log",
        keys=["o_orderkey"],
        kind=kind,
        default_lookback_days=90,
        **options,
    )


def _run(spark, sf_dir, kind, **options):
    root = scratch_path(spark, f"run-{kind}")
    _archive_of_snapshots(spark, sf_dir, root)
    spec = _spec(root, kind, **options)
    run_incremental(spark, spec, _RUN_AT)
    return store_of(spark, spec).read()


_STATE = [*ORDER_COLUMNS, "__HashDiff", "__ArchiveDatetimeUTC", "__OriginalStagingFileName"]
_INTERVAL = ["__StartDatetimeUTC", "__EndDatetimeUTC", "__Current"]


def incremental_run(spark, sf_dir):
    """Seven pending extracts in two folds into a type-2 table, partitioned by priority."""
    table = _run(spark, sf_dir, "scd2", deletes="full", max_files=4, partition_by=["o_orderpriority"])
    return table.select(*_STATE, *_INTERVAL)


def incremental_run_buckets(spark, sf_dir):
    """The same backlog into folders by key, a file at a time: each run writes what its keys touch."""
    table = _run(spark, sf_dir, "scd1", max_files=1, key_buckets=16)
    return table.select(*_STATE)


def incremental_run_closed_apart(spark, sf_dir):
    """A type-2 table whose closed versions are only added to."""
    table = _run(spark, sf_dir, "scd2", deletes="full", max_files=2, key_buckets=4, closed_apart=True)
    return table.select(*_STATE, *_INTERVAL)


def incremental_run_fact(spark, sf_dir):
    table = _run(spark, sf_dir, "fact", deletes="full", max_files=3)
    return table.select(*_STATE, F.col(DELETED).isNotNull().alias("is_deleted"))


def incremental_run_append(spark, sf_dir):
    table = _run(spark, sf_dir, "scd2_append", max_files=3)
    return table.select(*_STATE, "__StartDatetimeUTC")


def incremental_run_replay(spark, sf_dir):
    """An update filter needs the row that the files before left: they are folded key by key."""
    table = _run(spark, sf_dir, "scd1", update_filter="t.o_orderpriority <> '1-URGENT'")
    return table.select(*_STATE)


def incremental_run_previous(spark, sf_dir):
    """Files at the watermark are applied again; the newer ones after them all arrive."""
    root = scratch_path(spark, "run-previous")
    _archive_of_snapshots(spark, sf_dir, root, logged=(0,))
    spec = _spec(root, "scd1", include_previous=True, max_files=1)
    run_incremental(spark, spec, _RUN_AT)
    _log_snapshots(spark, f"{root}/archive", f"{root}/log", SNAPSHOTS)
    run_incremental(spark, spec, _RUN_AT)
    return SnapshotStore(spark, spec.target).read().select(*_STATE)


def incremental_run_odd_paths(spark, sf_dir):
    """A doubled slash, a space, a plus and a per cent sign in the paths of the log."""
    root = scratch_path(spark, "run-odd")
    _archive_of_snapshots(spark, sf_dir, root, folder="/a b+c%20d")
    spec = _spec(root, "scd1")
    run_incremental(spark, spec, _RUN_AT)
    return SnapshotStore(spark, spec.target).read().select(*_STATE)


def config_run(spark, sf_dir):
    """Two targets of one source, each with a process log of its own, and a row without a type."""
    root = scratch_path(spark, "config-run")
    _archive_of_snapshots(spark, sf_dir, root, log="archives/bronze/orders")
    kinds = {"orders_scd1": "SCD1", "orders_fact": "FACT", "orders_untyped": ""}
    rows = [
        (True, kind, "bronze", "orders", "silver", name, "o_orderkey", "*", None, None, "daily")
        for name, kind in kinds.items()
    ]
    columns = (
        "IsActive boolean, Type string, BronzeSchema string, BronzeTable string, SilverSchema string, "
        "SilverTable string, BusinessKeyColumns string, ExtractColumns string, ExcludeColumns string, "
        "DeleteFilterColumns string, Tag string"
    )
    config = conform(spark.createDataFrame(rows, columns), CONFIG_SILVER)
    run_config(spark, config, "daily", f"{root}/tables", f"{root}/archives", f"{root}/logs", _RUN_AT)
    tables = []
    for name in ("orders_scd1", "orders_fact"):
        table = SnapshotStore(spark, f"{root}/tables/silver/{name}").read()
        tables.append(table.select(F.lit(name).alias("target"), *_STATE))
    return tables[0].unionAll(tables[1])


def sql_source_scd1(spark, sf_dir):
    """Two results of a query, one after the other, kept as a type-1 table without lineage."""
    path = f"{scratch_path(spark, 'sql-source')}/table"
    for source, hour in ((orders_at_t0, 0), (orders_at_t1, 12)):
        run_query_source(
            spark,
            source(spark, sf_dir),
            path,
            ["o_orderkey"],
            datetime(2024, 2, 1, hour),
            exclude=["o_custkey"],
        )
    return SnapshotStore(spark, path).read()


# --- streams ----------------------------------------------------------------------------------------


def stream_archive(spark, sf_dir):
    """Ingest files archived by a stream; the archived copies are read back."""
    root = scratch_path(spark, "stream-archive")
    events = read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    tasks = spark.sparkContext.defaultParallelism
    events.repartition(tasks, "event_id").write.json(f"{root}/ingest")
    start_archive(
        spark,
        f"{root}/ingest",
        f"{root}/archive",
        f"{root}/log",
        f"{root}/checkpoint",
        available_now=True,
        clock=lambda: _RUN_AT,
    ).awaitTermination()
    log = files.read_log(spark, f"{root}/log")
    archived = [r[0] for r in log.select("ArchiveFilePath").collect()]
    return readers.read_json(spark, archived, "event_id bigint, event_type string, value double")


def stream_scd1(spark, sf_dir):
    """A type-1 table that follows its archive log."""
    root = scratch_path(spark, "stream-scd1")
    _archive_of_snapshots(spark, sf_dir, root)
    spec = _spec(root, "scd1")
    stream_apply(
        spark, spec, f"{root}/checkpoint", available_now=True, clock=lambda: _RUN_AT
    ).awaitTermination()
    return SnapshotStore(spark, spec.target).read().select(*_STATE)


# --- SQL twins --------------------------------------------------------------------------------------


def _state_of(replay: str, *more: str) -> str:
    return f"SELECT {', '.join([names(_STATE), *more])} FROM ({replay})"


def _filtered_step(i: int) -> str:
    return scd1_step(i).replace(
        's."__HashDiff" <> t."__HashDiff"',
        's."__HashDiff" <> t."__HashDiff" AND t.o_orderpriority <> \'1-URGENT\'',
    )


_BASE = f"SELECT {names(TAGGED_COLUMNS)} FROM ({snapshot_sql(0)})"
_TEXT_DAY = "substring(o_orderpriority, 1, 1)"
_LINEAGE_SQL = f"""CAST('2024-02-0' || {_TEXT_DAY} AS TIMESTAMP) AS "__ArchiveDatetimeUTC",
    'orders_' || {_TEXT_DAY} || '.csv' AS "__OriginalStagingFileName" """
_NAME_SQL = """'event_' || event_id || CASE WHEN value < 5 THEN '.json.partial' ELSE '.json' END"""

_KEPT = [c for c in ORDER_COLUMNS if c != "o_custkey"]
_SOURCE_COLUMNS = [*_KEPT, "__HashDiff", "__ModifiedDatetimeUTC"]


def _source_sql(rows: str, at: str) -> str:
    return f"""SELECT {names(_KEPT)}, sha256(concat_ws('||', {", ".join(_KEPT)})) AS "__HashDiff",
        {ts(at)} AS "__ModifiedDatetimeUTC" FROM ({rows})"""


def _sql_source_sql() -> str:
    take = """t.o_orderkey IS NULL OR
        (s.o_orderkey IS NOT NULL AND s."__HashDiff" <> t."__HashDiff")"""
    out = ", ".join(
        f'CASE WHEN {take} THEN s."{c}" ELSE t."{c}" END AS "{c}"' for c in _SOURCE_COLUMNS
    )
    return f"""WITH t AS ({_source_sql(T0_SQL, "2024-02-01 00:00:00")}),
        s AS ({_source_sql(T1_SQL, "2024-02-01 12:00:00")})
        SELECT {out} FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey"""


QUERIES = {
    "extract_parquet": extract_parquet,
    "extract_csv": extract_csv,
    "extract_json": extract_json,
    "merge_schema_scan": merge_schema_scan,
    "file_catalog": file_catalog,
    "archive_plan": archive_plan,
    "stage_union": stage_union,
    "publish_select": publish_select,
    "incremental_run": incremental_run,
    "incremental_run_buckets": incremental_run_buckets,
    "incremental_run_closed_apart": incremental_run_closed_apart,
    "incremental_run_fact": incremental_run_fact,
    "incremental_run_append": incremental_run_append,
    "incremental_run_replay": incremental_run_replay,
    "incremental_run_previous": incremental_run_previous,
    "incremental_run_odd_paths": incremental_run_odd_paths,
    "config_run": config_run,
    "sql_source_scd1": sql_source_scd1,
    "stream_archive": stream_archive,
    "stream_scd1": stream_scd1,
}

ORACLES = {
    "extract_parquet": """SELECT l_orderkey, l_linenumber, l_extendedprice, TRUE AS from_folder
        FROM lineitem""",
    "extract_csv": """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus,
        CAST(o_totalprice AS VARCHAR) AS o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""",
    "extract_json": """SELECT event_id, event_type, value,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "merge_schema_scan": """SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate >=
        TIMESTAMP '1999-01-01' THEN l_shipdate END AS l_shipdate FROM lineitem""",
    "file_catalog": "SELECT DISTINCT 'o_year=' || year(o_orderdate) AS folder FROM orders",
    "archive_plan": f"""SELECT {ts(str(_RUN_AT))} AS "ArchiveDatetimeUTC",
        20240315 AS "ArchiveyyyyMMddUTC", path AS "OriginalStagingFilePath",
        size AS "OriginalStagingFileSize",
        '/lake/archive/2024/03/15/' || new_name AS "ArchiveFilePath",
        new_name AS "ArchiveFileName", FALSE AS "IsPurged" FROM (SELECT *, '12_00_' ||
        regexp_replace(md5(concat_ws('|', path, size, ts)),
        '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') || '.json' AS new_name
        FROM (SELECT '/lake/ingest/' || event_type || '/' || {_NAME_SQL} AS path, ts,
            CASE WHEN value < 6 THEN 0 ELSE CAST(floor(value * 1000) AS BIGINT) END AS size
            FROM events) WHERE size > 0 AND NOT path LIKE '%.partial')""",
    "stage_union": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
        CAST(o_totalprice AS VARCHAR) AS o_totalprice, {_LINEAGE_SQL} FROM orders""",
    "publish_select": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus,
        {_LINEAGE_SQL} FROM orders""",
    "incremental_run": _state_of(
        replay_sql(opened_sql(snapshot_sql(0), TAGGED_COLUMNS), scd2_step(TAGGED_COLUMNS)),
        names(_INTERVAL),
    ),
    "incremental_run_buckets": _state_of(replay_sql(_BASE, scd1_step)),
    "incremental_run_closed_apart": _state_of(
        replay_sql(opened_sql(snapshot_sql(0), TAGGED_COLUMNS), scd2_step(TAGGED_COLUMNS)),
        names(_INTERVAL),
    ),
    "incremental_run_fact": _state_of(
        replay_sql(unstamped_sql(snapshot_sql(0), TAGGED_COLUMNS), fact_step(TAGGED_COLUMNS)),
        f'"{DELETED}" IS NOT NULL AS is_deleted',
    ),
    "incremental_run_append": _state_of(
        replay_sql(
            f"""SELECT {names(TAGGED_COLUMNS)}, {ts(snapshot_time(0))} AS "__StartDatetimeUTC"
                FROM ({snapshot_sql(0)})""",
            append_step,
        ),
        '"__StartDatetimeUTC"',
    ),
    "incremental_run_replay": _state_of(replay_sql(_BASE, _filtered_step)),
    "incremental_run_previous": _state_of(replay_sql(_BASE, scd1_step)),
    "incremental_run_odd_paths": _state_of(replay_sql(_BASE, scd1_step)),
    "config_run": f"""SELECT 'orders_scd1' AS target, * FROM
        ({_state_of(replay_sql(_BASE, scd1_step))}) UNION ALL SELECT 'orders_fact' AS target, * FROM ({_state_of(
        replay_sql(unstamped_sql(snapshot_sql(0), TAGGED_COLUMNS), fact_step(TAGGED_COLUMNS)))})""",
    "sql_source_scd1": _sql_source_sql(),
    "stream_archive": "SELECT event_id, event_type, value FROM events",
    "stream_scd1": _state_of(replay_sql(_BASE, scd1_step)),
}
