"""Runs: pending archive files into a table, changed rows into a sink, a purge of the archive."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions.hashing import primary_key, row_hash, with_primary_key, with_row_hash
from tidemark.names import (
    ARCHIVE_LOG,
    ARCHIVED,
    BATCH,
    CARRIED,
    EXPORT_LOG,
    FILE_PATH,
    HASH,
    MODIFIED,
    PRIMARY_KEY,
    PROCESS_LOG,
    STAGING_NAME,
    TECHNICAL,
)
from tidemark.operators import config, export, fold, logs, merge, retention, scd2, upkeep
from tidemark.operators.common import Moment, moment
from tidemark.operators.evolve import conform, evolve_union_all, merged_schema, widened
from tidemark.plans.lookup import (
    MAX_BROADCAST_ROWS,
    estimated_bytes,
    lookup_join,
    split_by_reach,
)
from tidemark.session import ensure_checkpoint_dir, shuffles_for, written
from tidemark.sources import files, readers, sinks
from tidemark.sources.hadoop import Folder
from tidemark.sources.paths import file_path_col, plain_path, plain_path_col
from tidemark.sources.store import Layout, SnapshotStore
from tidemark.spec import PurgePolicy, TableSpec

_LOGGER = logging.getLogger(__name__)
_LOG_DAY = "ArchiveyyyyMMddUTC"
# Scanned bytes of a group of keys that a fold deals over tasks: about 64 MB in the shuffle.
_GROUP_BYTES = 22 * 1024 * 1024
_PENDING_SCHEMA = (
    f"{BATCH} int, ArchiveDatetimeUTC timestamp_ntz, OriginalStagingFilePath string, "
    "OriginalStagingFileName string, OriginalStagingFileSize bigint, ArchiveFilePath string, "
    "ArchiveFileName string"
)


@dataclass(frozen=True)
class RunResult:
    """What one run did."""

    files: int = 0
    folds: int = 0
    version: int | None = None
    watermark: datetime | None = None
    error: str | None = None
    written_bytes: int = 0
    carried_folders: int = 0


# --- process and export logs -------------------------------------------------------------------------


def read_process_log(spark: SparkSession, path: str) -> DataFrame | None:
    if not Folder(spark, path).exists():
        return None
    return spark.read.schema(PROCESS_LOG).parquet(path)


def append_process_log(rows: DataFrame, path: str) -> None:
    conform(rows, PROCESS_LOG).coalesce(1).write.mode("append").parquet(path)


def _start_log(spark: SparkSession, spec: TableSpec, now: datetime) -> datetime:
    """First run of a source: the log begins with the start time only."""
    since = logs.read_watermark(None, now, spec.default_lookback_days)
    rows = spark.range(1).select(moment(since).alias("ArchiveDatetimeUTC"))
    if spec.source_id is not None:
        rows = rows.withColumns(
            {"BronzeSchema": F.lit(spec.source_id[0]), "BronzeTable": F.lit(spec.source_id[1])}
        )
    append_process_log(rows, spec.process_log)
    return since


def _own_log(spark: SparkSession, spec: TableSpec) -> DataFrame | None:
    """The process log of the table's source, without those of others."""
    log = read_process_log(spark, spec.process_log)
    if log is None or spec.source_id is None:
        return log
    return logs.of_source(log, *spec.source_id)


def _since(spark: SparkSession, spec: TableSpec, now: datetime) -> datetime:
    log = _own_log(spark, spec)
    last = None if log is None else log.agg(F.max("ArchiveDatetimeUTC")).first()[0]
    return last if last is not None else _start_log(spark, spec, now)


# --- reading a chunk of pending files -----------------------------------------------------------------


def next_chunk(pending: DataFrame, max_files: int | None) -> list[Row]:
    """The next files in order, at most ``max_files`` plus those of the same archive time.

    A watermark cannot split files of one archive time, so they stay together. The file list of a
    scan lives on the driver in any case; its length is what ``max_files`` bounds.
    """
    ordered = pending.select(
        "ArchiveDatetimeUTC",
        *[c for c in ("OriginalModificationTime",) if c in pending.columns],
        "OriginalStagingFilePath",
        "OriginalStagingFileName",
        "OriginalStagingFileSize",
        "ArchiveFilePath",
        "ArchiveFileName",
    )
    order = logs.pending_order(ordered)
    if max_files is None:
        return ordered.orderBy(*order).collect()
    head = ordered.orderBy(*order).limit(max_files).collect()
    if len(head) < max_files:
        return head
    last = head[-1]["ArchiveDatetimeUTC"]
    earlier = [r for r in head if r["ArchiveDatetimeUTC"] < last]
    same = ordered.where(F.col("ArchiveDatetimeUTC") == moment(last)).orderBy(*order).collect()
    return earlier + same


def chunk_frame(spark: SparkSession, chunk: Sequence[Row]) -> DataFrame:
    """The chunk as a DataFrame, its files numbered 1..n in order of application."""
    names = [part.split(" ")[0] for part in _PENDING_SCHEMA.split(", ")][1:]
    rows = [(i, *[r[n] for n in names]) for i, r in enumerate(chunk, start=1)]
    return spark.createDataFrame(rows, _PENDING_SCHEMA)


def _content(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns of a raw extract that are hashed, and its path."""
    path = readers.SOURCE_PATH
    if spec.complex_as_string:
        df = C.complex_as_string(df)
    df = C.select_columns(df, spec.select, keep=path)
    df = C.derive_columns(df, spec.derive)
    cleaner = {"spaces": C.clean_names, "full": C.clean_names_full, "none": lambda d: d}
    df = cleaner[spec.clean](df)
    df = C.exclude_columns(df, spec.exclude)
    if spec.file_format == "csv":
        df = C.nonnull_keys(df, spec.keys)
    return df


def shape_extract(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select, derive, clean, exclude and hash: a raw extract to comparable rows."""
    path = readers.SOURCE_PATH
    df = _content(df, spec)
    df = with_row_hash(df, [c for c in df.columns if c != path], spec.hash_mode, spec.null_token)
    return with_primary_key(df, spec.keys) if spec.with_primary_key else df


def _late_hashes(
    scans: Sequence[DataFrame], spec: TableSpec, target: DataFrame | None, batches: DataFrame
) -> dict[str, Column]:
    """Row hash and surrogate key over columns of ``batches``, if their files gave them the same ones.

    That is where all files have one schema, no hashed column has a technical name, which the lineage
    would replace, and the table has none of them in a wider type.
    """
    contents = [_content(df, spec) for df in scans]
    content = contents[0]
    hashed = [c for c in content.columns if c != readers.SOURCE_PATH]
    types = [[(f.name, f.dataType) for f in df.schema] for df in contents]
    if any(t != types[0] for t in types) or {*TECHNICAL, BATCH, CARRIED} & set(hashed):
        return {}
    schema = batches.schema if target is None else merged_schema(target.schema, batches.schema)
    if any(schema[c].dataType != content.schema[c].dataType for c in hashed):
        return {}
    late = {HASH: row_hash(content, hashed, spec.hash_mode, spec.null_token)}
    if spec.with_primary_key and set(spec.keys) <= set(hashed):
        late[PRIMARY_KEY] = primary_key(content, spec.keys)
    return late


def _read(spark: SparkSession, spec: TableSpec, paths: Sequence[str]) -> list[DataFrame]:
    """One scan for each schema that occurs among the files."""
    return readers.scans_by_schema(spark, paths, spec.file_format, spec.reader_options, spec.schema)


def load_batches(
    scans: Sequence[DataFrame], spec: TableSpec, chunk: DataFrame, n_files: int, now: Moment
) -> DataFrame:
    """The rows of all files of a chunk, hashed and tagged with batch number and lineage.

    Files are shaped and hashed under their own schema, as they would be one by one; columns that
    only some files have make each row name the columns of its file in ``CARRIED``.
    """
    shaped = [shape_extract(df, spec) for df in scans]
    common = set.intersection(*[set(df.columns) for df in shaped])
    if any(set(df.columns) - common for df in shaped):
        shaped = [
            df.withColumn(CARRIED, F.array(*[F.lit(c) for c in df.columns]))
            for df in shaped
        ]
    rows = evolve_union_all(shaped)
    lineage = chunk.select(
        plain_path_col(F.col("ArchiveFilePath")).alias(readers.SOURCE_PATH),
        F.col(BATCH),
        F.col("ArchiveDatetimeUTC").alias(ARCHIVED),
        F.col("ArchiveFilePath").alias(FILE_PATH),
        F.col("OriginalStagingFileName").alias(STAGING_NAME),
    )
    if n_files <= MAX_BROADCAST_ROWS:
        tagged = rows.join(F.broadcast(lineage), readers.SOURCE_PATH, "left")
    else:
        tagged = lookup_join(rows, lineage, [readers.SOURCE_PATH], "left", spread_by=spec.keys)
    lost = F.concat(F.lit("no pending file has the path "), readers.SOURCE_PATH)
    known = F.when(F.col(BATCH).isNull(), F.raise_error(lost).cast("boolean")).otherwise(True)
    return tagged.where(known).drop(readers.SOURCE_PATH).withColumn(MODIFIED, moment(now))


# --- applying a chunk ---------------------------------------------------------------------------------


def _folded(
    spec: TableSpec,
    target,
    batches: DataFrame,
    batch_log: DataFrame,
    late: Mapping[str, Column],
    deal_by: Mapping[str, Column] | None,
) -> DataFrame:
    policy = spec.on_duplicate
    how = {"late": late, "deal_by": deal_by}
    if spec.kind == "scd1":
        if spec.update_filter:
            return fold.scd1_filtered_fold(target, batches, spec.keys, spec.update_filter, policy, **how)
        return fold.scd1_fold(target, batches, spec.keys, on_duplicate=policy, **how)
    if spec.kind == "scd2":
        return fold.scd2_fold(
            target, batches, spec.keys, batch_log, spec.deletes, spec.touch_modified, policy, **how
        )
    if spec.update_filter:
        raise fold.NeedsReplay("an update filter depends on the stored row")
    return fold.fact_fold(
        target, batches, spec.keys, batch_log, spec.deletes, spec.resurrect, policy, **how
    )


def _one_batch(spec: TableSpec, target, source: DataFrame, archived, now) -> DataFrame:
    options = {"on_duplicate": spec.on_duplicate}
    if spec.kind == "scd1":
        empty = source.limit(0) if target is None else target
        return merge.scd1_merge(empty, source, spec.keys, spec.update_filter, **options)
    if spec.kind == "fact":
        empty = source.limit(0) if target is None else target
        return merge.fact_apply(
            empty, source, spec.keys, now, spec.deletes, spec.resurrect, spec.update_filter, **options
        )
    if target is None:
        return scd2.scd2_init(source, archived)
    options["touch_modified"] = spec.touch_modified
    return scd2.scd2_merge(target, source, spec.keys, archived, spec.deletes, **options)


def replayed(
    spark: SparkSession, spec: TableSpec, target, chunk: Sequence[Row], now: Moment
) -> DataFrame:
    """Batch by batch, for options that depend on the evolving table.

    Every file is read once, and the state is checkpointed after each batch, so neither the plan
    nor the work of a lost executor grows with the number of batches.
    """
    ensure_checkpoint_dir(spark)
    for i, row in enumerate(chunk, start=1):
        frame = chunk_frame(spark, [row])
        raw = _read(spark, spec, [plain_path(row["ArchiveFilePath"])])
        source = load_batches(raw, spec, frame, 1, now).drop(CARRIED)
        target = _one_batch(spec, target, source.drop(BATCH), row["ArchiveDatetimeUTC"], now)
        if i < len(chunk):
            target = target.checkpoint()
    return target


def _append_each(
    spark: SparkSession, spec: TableSpec, store: SnapshotStore, chunk: Sequence[Row], now: Moment
) -> int:
    """Append batch by batch: repeated keys of one batch are all kept if they are new."""
    applied: list[str] = []
    at = now if isinstance(now, datetime) else None
    for row in chunk:
        frame = chunk_frame(spark, [row])
        raw = _read(spark, spec, [plain_path(row["ArchiveFilePath"])])
        source = load_batches(raw, spec, frame, 1, now)
        fresh = scd2.appended_versions(
            store.read(), source.drop(BATCH, MODIFIED), spec.keys, row["ArchiveDatetimeUTC"]
        )
        applied.append(row["ArchiveFilePath"])
        version = store.commit(fresh, mode="append", applied=applied, now=at)
    return version.number


def _prunable(spec: TableSpec) -> bool:
    """May a merge leave the partitions alone that no batch touches?"""
    if not spec.partition_by or not spec.immutable_partitions:
        return False
    if isinstance(spec.deletes, str):
        return spec.deletes == "none"
    return set(spec.partition_by) <= set(spec.deletes)


def _bypasses(spec: TableSpec, target: DataFrame) -> bool:
    """Is the table large, and can rows out of the batches' reach not change?"""
    return spec.deletes != "full" and estimated_bytes(target) >= spec.bypass_min_bytes


def apply_chunk(
    spark: SparkSession, spec: TableSpec, store: SnapshotStore, chunk: Sequence[Row], now: Moment
) -> int:
    """Fold the files of a chunk into the table and commit; returns the new version."""
    if spec.kind == "scd2_append" and spec.on_duplicate == "allow":
        return _append_each(spark, spec, store, chunk, now)
    frame = chunk_frame(spark, chunk)
    raw = _read(spark, spec, [plain_path(r["ArchiveFilePath"]) for r in chunk])
    batches = load_batches(raw, spec, frame, len(chunk), now)
    target, touched = _held(spec, store, batches)
    held_bytes = 0 if target is None else estimated_bytes(target)
    late = _late_hashes(raw, spec, target, batches)
    scanned_bytes = held_bytes + sum(map(estimated_bytes, raw))
    with shuffles_for(spark, scanned_bytes):
        dealt = False
        if spec.kind == "scd2_append":
            result = fold.append_fold(
                target,
                batches.drop(MODIFIED),
                spec.keys,
                on_duplicate=spec.on_duplicate,
                late=late,
            )
            mode = "append"
        else:
            prunable = not store.layout.columns() and _prunable(spec)
            groups = -(-scanned_bytes // _GROUP_BYTES)
            deal_by = store.layout.dealing(groups) if _dealable(spec) else None
            result, mode, dealt = _merged(
                spark, spec, target, batches, frame, chunk, now, prunable, late, deal_by
            )
            if store.layout.columns() and store.fits_layout():
                mode = "buckets"
        at = now if isinstance(now, datetime) else None
        applied = [r["ArchiveFilePath"] for r in chunk]
        return store.commit(result, mode=mode, applied=applied, now=at, touched=touched, dealt=dealt).number


def _dealable(spec: TableSpec) -> bool:
    """Does a fold give all rows of a table that lies in key buckets alone?"""
    return bool(spec.key_buckets) and not spec.partition_by and (spec.kind != "scd2" or spec.closed_apart)


def store_of(spark: SparkSession, spec: TableSpec) -> SnapshotStore:
    layout = Layout(tuple(spec.keys), spec.key_buckets, spec.closed_apart)
    return SnapshotStore(spark, spec.target, spec.partition_by, layout)


def _held(
    spec: TableSpec, store: SnapshotStore, batches: DataFrame
) -> tuple[DataFrame | None, set[int] | None]:
    """The rows of the table that take part in a merge, and the key buckets that do (None: all).

    Folders are left out by name. There are at most ``key_buckets`` values to bring back.
    """
    layout = store.layout
    if not layout.columns() or not store.fits_layout():
        return store.read(), None
    touched = None
    if layout.buckets and spec.deletes == "none":
        rows = batches.select(layout.bucket().alias("bucket")).distinct().collect()
        touched = {r["bucket"] for r in rows}
    return store.read(keep=lambda folder: layout.takes_part(folder, touched)), touched


def _merged(
    spark: SparkSession,
    spec: TableSpec,
    target: DataFrame | None,
    batches: DataFrame,
    frame: DataFrame,
    chunk: Sequence[Row],
    now: Moment,
    prunable: bool,
    late: Mapping[str, Column] | None = None,
    deal_by: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, str, bool]:
    """The new rows of the table, or of the partitions the batches touch, and which of the two.

    And whether they are dealt over tasks by ``deal_by``.
    """
    batch_log = frame.select(
        BATCH, F.col("ArchiveDatetimeUTC").alias(ARCHIVED), moment(now).alias(MODIFIED)
    )
    mode, untouched = "replace", None
    if target is not None and prunable:
        target, _ = merge.split_by_partition(target, batches, list(spec.partition_by))
        mode = "partitions"
    if target is not None and _bypasses(spec, target):
        scope = () if isinstance(spec.deletes, str) else spec.deletes
        wide = widened(target, merged_schema(target.schema, batches.schema))
        target, untouched = split_by_reach(wide, batches, spec.keys, scope)
    try:
        result, dealt = _folded(spec, target, batches, batch_log, late, deal_by), deal_by is not None
    except fold.NeedsReplay:
        result, dealt = replayed(spark, spec, target, chunk, now), False
    if untouched is not None:
        result, dealt = result.unionAll(conform(untouched, result.schema)), False
    return result, mode, dealt


def _finish_last_run(
    spark: SparkSession, spec: TableSpec, store: SnapshotStore, since: datetime, now: datetime
) -> datetime:
    """Log the files of a commit whose process-log append is missing (a run that was cut off).

    They were pending at the watermark ``since``, so nothing before it is read in either log, unless
    runs may overlap (``skip_applied``): another one can have gone on beyond them. Returns the
    watermark that holds then.
    """
    version = store.version()
    if version is None or not version.applied:
        return since
    applied = spark.createDataFrame([(p,) for p in version.applied], "ArchiveFilePath string")
    log = read_process_log(spark, spec.process_log)
    archive = files.read_log(spark, spec.archive_log)
    if not spec.skip_applied:
        recent = F.col("ArchiveDatetimeUTC") >= moment(since)
        archive = logs.from_day(archive, since).where(recent)
        log = None if log is None else log.where(recent)
    if log is not None:
        applied = applied.join(log, "ArchiveFilePath", "left_anti")
    missing = archive.join(applied, "ArchiveFilePath", "left_semi")
    if missing.isEmpty():
        return since
    append_process_log(logs.process_log_rows(missing, now, spec.source_id), spec.process_log)
    return _since(spark, spec, now)


def run_incremental(spark: SparkSession, spec: TableSpec, now: datetime) -> RunResult:
    """Apply every pending archive file of a table.

    Files are folded in chunks until none is pending. The data commit names the files it holds and
    comes before the process-log append; a run cut off between the two is completed by the next.
    """
    store = store_of(spark, spec)
    n_files = folds = 0
    version = None
    since = _finish_last_run(spark, spec, store, _since(spark, spec, now), now)
    while (archive := files.read_log(spark, spec.archive_log)) is not None:
        # The files at the first watermark are in the first chunk as a whole; later ones go on
        # after it.
        include = spec.include_previous and folds == 0
        chunk = next_chunk(_pending(spark, spec, archive, since, include), spec.max_files)
        if not chunk:
            break
        version = apply_chunk(spark, spec, store, chunk, now)
        done = chunk_frame(spark, chunk)
        append_process_log(logs.process_log_rows(done, now, spec.source_id), spec.process_log)
        n_files, folds = n_files + len(chunk), folds + 1
        since = chunk[-1]["ArchiveDatetimeUTC"]
    return RunResult(
        n_files,
        folds,
        version,
        since,
        written_bytes=store.written_bytes,
        carried_folders=store.carried_folders,
    )


def _pending(
    spark: SparkSession, spec: TableSpec, archive: DataFrame, since: datetime, include: bool
) -> DataFrame:
    """Pending files; with ``skip_applied`` those of the process log are left out."""
    applied = read_process_log(spark, spec.process_log) if spec.skip_applied else None
    if applied is not None and spec.source_id is not None:
        applied = logs.of_source(applied, *spec.source_id)
    return logs.pending_files(archive, since, include, applied, ordered=False)


def run_config(
    spark: SparkSession,
    config_table: DataFrame,
    tag: str | None,
    table_root: str,
    archive_root: str,
    process_log: str,
    now: datetime,
) -> dict[str, RunResult]:
    """Run every active load of a configuration table that carries the tag.

    Each target has a process log below ``process_log``. A load that is described wrongly or fails
    has its ``error`` in its result and does not stop the others.
    """
    done = {}
    for row in config.rows_from_config(config_table, tag):
        target = f"{table_root}/{row['SilverSchema']}/{row['SilverTable']}"
        try:
            spec = config.spec_from_row(row, table_root, archive_root, process_log)
            done[target] = run_incremental(spark, spec, now)
        except Exception as error:
            _LOGGER.exception("the load of %s failed", target)
            done[target] = RunResult(error=f"{type(error).__name__}: {error}")
    return done


# --- publish and stage ----------------------------------------------------------------------------------


def run_publish(
    spark: SparkSession,
    spec: TableSpec,
    now: datetime,
    write: Callable[[DataFrame], None],
    whole: bool = False,
) -> RunResult:
    """Selected columns of pending files to a sink, then the process log.

    ``write`` gets one frame per chunk and should append. A sink that overwrites, such as a
    warehouse staging table, needs ``whole``: then all pending files come in one frame. If
    ``write`` fails nothing is logged as processed.
    """

    def deliver(chunk: Sequence[Row], frame: DataFrame) -> datetime | None:
        paths = [plain_path(r["ArchiveFilePath"]) for r in chunk]
        listed = frame.withColumn("ArchiveFilePath", plain_path_col(F.col("ArchiveFilePath")))
        rows = evolve_union_all(_read(spark, spec, paths))
        write(sinks.staged_rows(rows, listed, spec.select))
        return None

    return _each_chunk(spark, spec, now, deliver, None if whole else spec.max_files)


def run_publish_files(
    spark: SparkSession,
    spec: TableSpec,
    now: datetime,
    target_path: str,
    new_extension: str = "",
    clear_target: bool = False,
) -> RunResult:
    """Pending files copied as they are.

    If a file cannot be copied, only files archived before it are logged as processed and the run
    fails, so that the next one takes up again from there.
    """
    if clear_target:
        files.clear_folder(spark, target_path)

    def deliver(chunk: Sequence[Row], frame: DataFrame) -> datetime | None:
        outcome = files.publish_as_is(frame, target_path, new_extension)
        failed = outcome.where(~F.col("ok")).select(F.col("source").alias("ArchiveFilePath"))
        missed = frame.join(failed, "ArchiveFilePath", "left_semi")
        return missed.agg(F.min("ArchiveDatetimeUTC")).first()[0]

    return _each_chunk(spark, spec, now, deliver, spec.max_files)


def _each_chunk(
    spark: SparkSession,
    spec: TableSpec,
    now: datetime,
    deliver: Callable[[Sequence[Row], DataFrame], datetime | None],
    max_files: int | None,
) -> RunResult:
    """Deliver pending files chunk by chunk and log them.

    ``deliver`` returns the archive time of the first file that failed, or None.
    """
    n_files = folds = 0
    since = _since(spark, spec, now)
    while (archive := files.read_log(spark, spec.archive_log)) is not None:
        include = spec.include_previous and folds == 0
        chunk = next_chunk(_pending(spark, spec, archive, since, include), max_files)
        if not chunk:
            break
        done = chunk_frame(spark, chunk)
        failed_at = deliver(chunk, done)
        if failed_at is not None:
            done = done.where(F.col("ArchiveDatetimeUTC") < moment(failed_at))
        append_process_log(logs.process_log_rows(done, now, spec.source_id), spec.process_log)
        if failed_at is not None:
            raise RuntimeError(f"a file archived at {failed_at} could not be delivered")
        n_files, folds = n_files + len(chunk), folds + 1
        since = chunk[-1]["ArchiveDatetimeUTC"]
    return RunResult(n_files, folds, None, since)


# --- query sources --------------------------------------------------------------------------------------


def run_query_source(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    now: datetime,
    select: str = "*",
    exclude: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    null_safe: bool = False,
    on_duplicate: str = "error",
) -> int:
    """A type-1 table from the result of a query (JDBC or SQL), without file lineage.

    Keys match by plain equality unless ``null_safe``. Returns the new version.
    """
    rows = C.exclude_columns(C.select_columns(source, select), exclude)
    rows = with_row_hash(rows).withColumn(MODIFIED, moment(now))
    store = SnapshotStore(spark, target, partition_by)
    held = store.read()
    if held is not None:
        rows = merge.scd1_merge(held, rows, keys, null_safe=null_safe, on_duplicate=on_duplicate)
    return store.commit(rows, now=now).number


# --- export ---------------------------------------------------------------------------------------------


def run_export(
    spark: SparkSession,
    source: DataFrame,
    export_log: str,
    now: datetime,
    write: Callable[[DataFrame], None],
    track_col: str = MODIFIED,
    lookback_days: int = 0,
    include_previous: bool = False,
    select: str = "*",
) -> datetime | None:
    """Write the rows changed since the last export and log the new watermark, if there is one."""
    log = None
    if Folder(spark, export_log).exists():
        log = spark.read.schema(EXPORT_LOG).parquet(export_log)
    since = export.export_start(log, lookback_days)
    write(export.changed_rows(source, since, track_col, include_previous, select))
    mark = export.new_watermark(source, since, now, track_col).first()
    if mark is None:
        return None
    row = spark.range(1).select(moment(mark[0]).alias("ProcessDatetime"))
    row.coalesce(1).write.mode("append").parquet(export_log)
    return mark[0]


# --- purge ----------------------------------------------------------------------------------------------


def read_logs(spark: SparkSession, archive_logs: dict[str, str]) -> DataFrame:
    """The archive logs of many tables in one scan, each row with its ``ArchiveTable``."""
    schema = T.StructType([f for f in ARCHIVE_LOG if f.name != _LOG_DAY])
    rows = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .parquet(*archive_logs.values())
        .withColumn("_tm_root", F.regexp_replace(file_path_col(), "/[^/]+/[^/]+$", ""))
    )
    roots = [(plain_path(path).rstrip("/"), name) for name, path in archive_logs.items()]
    names = spark.createDataFrame(roots, "_tm_root string, ArchiveTable string")
    day = F.date_format("ArchiveDatetimeUTC", "yyyyMMdd").cast("int")
    named = lookup_join(rows, names, ["_tm_root"], "left", spread_by=["ArchiveFilePath"])
    named = named.withColumn(_LOG_DAY, day).drop("_tm_root")
    marks = files.read_purge_marks(spark, list(archive_logs.values()))
    return named if marks is None else retention.with_purge_marks(named, marks, files.PURGE_KEY[1:])


def run_purge(
    spark: SparkSession,
    archive_logs: dict[str, str],
    policy: PurgePolicy,
    now: datetime,
    dry_run: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """Classify the files of every wanted archive table and, unless dry, remove the ones to purge.

    ``archive_logs`` maps table names to log paths. Returns the byte summary from before the
    purge, per table and overall. Only files whose removal succeeded are marked in their log, by rows
    added to it: a purge cut off at any step leaves the log whole, and the next one marks the files
    that are gone already.
    """
    names = spark.createDataFrame([(n,) for n in archive_logs], "tableName string")
    wanted = [r[0] for r in retention.filter_tables(names, policy).collect()]
    existing = {n: archive_logs[n] for n in wanted if Folder(spark, archive_logs[n]).exists()}
    if not existing:
        table = T.StructField("ArchiveTable", T.StringType())
        none = spark.createDataFrame([], T.StructType([*ARCHIVE_LOG, table]))
        return retention.purge_summary(retention.retention_classify(none, now, policy, ["ArchiveTable"]))
    logs_now = read_logs(spark, existing)
    classified = retention.retention_classify(logs_now, now, policy, ["ArchiveTable"])
    # The logs change below: what they say now is kept as a table of its own.
    classified = written(classified, "purge")
    if not dry_run:
        held, kept = logs_now.count(), classified.count()
        if held != kept:
            raise RuntimeError(f"{kept} of {held} log rows were read back: is the scratch folder shared?")
        doomed = retention.files_to_purge(classified)
        outcome = files.remove_files(doomed.select(F.col("ArchiveFilePath").alias("source")), tasks)
        gone = outcome.where("ok").select(F.col("source").alias("ArchiveFilePath"))
        purged = doomed.join(gone, "ArchiveFilePath", "left_semi")
        for name, path in existing.items():
            files.append_purge_marks(purged.where(F.col("ArchiveTable") == name), path, now)
    return retention.purge_summary(classified)


# --- upkeep ---------------------------------------------------------------------------------------------


def run_upkeep(store: SnapshotStore, now: datetime) -> bool:
    """Compact and clean a table if its last upkeep is 14 days old or never happened."""
    due = upkeep.maintenance_due(store.history(), now).first()
    if due is not None and not due["IsDue"]:
        return False
    store.compact(now=now)
    store.vacuum(now=now)
    return True
