"""Files as rows: catalogue, archive, publish and removal.

Planning is a DataFrame projection. Only moving bytes needs Python: every task copies or removes
its own rows' files, streaming them in blocks, and reports the outcome as rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import timedelta
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import ARCHIVE_LOG, PURGE_MARK
from tidemark.operators.common import Moment, moment
from tidemark.operators.evolve import conform
from tidemark.operators.retention import with_purge_marks
from tidemark.plans.places import PLACE, with_place
from tidemark.session import written
from tidemark.sources.blocks import arrow_uri, copy_file, remove_file, storage_options
from tidemark.sources.hadoop import Folder
from tidemark.sources.paths import extension, file_name, plain_path, plain_path_col, stem

CATALOG_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
_OUTCOME = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
    ]
)


def utc(column: Column) -> Column:
    """A zoned timestamp as UTC wall time without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz"))


def file_catalog(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Files directly under a folder: path, name, size, modification time. Contents are not read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return catalog_columns(reader.load(path))


def catalog_columns(files: DataFrame) -> DataFrame:
    path = plain_path_col(F.col("path"))
    return files.select(
        path.alias("path"),
        file_name(path).alias("name"),
        F.col("length").alias("size"),
        utc(F.col("modificationTime")).alias("modificationTime"),
    )


def ready_files(catalog: DataFrame) -> DataFrame:
    """Files fully uploaded and not empty."""
    return catalog.where(~F.col("path").endswith(".partial") & (F.col("size") > 0))


# How archived files are named; the pattern goes before the identifier.
NAME_PATTERNS = {"time": "HH_mm", "datetime": "yyyy_MM_dd-HH_mm"}


def archive_plan(
    catalog: DataFrame, archive_root: str, now: Moment, name_style: str = "time"
) -> DataFrame:
    """Archive-log rows for the ready files of a catalogue.

    The identifier in the new name is derived from the file's path, size and modification time, so
    a task that runs twice writes the same file and not a second one.
    """
    at = moment(now)
    identity = F.md5(
        F.concat_ws("|", F.col("path"), F.col("size").cast("string"), F.col("modificationTime").cast("string"))
    )
    dashed = F.regexp_replace(identity, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"$1-$2-$3-$4-$5")
    name = F.concat(
        F.date_format(at, NAME_PATTERNS[name_style]), F.lit("_"), dashed, extension(F.col("name"))
    )
    day = F.date_format(at, "yyyy/MM/dd")
    rows = ready_files(catalog).select(
        at.alias("ArchiveDatetimeUTC"),
        F.year(at).alias("ArchiveYearUTC"),
        F.month(at).alias("ArchiveMonthUTC"),
        F.dayofmonth(at).alias("ArchiveDayUTC"),
        F.date_format(at, "yyyyMMdd").cast("int").alias("ArchiveyyyyMMddUTC"),
        F.col("path").alias("OriginalStagingFilePath"),
        F.col("name").alias("OriginalStagingFileName"),
        F.col("size").alias("OriginalStagingFileSize"),
        F.col("modificationTime").alias("OriginalModificationTime"),
        F.concat_ws("/", F.lit(plain_path(archive_root).rstrip("/")), day, name).alias(
            "ArchiveFilePath"
        ),
        name.alias("ArchiveFileName"),
        F.lit(False).alias("IsPurged"),
        F.lit(False).alias("IsIgnorable"),
    )
    return conform(rows, ARCHIVE_LOG)


# --- moving bytes on the executors -----------------------------------------------------------------


def _act(action, options: Mapping[str, str], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        outcomes = []
        for source, destination in zip(pdf["source"], pdf["destination"], strict=True):
            try:
                action(source, destination, options)
                outcomes.append((source, destination, True, None))
            except Exception as error:  # One unreadable file must not stop the others.
                outcomes.append((source, destination, False, f"{type(error).__name__}: {error}"))
        yield pd.DataFrame(outcomes, columns=["source", "destination", "ok", "error"])


def _run(files: DataFrame, action, tasks: int | None) -> DataFrame:
    spark = files.sparkSession
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    spread = files.select("source", "destination").repartition(tasks, "source")
    outcome = spread.mapInPandas(partial(_act, action, storage_options(spark)), _OUTCOME)
    # Computed once: reading the outcome again must not move the files again.
    return written(outcome, "file-outcome")


def copy_files(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Copy ``source`` to ``destination`` on the executors; returns the outcome per file."""
    return _run(files, copy_file, tasks)


def remove_files(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Remove ``source`` on the executors; returns the outcome per file."""
    return _run(files.withColumn("destination", F.lit(None).cast("string")), remove_file, tasks)


# --- archive ----------------------------------------------------------------------------------------


def append_log(rows: DataFrame, log_path: str) -> None:
    """Append archive-log rows below their day."""
    conform(rows, ARCHIVE_LOG).write.mode("append").partitionBy("ArchiveyyyyMMddUTC").parquet(
        log_path
    )


# Below the log, in a folder that a scan of the log does not see.
_MARKS = "_purged/marks"
PURGE_KEY = ("ArchiveyyyyMMddUTC", "ArchiveDatetimeUTC", "ArchiveFilePath")


def read_log(spark: SparkSession, log_path: str) -> DataFrame | None:
    """The archive log, its purge marks applied; a filter on the day prunes both."""
    if not Folder(spark, log_path).exists():
        return None
    log = spark.read.schema(ARCHIVE_LOG).parquet(log_path)
    if Folder(spark, log_path).exists(_MARKS):
        marks = spark.read.schema(PURGE_MARK).parquet(f"{log_path}/{_MARKS}")
        log = with_purge_marks(log, marks, PURGE_KEY)
    return log.select(*ARCHIVE_LOG.names)


def append_purge_marks(purged: DataFrame, log_path: str, now: Moment) -> None:
    """Mark log rows as purged by rows of their own, below the day of the log row.

    The log itself is only ever added to. A mark that a retried purge writes again changes nothing.
    """
    rows = purged.withColumn("PurgeDatetimeUTC", moment(now)).select(*PURGE_MARK.names)
    rows.write.mode("append").partitionBy("ArchiveyyyyMMddUTC").parquet(f"{log_path.rstrip('/')}/{_MARKS}")


def read_purge_marks(spark: SparkSession, log_paths: Sequence[str]) -> DataFrame | None:
    """The purge marks of many logs in one scan, without their days; None if no log has any."""
    places = [f"{p.rstrip('/')}/{_MARKS}" for p in log_paths if Folder(spark, p).exists(_MARKS)]
    if not places:
        return None
    schema = T.StructType([f for f in PURGE_MARK if f.name != "ArchiveyyyyMMddUTC"])
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*places)


def _first_free(log: DataFrame | None, now: Moment) -> Column:
    """``now``, or just after the last archive time of a log that already goes beyond it."""
    start = moment(now)
    if log is None:
        return start
    day = F.date_format(start, "yyyyMMdd").cast("int")
    last = log.where(F.col("ArchiveyyyyMMddUTC") >= day).agg(F.max("ArchiveDatetimeUTC")).first()[0]
    if last is None:
        return start
    return F.greatest(start, moment(last + timedelta(microseconds=1)))


def archive_files(
    catalog: DataFrame,
    archive_root: str,
    log_path: str,
    now: Moment,
    name_style: str = "time",
    tasks: int | None = None,
) -> DataFrame:
    """Copy new files into the archive, append the archive log, remove the originals.

    Every file has an archive time of its own: ``now`` (later, if the log already goes beyond it), and
    a microsecond more for each file before it by modification time and path. In this order of
    steps, so that a failure leaves originals in place. Files the log already holds (same
    path, size and modification time, from a run that failed after its log append) are not
    archived again; only their originals are removed. Returns the outcome of the copies.
    """
    spark = catalog.sparkSession
    arrow_uri(archive_root)
    log = read_log(spark, log_path)
    listed = with_place(
        ready_files(catalog), [F.col("modificationTime"), F.col("path")], "archive-catalog"
    )
    at = F.timestamp_add("MICROSECOND", F.col(PLACE), _first_free(log, now))
    plan = written(archive_plan(listed, archive_root, at, name_style), "archive-plan")
    if log is not None:
        # A file can only have been archived after it was last modified, unless the clocks disagree.
        first = F.least(F.min("OriginalModificationTime"), F.min("ArchiveDatetimeUTC"))
        since = plan.agg(first).first()[0]
        if since is not None:
            log = log.where(F.col("ArchiveyyyyMMddUTC") >= int(f"{since:%Y%m%d}") - 1)
    known = ["OriginalStagingFilePath", "OriginalStagingFileSize", "OriginalModificationTime"]
    fresh = plan if log is None else plan.join(log.select(*known), known, "left_anti")
    copies = copy_files(
        fresh.select(
            F.col("OriginalStagingFilePath").alias("source"),
            F.col("ArchiveFilePath").alias("destination"),
        ),
        tasks,
    )
    done = copies.where("ok").select(F.col("destination").alias("ArchiveFilePath"))
    append_log(fresh.join(done, "ArchiveFilePath", "left_semi"), log_path)
    failed = copies.where(~F.col("ok")).select(F.col("source").alias("OriginalStagingFilePath"))
    archived = plan.join(failed, "OriginalStagingFilePath", "left_anti")
    remove_files(archived.select(F.col("OriginalStagingFilePath").alias("source")), tasks)
    return copies


def publish_as_is(
    pending: DataFrame, target_path: str, new_extension: str = "", tasks: int | None = None
) -> DataFrame:
    """Copy pending archive files to a folder, byte for byte, with the extension replaced."""
    arrow_uri(target_path)
    name = F.col("ArchiveFileName")
    renamed = F.concat(stem(name), F.lit(new_extension)) if new_extension else name
    return copy_files(
        pending.select(
            F.col("ArchiveFilePath").alias("source"),
            F.concat_ws("/", F.lit(plain_path(target_path).rstrip("/")), renamed).alias(
                "destination"
            ),
        ),
        tasks,
    )


def clear_folder(spark: SparkSession, path: str) -> int:
    """Remove the files directly under a folder, not its sub-folders."""
    folder = Folder(spark, path)
    names = folder.files()
    for name in names:
        folder.remove(name)
    return len(names)
