"""Watermarks, pending files and the process log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.names import PROCESS_LOG
from tidemark.operators.common import Moment, moment
from tidemark.operators.evolve import conform

SKIP_FLAGS = ("IsPurged", "IsIgnorable", "IsCorrupted")
_DAY = "ArchiveyyyyMMddUTC"


def start_of_log(now: Moment, lookback_days: int) -> Column:
    """Start of the day ``lookback_days`` before ``now``: where a first run begins."""
    return F.date_sub(moment(now).cast("date"), lookback_days).cast("timestamp_ntz")


def watermark(process_log: DataFrame, now: Moment, lookback_days: int = 5) -> DataFrame:
    """One row: the greatest applied archive time, or the start for an empty log."""
    return process_log.agg(
        F.coalesce(F.max("ArchiveDatetimeUTC"), start_of_log(now, lookback_days)).alias(
            "ArchiveDatetimeUTC"
        )
    )


def watermark_by_source(process_log: DataFrame) -> DataFrame:
    """The greatest applied archive time of every source table."""
    return process_log.groupBy("BronzeSchema", "BronzeTable").agg(
        F.max("ArchiveDatetimeUTC").alias("ArchiveDatetimeUTC")
    )


def of_source(process_log: DataFrame, schema: str, table: str) -> DataFrame:
    return process_log.where((F.col("BronzeSchema") == schema) & (F.col("BronzeTable") == table))


def read_watermark(
    process_log: DataFrame | None,
    now: datetime,
    lookback_days: int = 5,
    source_id: tuple[str, str] | None = None,
) -> datetime:
    """The watermark as a value: one aggregated row comes to the driver."""
    if process_log is None:
        day = datetime(now.year, now.month, now.day)
        return datetime.fromordinal(day.toordinal() - lookback_days)
    log = process_log if source_id is None else of_source(process_log, *source_id)
    return watermark(log, now, lookback_days).first()[0]


def from_day(archive_log: DataFrame, since: datetime) -> DataFrame:
    """The rows from the day of a time on, if the log names days: other folders are not read."""
    if _DAY not in archive_log.columns:
        return archive_log
    return archive_log.where(F.col(_DAY) >= since.year * 10000 + since.month * 100 + since.day)


def pending_files(
    archive_log: DataFrame,
    since: datetime,
    include_previous: bool = False,
    applied: DataFrame | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Archive files after the watermark that are neither purged, ignorable nor corrupted.

    Ordered by archive time, then original modification time where the log has it, then path. The
    day number of the watermark is an extra predicate, which prunes a log partitioned by day.
    ``applied`` (a process log) also removes files already applied, for runs that overlap.
    """
    time = F.col("ArchiveDatetimeUTC")
    test = time >= moment(since) if include_previous else time > moment(since)
    log = archive_log.where(test)
    log = from_day(log, since)
    for flag in SKIP_FLAGS:
        if flag in log.columns:
            log = log.where(~F.coalesce(F.col(flag), F.lit(False)))
    if applied is not None:
        done = applied.select("ArchiveFilePath").where(F.col("ArchiveFilePath").isNotNull())
        log = log.join(done, "ArchiveFilePath", "left_anti").select(*log.columns)
    return log.orderBy(*pending_order(log)) if ordered else log


def pending_order(log: DataFrame) -> list[Column]:
    order = ["ArchiveDatetimeUTC", "OriginalModificationTime", "ArchiveFilePath"]
    return [F.col(quoted(c)).asc() for c in order if c in log.columns]


def process_log_rows(
    files: DataFrame, processed_at: Moment, source_id: tuple[str, str] | None = None
) -> DataFrame:
    """Typed process-log rows for applied files."""
    rows = files.withColumn("ProcessDatetime", moment(processed_at))
    if source_id is not None:
        rows = rows.withColumns(
            {"BronzeSchema": F.lit(source_id[0]), "BronzeTable": F.lit(source_id[1])}
        )
    return conform(rows, PROCESS_LOG)
