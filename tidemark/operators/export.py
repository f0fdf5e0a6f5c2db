"""Incremental export of changed rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted, select_columns
from tidemark.names import MODIFIED
from tidemark.operators.common import Moment, moment

# Fixed value: where a first export begins.
FIRST_EXPORT = datetime(1900, 1, 1)


def export_start(export_log: DataFrame | None, lookback_days: int = 0) -> datetime:
    """Last exported change minus the look-back days; the first export starts at the beginning."""
    if export_log is None:
        return FIRST_EXPORT
    last = export_log.agg(F.max("ProcessDatetime")).first()[0]
    return FIRST_EXPORT if last is None else last - timedelta(days=lookback_days)


def changed_rows(
    source: DataFrame,
    since: Moment,
    track_col: str = MODIFIED,
    include_previous: bool = False,
    select: str | Sequence[str | Column] = "*",
) -> DataFrame:
    """Rows whose track column is after ``since`` (or at it)."""
    tracked = F.col(quoted(track_col))
    test = tracked >= moment(since) if include_previous else tracked > moment(since)
    return select_columns(source.where(test), select)


def sql_source(spark: SparkSession, query: str) -> DataFrame:
    """User SQL over the lake as a source."""
    return spark.sql(query)


def new_watermark(
    source: DataFrame, since: Moment, until: Moment, track_col: str = MODIFIED
) -> DataFrame:
    """The greatest change between the start and the moment the export query began; or no row."""
    tracked = F.col(quoted(track_col))
    window = source.where((tracked >= moment(since)) & (tracked <= moment(until)))
    return window.agg(F.max(tracked).alias("ProcessDatetime")).where("ProcessDatetime IS NOT NULL")
