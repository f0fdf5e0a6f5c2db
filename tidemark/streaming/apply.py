"""Continuous apply: a table follows its archive log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.names import ARCHIVE_LOG
from tidemark.plans.incremental import run_incremental
from tidemark.spec import TableSpec
from tidemark.streaming.archive import POLL_SECONDS


def stream_apply(
    spark: SparkSession,
    spec: TableSpec,
    checkpoint: str,
    available_now: bool = False,
    clock: Callable[[], datetime] = datetime.utcnow,
) -> StreamingQuery:
    """Run the incremental load of a table whenever its archive log grows.

    The stream is the trigger; the pending files come from the process log. So a micro-batch that
    runs again after a failure finds its files applied and does nothing.
    """
    arriving = (
        spark.readStream.format("parquet")
        .schema(ARCHIVE_LOG)
        .load(spec.archive_log)
        .select("ArchiveFilePath")
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            run_incremental(spark, spec, clock())

    writer = arriving.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{POLL_SECONDS} seconds").start()
