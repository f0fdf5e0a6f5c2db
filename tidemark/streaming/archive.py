"""Continuous archive: the files of a folder, poll by poll."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import files

# Fixed value: seconds between two polls of the folder.
POLL_SECONDS = 5


def stream_archive(
    spark: SparkSession,
    ingest_path: str,
    archive_root: str,
    log_path: str,
    checkpoint: str,
    available_now: bool = False,
    clock: Callable[[], datetime] = datetime.utcnow,
    name_style: str = "time",
) -> StreamingQuery:
    """Archive the files of a folder, again and again.

    Every poll lists the folder anew, so a name that comes back and a file that was empty before are
    archived too; what the archive log already holds is not. A file that cannot be copied fails the
    query after the others are archived, and is tried again by the next one.
    """
    # A stream of ticks: the folder itself says what there is to do.
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()

    def archive(tick: DataFrame, batch_id: int) -> None:
        session = tick.sparkSession
        catalog = files.ready_files(files.file_catalog(session, ingest_path))
        if catalog.isEmpty():
            return
        copies = files.archive_files(catalog, archive_root, log_path, clock(), name_style)
        failed = copies.where("NOT ok").first()
        if failed is not None:
            raise RuntimeError(f"{failed['source']} could not be archived: {failed['error']}")

    writer = ticks.writeStream.foreachBatch(archive).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{POLL_SECONDS} seconds").start()
