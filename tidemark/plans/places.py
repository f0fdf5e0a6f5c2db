"""The place of every row in one order, without one window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written

PLACE = "_tm_place"
_TASK = "_tm_task"
# Bits of a place within its task, as Spark's own increasing ids are laid out.
_BITS = 33


def with_place(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Add ``PLACE``, from 0 in the given order, and compute the rows once.

    The rows are range-sorted, which cuts any busy value into even tasks, and written down with their
    places, so that a place does not change between two readings.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.withColumn(PLACE, F.monotonically_increasing_id()), label)
    rows = rows.withColumns(
        {
            _TASK: F.shiftright(PLACE, _BITS),
            PLACE: F.col(PLACE).bitwiseAND(F.lit((1 << _BITS) - 1)),
        }
    )
    # One row per task of the sort, so one task may add them up and every other may hold them.
    per_task = rows.groupBy(_TASK).agg(F.count(F.lit(1)).alias("_tm_n"))
    before = Window.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_tm_n").over(before), F.lit(0))
    per_task = per_task.select(_TASK, offset.alias("_tm_offset"))
    rows = rows.join(F.broadcast(per_task), _TASK)
    return rows.withColumn(PLACE, F.col(PLACE) + F.col("_tm_offset")).drop(_TASK, "_tm_offset")
