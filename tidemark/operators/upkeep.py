"""Is a table due for upkeep?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.common import Moment, cols, moment

# History operations that count as upkeep, and the days between two runs.
UPKEEP_OPERATIONS = ("VACUUM END", "VACUUM START")
UPKEEP_DAYS = 14


def maintenance_due(
    history: DataFrame, now: Moment, by: Sequence[str] = (), interval_days: int = UPKEEP_DAYS
) -> DataFrame:
    """Days since the last upkeep (-1 if never) and whether it is due, per ``by`` columns."""
    last = F.max(F.when(F.col("operation").isin(*UPKEEP_OPERATIONS), F.col("timestamp")))
    days = F.coalesce(F.datediff(moment(now), F.col("_tm_last")), F.lit(-1))
    return (
        history.groupBy(*cols(by))
        .agg(last.alias("_tm_last"))
        .withColumn("LastMaintenanceSinceDays", days)
        .withColumn(
            "IsDue",
            (F.col("LastMaintenanceSinceDays") < 0)
            | (F.col("LastMaintenanceSinceDays") >= interval_days),
        )
        .drop("_tm_last")
    )
