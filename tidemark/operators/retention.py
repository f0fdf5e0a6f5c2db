"""Keep-last retention over the archive log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.functions.text import human_bytes
from tidemark.operators.common import Moment, cols, moment
from tidemark.plans.lookup import lookup_join
from tidemark.plans.places import PLACE, with_place
from tidemark.spec import PurgePolicy

_TIME = "ArchiveDatetimeUTC"
_PATH = "ArchiveFilePath"
_YEAR, _MONTH, _WEEK, _DAY = (
    "ArchiveYearUTC",
    "ArchiveMonthUTC",
    "ArchiveWeekUTC",
    "ArchiveDayUTC",
)
_DAY_KEY = (_YEAR, _MONTH, _WEEK, _DAY)
# The names of the ranks.
RANKS = (
    ("IsLastOfYearRowNbr", (_YEAR,)),
    ("IsLastOfMonthRowNbr", (_YEAR, _MONTH)),
    ("IsLastOfWeekRowNbr", (_YEAR, _WEEK)),
    ("IsLastOfDayRowNbr", (_YEAR, _MONTH, _DAY)),
)
_PIECE = "_tm_piece"


def cutoff(now: Moment, age_days: int) -> Column:
    return moment(now) - F.make_dt_interval(F.lit(age_days))


def filter_tables(
    df: DataFrame, policy: PurgePolicy, name_col: str = "tableName"
) -> DataFrame:
    """Rows whose table name starts with a wanted prefix and with no excluded one."""
    name = F.col(quoted(name_col))
    wanted = F.lit(False)
    for prefix in policy.include_prefixes:
        wanted = wanted | name.startswith(prefix)
    for prefix in policy.exclude_prefixes:
        wanted = wanted & ~name.startswith(prefix)
    return df.where(wanted)


def _piece() -> Column:
    """One of 256 slices of the path: the first order among files of equal time."""
    return F.coalesce(F.substring(F.md5(F.col(_PATH)), 1, 2), F.lit(""))


def eligible(archive_log: DataFrame, now: Moment, policy: PurgePolicy) -> DataFrame:
    old = archive_log.where(F.col(_TIME) <= cutoff(now, policy.age_days))
    return old.withColumn(_WEEK, F.weekofyear(_TIME))


def retention_ranks(
    archive_log: DataFrame, now: Moment, policy: PurgePolicy, group: Sequence[str] = ()
) -> DataFrame:
    """Rank of every file from the end of its year, month, ISO week and day, per ``group``.

    Equal times are ordered by a slice of the path's md5 and the path, both descending. No window
    runs over the files of a period: the log is range-sorted by group, time and path, which cuts
    any busy table, day or moment into even tasks, and written down with every row's place. The
    rank within a day is the distance from the day's first place; longer periods add the counts of
    their later days.
    """
    group = list(group)
    day = [*group, *_DAY_KEY]
    log = eligible(archive_log, now, policy).withColumn(_PIECE, _piece())
    order = [*cols(group), *[F.col(c).desc() for c in (_TIME, _PIECE, _PATH)]]
    placed = with_place(log, order, "placed")

    per_day = placed.groupBy(*cols(day)).agg(
        F.count(F.lit(1)).alias("_tm_n"), F.min(PLACE).alias("_tm_first")
    )
    later_days = [F.col(_MONTH).desc(), F.col(_DAY).desc()]
    for name, period in RANKS[:3]:
        later = Window.partitionBy(*cols([*group, *period])).orderBy(*later_days)
        later = later.rowsBetween(Window.unboundedPreceding, -1)
        per_day = per_day.withColumn(f"_tm_{name}", _sum_over(later))
    ranked = lookup_join(placed, per_day.drop("_tm_n"), day, "left", spread_by=[_PATH])
    in_day = F.col(PLACE) - F.col("_tm_first") + 1
    out = {name: (in_day + F.col(f"_tm_{name}")).cast("int") for name, _ in RANKS[:3]}
    out[RANKS[3][0]] = in_day.cast("int")
    kept = [c for c in log.columns if c != _PIECE]
    return ranked.withColumns(out).select(*cols(kept), *cols([name for name, _ in RANKS]))


def _sum_over(window) -> Column:
    return F.coalesce(F.sum("_tm_n").over(window), F.lit(0))


def retention_keepers(
    log: DataFrame, policy: PurgePolicy, group: Sequence[str] = ()
) -> DataFrame:
    """The files kept as the last of an enabled period.

    The last file of a week, month or year is the last file of its day, so the log is first
    reduced to one file per day by a partial aggregate and the periods are judged on that.
    """
    group = list(group)
    last = F.max(F.struct(F.col(_TIME), _piece().alias(_PIECE), F.col(_PATH))).alias("_tm_last")
    per_day = log.groupBy(*cols([*group, *_DAY_KEY])).agg(last)
    keep = F.lit(False)
    enabled = (policy.keep_year, policy.keep_month, policy.keep_week, policy.keep_day)
    for (name, period), wanted in zip(RANKS, enabled, strict=True):
        if wanted:
            newest = F.max("_tm_last").over(Window.partitionBy(*cols([*group, *period])))
            per_day = per_day.withColumn(f"_tm_{name}", F.col("_tm_last") == newest)
            keep = keep | F.col(f"_tm_{name}")
    return per_day.where(keep).select(
        *cols(group), F.col("_tm_last")[_TIME].alias(_TIME), F.col("_tm_last")[_PATH].alias(_PATH)
    )


def retention_classify(
    archive_log: DataFrame, now: Moment, policy: PurgePolicy, group: Sequence[str] = ()
) -> DataFrame:
    """Files old enough to be judged, with ``IsToBePurged``: false for a last-of file."""
    log = eligible(archive_log, now, policy)
    keepers = retention_keepers(log, policy, group).withColumn("_tm_keep", F.lit(True))
    flagged = lookup_join(log, keepers, [*group, _TIME, _PATH], "left")
    return flagged.withColumn("IsToBePurged", F.col("_tm_keep").isNull()).drop("_tm_keep", _WEEK)


def purge_summary(classified: DataFrame, table_col: str = "ArchiveTable") -> DataFrame:
    """Bytes to purge, to retain and already purged, per table and (NULL table) overall."""
    size = F.col("OriginalStagingFileSize")
    purged, doomed = F.col("IsPurged"), F.col("IsToBePurged")
    totals = classified.rollup(quoted(table_col)).agg(
        F.coalesce(F.sum(F.when(~purged & doomed, size)), F.lit(0)).alias("BytesToPurge"),
        F.coalesce(F.sum(F.when(~purged & ~doomed, size)), F.lit(0)).alias("BytesToRetain"),
        F.coalesce(F.sum(F.when(purged, size)), F.lit(0)).alias("BytesPurged"),
    )
    return totals.withColumns(
        {
            f"{name}Text": human_bytes(F.col(name))
            for name in ("BytesToPurge", "BytesToRetain", "BytesPurged")
        }
    )


def files_to_purge(classified: DataFrame) -> DataFrame:
    return classified.where(~F.col("IsPurged") & F.col("IsToBePurged"))


def mark_purged(archive_log: DataFrame, purged: DataFrame, now: Moment) -> DataFrame:
    """Flag the log rows of removed files; ``purged`` holds their time and path."""
    done = purged.select(_TIME, _PATH).distinct().withColumn("_tm_done", F.lit(True))
    flagged = lookup_join(archive_log, done, [_TIME, _PATH], "left")
    hit = F.col("_tm_done").isNotNull()
    return flagged.withColumns(
        {
            "IsPurged": hit | F.col("IsPurged"),
            "PurgeDatetimeUTC": F.when(hit, moment(now)).otherwise(F.col("PurgeDatetimeUTC")),
        }
    ).drop("_tm_done")


def with_purge_marks(archive_log: DataFrame, marks: DataFrame, key: Sequence[str]) -> DataFrame:
    """The log with the marks of removed files; a file marked twice has its earliest purge time."""
    at, marked = "PurgeDatetimeUTC", "_tm_marked"
    first = marks.groupBy(*key).agg(F.min(at).alias(marked))
    joined = archive_log.join(first, list(key), "left")
    hit = F.col(marked).isNotNull()
    return joined.withColumns(
        {"IsPurged": hit | F.col("IsPurged"), at: F.coalesce(F.col(at), F.col(marked))}
    ).drop(marked)
