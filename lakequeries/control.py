"""Logs, watermarks, retention, configuration, export and upkeep."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakequeries.extracts import (
    LOG_EVENTS_SQL,
    LOG_ORDERS_SQL,
    NOW,
    RETENTION_NOW,
    log_of_events,
    log_of_orders,
    read,
    ts,
)
from tidemark.operators import config, export, logs, retention, upkeep
from tidemark.spec import PurgePolicy

_SINCE = datetime(2024, 1, 20, 12, 0, 0)
_USABLE = "NOT IsPurged AND NOT IsIgnorable"
# Two of the tables are up to date, the others wait.
_APPLIED = f"BronzeTable IN ('purchase', 'signup') AND {_USABLE}"


def _process_log(spark, sf_dir, which=_USABLE):
    files = log_of_events(spark, sf_dir).where(which)
    return logs.process_log_rows(files, NOW)


def watermark(spark, sf_dir):
    return logs.watermark(_process_log(spark, sf_dir), NOW)


def watermark_first_run(spark, sf_dir):
    """No file of the log was applied yet: the run starts 90 days back."""
    none = _process_log(spark, sf_dir).where("OriginalStagingFileSize < 0")
    return logs.watermark(none, NOW, lookback_days=90)


def watermark_by_source(spark, sf_dir):
    return logs.watermark_by_source(_process_log(spark, sf_dir))


_PENDING = ["ArchiveFilePath", "ArchiveDatetimeUTC", "OriginalModificationTime"]


def pending_files(spark, sf_dir):
    return logs.pending_files(log_of_events(spark, sf_dir), _SINCE).select(*_PENDING)


def pending_unapplied(spark, sf_dir):
    """Include-previous start, minus the files the process log already holds."""
    pending = logs.pending_files(
        log_of_events(spark, sf_dir),
        _SINCE,
        include_previous=True,
        applied=_process_log(spark, sf_dir, _APPLIED),
        ordered=False,
    )
    return pending.select(*_PENDING)


def process_log_rows(spark, sf_dir):
    return _process_log(spark, sf_dir)


_POLICY = PurgePolicy(exclude_prefixes=("archive_low",))
_COARSE = PurgePolicy(keep_week=False, keep_day=False)


def table_catalog_filter(spark, sf_dir):
    tables = log_of_orders(spark, sf_dir).groupBy("ArchiveTable").agg(
        F.count(F.lit(1)).alias("n_files")
    )
    return retention.filter_tables(tables, _POLICY, "ArchiveTable")


_RETAINED = ["ArchiveTable", "ArchiveDatetimeUTC", "ArchiveFilePath"]


def retention_ranks(spark, sf_dir):
    ranks = retention.retention_ranks(
        log_of_orders(spark, sf_dir), RETENTION_NOW, _POLICY, ["ArchiveTable"]
    )
    return ranks.select(*_RETAINED, *[name for name, _ in retention.RANKS])


def _classified(spark, sf_dir, policy):
    return retention.retention_classify(
        log_of_orders(spark, sf_dir), RETENTION_NOW, policy, ["ArchiveTable"]
    )


def retention_classify(spark, sf_dir):
    return _classified(spark, sf_dir, _POLICY).select(*_RETAINED, "IsPurged", "IsToBePurged")


def retention_classify_coarse(spark, sf_dir):
    """Only the last file of a month or year is kept."""
    return _classified(spark, sf_dir, _COARSE).select(*_RETAINED, "IsPurged", "IsToBePurged")


def purge_summary(spark, sf_dir):
    return retention.purge_summary(_classified(spark, sf_dir, _COARSE))


def purge_apply(spark, sf_dir):
    log = log_of_orders(spark, sf_dir)
    gone = retention.files_to_purge(_classified(spark, sf_dir, _COARSE))
    return retention.mark_purged(log, gone, RETENTION_NOW).select(
        *_RETAINED, "IsPurged", "PurgeDatetimeUTC"
    )


_TAG = " brand#3 ,promo"


def _config(spark, sf_dir):
    return read(spark, sf_dir, "part").select(
        F.expr("p_size >= 20").alias("IsActive"),
        F.concat(F.lit("SELECT * FROM "), F.col("p_name")).alias("Query"),
        F.upper("p_name").alias("Dataset"),
        F.expr("CASE WHEN p_type = 'LARGE' THEN NULL ELSE 'FACT' END").alias("Type"),
        F.col("p_brand").alias("BronzeSchema"),
        F.col("p_name").alias("BronzeTable"),
        F.lit("silver").alias("SilverSchema"),
        F.col("p_name").alias("SilverTable"),
        F.lit("id").alias("BusinessKeyColumns"),
        F.lit("*").alias("ExtractColumns"),
        F.lit(None).cast("string").alias("ExcludeColumns"),
        F.expr("CASE WHEN p_size > 40 THEN 'year' END").alias("DeleteFilterColumns"),
        F.expr(
            "CASE WHEN p_type = 'SMALL' THEN NULL ELSE concat(p_brand, ' , ', p_type) END"
        ).alias("Tag"),
    )


def config_lookup(spark, sf_dir):
    return config.silver_lookup(_config(spark, sf_dir), _TAG)


def config_lookup_bronze(spark, sf_dir):
    return config.bronze_lookup(_config(spark, sf_dir), _TAG)


def config_lookup_all(spark, sf_dir):
    return config.silver_lookup(_config(spark, sf_dir), " * ")


_EXPORT_SINCE = datetime(1999, 6, 30)
_EXPORT_UNTIL = "2001-01-01 00:00:00"


def export_incremental(spark, sf_dir):
    start = _EXPORT_SINCE
    return export.changed_rows(
        read(spark, sf_dir, "lineitem"),
        start,
        "l_shipdate",
        select="l_orderkey, l_linenumber, l_shipdate, l_extendedprice",
    )


def export_incremental_sql(spark, sf_dir):
    """User SQL over two tables as the exported source."""
    read(spark, sf_dir, "lineitem").createOrReplaceTempView("tidemark_items")
    read(spark, sf_dir, "orders").createOrReplaceTempView("tidemark_orders")
    source = export.sql_source(
        spark,
        "SELECT o.o_orderkey, o.o_orderpriority, l.last_shipped, l.quantity "
        "FROM tidemark_orders o JOIN (SELECT l_orderkey, max(l_shipdate) AS last_shipped, "
        "sum(l_quantity) AS quantity FROM tidemark_items GROUP BY l_orderkey) l "
        "ON l.l_orderkey = o.o_orderkey",
    )
    return export.changed_rows(source, _EXPORT_SINCE, "last_shipped", include_previous=True)


def export_watermark(spark, sf_dir):
    return export.new_watermark(
        read(spark, sf_dir, "lineitem"), _EXPORT_SINCE, _EXPORT_UNTIL, "l_shipdate"
    )


def _history(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        "user_id",
        F.col("ts").alias("timestamp"),
        F.expr(
            "CASE WHEN event_type = 'purchase' AND value > 100 THEN 'VACUUM END' "
            "WHEN event_type = 'signup' AND value > 100 THEN 'VACUUM START' ELSE 'WRITE' END"
        ).alias("operation"),
    )


_UPKEEP_NOW = "2024-02-05 00:00:00"


def maintenance_due(spark, sf_dir):
    return upkeep.maintenance_due(_history(spark, sf_dir), _UPKEEP_NOW, ["user_id"])


# --- SQL twins ----------------------------------------------------------------------------------

_USABLE_SQL = f"""SELECT * FROM ({LOG_EVENTS_SQL}) WHERE NOT "IsPurged" AND NOT "IsIgnorable" """
_APPLIED_SQL = f"""SELECT * FROM ({_USABLE_SQL}) WHERE "BronzeTable" IN ('purchase', 'signup')"""
_SINCE_SQL = ts(str(_SINCE))
_PENDING_SQL = ", ".join(f'"{c}"' for c in _PENDING)
_ELIGIBLE_SQL = f"""SELECT *, CAST(weekofyear("ArchiveDatetimeUTC") AS INTEGER) AS "ArchiveWeekUTC"
    FROM ({LOG_ORDERS_SQL}) WHERE "ArchiveDatetimeUTC" <= {ts("2001-05-01 00:00:00")}"""
_LAST = """ORDER BY "ArchiveDatetimeUTC" DESC, substring(md5("ArchiveFilePath"), 1, 2) DESC,
    "ArchiveFilePath" DESC"""
_PERIODS = {
    "IsLastOfYearRowNbr": '"ArchiveYearUTC"',
    "IsLastOfMonthRowNbr": '"ArchiveYearUTC", "ArchiveMonthUTC"',
    "IsLastOfWeekRowNbr": '"ArchiveYearUTC", "ArchiveWeekUTC"',
    "IsLastOfDayRowNbr": '"ArchiveYearUTC", "ArchiveMonthUTC", "ArchiveDayUTC"',
}
_RANKS_SQL = (
    "SELECT *, "
    + ", ".join(
        f'CAST(row_number() OVER (PARTITION BY "ArchiveTable", {p} {_LAST}) AS INTEGER) AS "{n}"'
        for n, p in _PERIODS.items()
    )
    + f" FROM ({_ELIGIBLE_SQL})"
)
_RETAINED_SQL = ", ".join(f'"{c}"' for c in _RETAINED)


def _classified_sql(*kept: str) -> str:
    keep = " OR ".join(f'"{n}" = 1' for n in kept)
    return f'SELECT *, NOT ({keep}) AS "IsToBePurged" FROM ({_RANKS_SQL})'


_COARSE_SQL = _classified_sql("IsLastOfYearRowNbr", "IsLastOfMonthRowNbr")


def _size_text(column: str) -> str:
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    cases = " ".join(
        f"WHEN {column} < {1024 ** (i + 1)} THEN "
        f"CAST(round({column} / {1024**i}.0::DOUBLE, 2) AS VARCHAR) || ' {u}'"
        for i, u in enumerate(units)
    )
    return f"CASE WHEN {column} = 0 THEN '0B' {cases} END"


_SUMS_SQL = f"""SELECT "ArchiveTable",
    CAST(coalesce(sum("OriginalStagingFileSize") FILTER (WHERE NOT "IsPurged" AND "IsToBePurged"), 0)
        AS BIGINT) AS "BytesToPurge",
    CAST(coalesce(sum("OriginalStagingFileSize") FILTER (WHERE NOT "IsPurged"
        AND NOT "IsToBePurged"), 0) AS BIGINT) AS "BytesToRetain",
    CAST(coalesce(sum("OriginalStagingFileSize") FILTER (WHERE "IsPurged"), 0) AS BIGINT)
        AS "BytesPurged"
    FROM ({_COARSE_SQL}) GROUP BY ROLLUP ("ArchiveTable")"""

_CONFIG_SQL = """SELECT p_size >= 20 AS "IsActive", 'SELECT * FROM ' || p_name AS "Query",
    upper(p_name) AS "Dataset",
    CASE WHEN p_type = 'LARGE' THEN NULL ELSE 'FACT' END AS "Type", p_brand AS "BronzeSchema",
    p_name AS "BronzeTable", 'silver' AS "SilverSchema", p_name AS "SilverTable",
    'id' AS "BusinessKeyColumns", '*' AS "ExtractColumns", CAST(NULL AS VARCHAR) AS "ExcludeColumns",
    CASE WHEN p_size > 40 THEN 'year' END AS "DeleteFilterColumns",
    CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_brand || ' , ' || p_type END AS "Tag" FROM part"""
_TAGGED_SQL = f"""SELECT c.* FROM ({_CONFIG_SQL}) c, LATERAL (SELECT
    unnest(string_split(c."Tag", ',')) AS one) WHERE c."IsActive" AND
    lower(trim(one)) IN ('brand#3', 'promo')"""
_SILVER_SQL = ", ".join(f"""coalesce("{c}", '') AS "{c}" """ for c in config.SILVER_COLUMNS)

QUERIES = {
    "watermark": watermark,
    "watermark_first_run": watermark_first_run,
    "watermark_by_source": watermark_by_source,
    "pending_files": pending_files,
    "pending_unapplied": pending_unapplied,
    "process_log_rows": process_log_rows,
    "table_catalog_filter": table_catalog_filter,
    "retention_ranks": retention_ranks,
    "retention_classify": retention_classify,
    "retention_classify_coarse": retention_classify_coarse,
    "purge_summary": purge_summary,
    "purge_apply": purge_apply,
    "config_lookup": config_lookup,
    "config_lookup_bronze": config_lookup_bronze,
    "config_lookup_all": config_lookup_all,
    "export_incremental": export_incremental,
    "export_incremental_sql": export_incremental_sql,
    "export_watermark": export_watermark,
    "maintenance_due": maintenance_due,
}

ORACLES = {
    "watermark": f"""SELECT max("ArchiveDatetimeUTC") AS "ArchiveDatetimeUTC"
        FROM ({_USABLE_SQL})""",
    "watermark_first_run": f"""SELECT coalesce(max("ArchiveDatetimeUTC"),
        date_trunc('day', {ts(NOW)}) - INTERVAL 90 DAY) AS "ArchiveDatetimeUTC"
        FROM ({_USABLE_SQL}) WHERE "OriginalStagingFileSize" < 0""",
    "watermark_by_source": f"""SELECT "BronzeSchema", "BronzeTable",
        max("ArchiveDatetimeUTC") AS "ArchiveDatetimeUTC" FROM ({_USABLE_SQL}) GROUP BY 1, 2""",
    "pending_files": f"""SELECT {_PENDING_SQL} FROM ({LOG_EVENTS_SQL})
        WHERE "ArchiveDatetimeUTC" > {_SINCE_SQL} AND NOT "IsPurged" AND NOT "IsIgnorable" """,
    "pending_unapplied": f"""SELECT {_PENDING_SQL} FROM ({LOG_EVENTS_SQL})
        WHERE "ArchiveDatetimeUTC" >= {_SINCE_SQL} AND NOT "IsPurged" AND NOT "IsIgnorable"
        AND "ArchiveFilePath" NOT IN (SELECT "ArchiveFilePath" FROM ({_APPLIED_SQL}))""",
    "process_log_rows": f"""SELECT {ts(NOW)} AS "ProcessDatetime", "ArchiveDatetimeUTC",
        "OriginalStagingFilePath", "OriginalStagingFileName", "OriginalStagingFileSize",
        "ArchiveFilePath", "ArchiveFileName", "BronzeSchema", "BronzeTable"
        FROM ({_USABLE_SQL})""",
    "table_catalog_filter": f"""SELECT "ArchiveTable", count(*) AS n_files FROM ({LOG_ORDERS_SQL})
        WHERE starts_with("ArchiveTable", 'archive_')
        AND NOT starts_with("ArchiveTable", 'archive_low') GROUP BY 1""",
    "retention_ranks": f"""SELECT {_RETAINED_SQL}, {", ".join(f'"{n}"' for n in _PERIODS)}
        FROM ({_RANKS_SQL})""",
    "retention_classify": f"""SELECT {_RETAINED_SQL}, "IsPurged", "IsToBePurged"
        FROM ({_classified_sql(*_PERIODS)})""",
    "retention_classify_coarse": f"""SELECT {_RETAINED_SQL}, "IsPurged", "IsToBePurged"
        FROM ({_COARSE_SQL})""",
    "purge_summary": f"""SELECT *, {_size_text('"BytesToPurge"')} AS "BytesToPurgeText",
        {_size_text('"BytesToRetain"')} AS "BytesToRetainText",
        {_size_text('"BytesPurged"')} AS "BytesPurgedText" FROM ({_SUMS_SQL})""",
    "purge_apply": f"""WITH gone AS (SELECT "ArchiveDatetimeUTC", "ArchiveFilePath"
        FROM ({_COARSE_SQL}) WHERE NOT "IsPurged" AND "IsToBePurged"),
        l AS (SELECT *, EXISTS (SELECT 1 FROM gone g WHERE
            g."ArchiveFilePath" = o."ArchiveFilePath"
            AND g."ArchiveDatetimeUTC" = o."ArchiveDatetimeUTC") AS hit FROM ({LOG_ORDERS_SQL}) o)
        SELECT {_RETAINED_SQL}, hit OR "IsPurged" AS "IsPurged",
        CASE WHEN hit THEN {ts(RETENTION_NOW)} ELSE "PurgeDatetimeUTC" END AS "PurgeDatetimeUTC"
        FROM l""",
    "config_lookup": f"SELECT DISTINCT {_SILVER_SQL} FROM ({_TAGGED_SQL})",
    "config_lookup_bronze": f"""SELECT DISTINCT "Query", lower("Dataset") AS "Dataset"
        FROM ({_TAGGED_SQL})""",
    "config_lookup_all": f"""SELECT DISTINCT {_SILVER_SQL} FROM ({_CONFIG_SQL})
        WHERE "IsActive" AND "Tag" IS NOT NULL""",
    "export_incremental": f"""SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice
        FROM lineitem WHERE l_shipdate > {ts(str(_EXPORT_SINCE))}""",
    "export_incremental_sql": f"""SELECT * FROM (SELECT o.o_orderkey, o.o_orderpriority,
        max(l.l_shipdate) AS last_shipped, sum(l.l_quantity) AS quantity FROM orders o
        JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)
        WHERE last_shipped >= {ts(str(_EXPORT_SINCE))}""",
    "export_watermark": f"""SELECT max(l_shipdate) AS "ProcessDatetime" FROM lineitem
        WHERE l_shipdate >= {ts(str(_EXPORT_SINCE))} AND l_shipdate <= {ts(_EXPORT_UNTIL)}""",
    "maintenance_due": f"""SELECT user_id, days AS "LastMaintenanceSinceDays",
        days < 0 OR days >= 14 AS "IsDue" FROM (SELECT user_id,
        CAST(coalesce(date_diff('day', CAST(max(ts) FILTER (WHERE value > 100 AND
            event_type IN ('purchase', 'signup')) AS DATE), DATE '2024-02-05'), -1) AS INTEGER)
            AS days FROM events GROUP BY 1)""",
}
