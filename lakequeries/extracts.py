"""Change sets derived from the shared tables, in Spark and in SQL side by side.

Every extract reads its whole table. The order extract rolls: the table holds the orders up to mid
2000, the next extract starts in 1996 and reaches the end, so it misses old keys, repeats most, and
brings new ones. Open urgent orders come with another status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import with_row_hash
from tidemark.names import DELETED
from tidemark.operators.common import moment, with_audit
from tidemark.operators.scd2 import scd2_init

T0 = "2024-02-01 00:00:00"
T1 = "2024-02-02 00:00:00"
OLD_DELETE = "2024-01-15 00:00:00"
NOW = "2024-03-15 12:00:00"

ORDER_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)
ORDER_KEYS = ["o_orderkey"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ts(text: str) -> str:
    return f"CAST('{text}' AS TIMESTAMP)"


# --- orders: a table and the next extract ------------------------------------------------------

_BATCH_STATUS = (
    "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'X' "
    "ELSE o_orderstatus END"
)


def orders_at_t0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where("o_orderdate < TIMESTAMP_NTZ '2000-07-01'")


def orders_at_t1(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP_NTZ '1996-01-01'")
    return orders.withColumn("o_orderstatus", F.expr(_BATCH_STATUS))


def tagged(df: DataFrame, at: str, name: str) -> DataFrame:
    """Hash and audit columns of one batch."""
    return with_audit(with_row_hash(df), at, at, f"archive/{name}.parquet", f"{name}.parquet")


def target_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(orders_at_t0(spark, sf_dir), T0, "orders_0")


def batch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(orders_at_t1(spark, sf_dir), T1, "orders_1")


_WAS_DELETED = "o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderdate < {}'1997-01-01'"


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with some rows already soft deleted."""
    stamp = F.when(F.expr(_WAS_DELETED.format("TIMESTAMP_NTZ ")), moment(OLD_DELETE))
    return target_orders(spark, sf_dir).withColumn(DELETED, stamp)


def history_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_init(target_orders(spark, sf_dir), T0)


def recent(df: DataFrame) -> DataFrame:
    """A partial extract: years from 1999 on, without the orders still in process."""
    df = df.where("o_orderdate >= TIMESTAMP_NTZ '1999-01-01' AND o_orderstatus <> 'P'")
    return with_year(df)


def with_year(df: DataFrame) -> DataFrame:
    return df.withColumn("o_year", F.year("o_orderdate"))


_HASHED = ", ".join(ORDER_COLUMNS)
HASH_SQL = f"sha256(concat_ws('||', {_HASHED}))"


def _tagged_sql(source: str, at: str, name: str) -> str:
    return f"""SELECT *, {HASH_SQL} AS "__HashDiff", {ts(at)} AS "__ModifiedDatetimeUTC",
        {ts(at)} AS "__ArchiveDatetimeUTC", 'archive/{name}.parquet' AS "__ArchiveFilePath",
        '{name}.parquet' AS "__OriginalStagingFileName" FROM ({source})"""


T0_SQL = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01'"
T1_SQL = f"""SELECT o_orderkey, o_custkey, {_BATCH_STATUS} AS o_orderstatus, o_totalprice,
    o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"""
TARGET_SQL = _tagged_sql(T0_SQL, T0, "orders_0")
BATCH_SQL = _tagged_sql(T1_SQL, T1, "orders_1")
FACT_SQL = f"""SELECT *, CASE WHEN {_WAS_DELETED.format("TIMESTAMP ")} THEN {ts(OLD_DELETE)} END
    AS "__DeletedDatetimeUTC" FROM ({TARGET_SQL})"""
HISTORY_SQL = f"""SELECT *, {ts(T0)} AS "__StartDatetimeUTC",
    {ts("9999-12-31 00:00:00")} AS "__EndDatetimeUTC", TRUE AS "__Current" FROM ({TARGET_SQL})"""
RECENT_SQL = f"""SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({BATCH_SQL})
    WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderstatus <> 'P'"""

AUDIT_COLUMNS = (
    "__ModifiedDatetimeUTC",
    "__ArchiveDatetimeUTC",
    "__ArchiveFilePath",
    "__OriginalStagingFileName",
)
TAGGED_COLUMNS = (*ORDER_COLUMNS, "__HashDiff", *AUDIT_COLUMNS)


def names(columns, prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in columns)


# --- a backlog of order snapshots ---------------------------------------------------------------

SNAPSHOTS = range(1, 7)


def snapshot_time(i: int) -> str:
    return f"2024-02-{i + 1:02d} 00:00:00"


def _snapshot_rules(i: int, date_type: str) -> tuple[str, str]:
    """Rows and status of snapshot ``i``: each leaves out one year, and more and more orders close.

    The orders of 2001 arrive with snapshot 4; snapshot 0 is the table, without the year 2000.
    """
    missing = 2000 if i == 0 else 1994 + i
    rows = f"year(o_orderdate) <> {missing}"
    if i < 4:
        rows += f" AND o_orderdate < {date_type} '2001-01-01'"
    status = f"CASE WHEN o_totalprice < {70000 * i} THEN 'C' ELSE o_orderstatus END"
    return rows, status


def snapshot(spark: SparkSession, sf_dir: str, i: int) -> DataFrame:
    rows, status = _snapshot_rules(i, "TIMESTAMP_NTZ")
    df = read(spark, sf_dir, "orders").where(rows).withColumn("o_orderstatus", F.expr(status))
    return tagged(df, snapshot_time(i), f"orders_{i}")


def snapshot_sql(i: int) -> str:
    rows, status = _snapshot_rules(i, "TIMESTAMP")
    source = f"""SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, o_totalprice,
        o_orderdate, o_orderpriority FROM orders WHERE {rows}"""
    return _tagged_sql(source, snapshot_time(i), f"orders_{i}")


def scoped_snapshot(spark: SparkSession, sf_dir: str, i: int) -> DataFrame:
    """Partial snapshot: two years only, from which cheap orders in process have vanished."""
    df = with_year(snapshot(spark, sf_dir, i))
    df = df.where(_scope_rule(i))
    return with_row_hash(df, [*ORDER_COLUMNS, "o_year"])


def _scope_rule(i: int) -> str:
    return (
        f"o_year IN ({1995 + i}, {1996 + i}) "
        f"AND NOT (o_orderstatus = 'P' AND o_totalprice < {100000 * i})"
    )


SCOPED_HASH_SQL = f"""sha256(concat_ws('||', {_HASHED}, o_year))"""


def scoped_snapshot_sql(i: int) -> str:
    inner = f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({snapshot_sql(i)})"
    return f"""SELECT * REPLACE ({SCOPED_HASH_SQL} AS "__HashDiff") FROM ({inner})
        WHERE {_scope_rule(i)}"""


def scoped_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_year(snapshot(spark, sf_dir, 0))
    return with_row_hash(df, [*ORDER_COLUMNS, "o_year"])


SCOPED_BASE_SQL = f"""SELECT * REPLACE ({SCOPED_HASH_SQL} AS "__HashDiff") FROM (
    SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({snapshot_sql(0)}))"""


# --- archive logs -------------------------------------------------------------------------------


def log_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event is one archived file, its type the source table."""
    return read(spark, sf_dir, "events").select(
        F.col("ts").alias("ArchiveDatetimeUTC"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("ArchiveyyyyMMddUTC"),
        F.expr("concat('ingest/', event_type, '/', event_id, '.json')").alias(
            "OriginalStagingFilePath"
        ),
        F.expr("concat(event_id, '.json')").alias("OriginalStagingFileName"),
        F.expr("cast(floor(value * 1000) AS bigint)").alias("OriginalStagingFileSize"),
        F.date_trunc("hour", F.col("ts")).alias("OriginalModificationTime"),
        F.expr("concat('archive/', event_type, '/', event_id, '.json')").alias("ArchiveFilePath"),
        F.expr("concat(event_id, '.json')").alias("ArchiveFileName"),
        F.expr("value < 2.0").alias("IsPurged"),
        F.expr("event_type = 'error'").alias("IsIgnorable"),
        F.lit("web").alias("BronzeSchema"),
        F.col("event_type").alias("BronzeTable"),
    )


LOG_EVENTS_SQL = """SELECT ts AS "ArchiveDatetimeUTC",
    CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS "ArchiveyyyyMMddUTC",
    concat('ingest/', event_type, '/', event_id, '.json') AS "OriginalStagingFilePath",
    concat(event_id, '.json') AS "OriginalStagingFileName",
    CAST(floor(value * 1000) AS BIGINT) AS "OriginalStagingFileSize",
    date_trunc('hour', ts) AS "OriginalModificationTime",
    concat('archive/', event_type, '/', event_id, '.json') AS "ArchiveFilePath",
    concat(event_id, '.json') AS "ArchiveFileName",
    value < 2.0 AS "IsPurged", event_type = 'error' AS "IsIgnorable",
    'web' AS "BronzeSchema", event_type AS "BronzeTable" FROM events"""

RETENTION_NOW = "2001-06-01 00:00:00"


def log_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order is one archived file, its priority the archive table; days hold many ties."""
    return read(spark, sf_dir, "orders").select(
        F.expr("concat('archive_', lower(replace(substring(o_orderpriority, 3), ' ', '_')))").alias(
            "ArchiveTable"
        ),
        F.col("o_orderdate").alias("ArchiveDatetimeUTC"),
        F.year("o_orderdate").alias("ArchiveYearUTC"),
        F.month("o_orderdate").alias("ArchiveMonthUTC"),
        F.dayofmonth("o_orderdate").alias("ArchiveDayUTC"),
        F.expr("cast(floor(o_totalprice) AS bigint)").alias("OriginalStagingFileSize"),
        F.expr("concat('archive/', o_orderkey)").alias("ArchiveFilePath"),
        F.expr("o_orderstatus = 'F' AND o_totalprice < 50000").alias("IsPurged"),
        F.lit(None).cast("timestamp_ntz").alias("PurgeDatetimeUTC"),
    )


LOG_ORDERS_SQL = """SELECT
    concat('archive_', lower(replace(substring(o_orderpriority, 3), ' ', '_'))) AS "ArchiveTable",
    o_orderdate AS "ArchiveDatetimeUTC",
    CAST(year(o_orderdate) AS INTEGER) AS "ArchiveYearUTC",
    CAST(month(o_orderdate) AS INTEGER) AS "ArchiveMonthUTC",
    CAST(day(o_orderdate) AS INTEGER) AS "ArchiveDayUTC",
    CAST(floor(o_totalprice) AS BIGINT) AS "OriginalStagingFileSize",
    concat('archive/', o_orderkey) AS "ArchiveFilePath",
    o_orderstatus = 'F' AND o_totalprice < 50000 AS "IsPurged",
    CAST(NULL AS TIMESTAMP) AS "PurgeDatetimeUTC" FROM orders"""
