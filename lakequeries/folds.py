"""A backlog of six snapshots applied in one pass; the SQL twins replay it batch by batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lakequeries.extracts import (
    AUDIT_COLUMNS,
    ORDER_KEYS,
    SCOPED_BASE_SQL,
    SNAPSHOTS,
    TAGGED_COLUMNS,
    names,
    scoped_base,
    scoped_snapshot,
    scoped_snapshot_sql,
    snapshot,
    snapshot_sql,
    snapshot_time,
    ts,
)
from tidemark.names import ARCHIVED, BATCH, DELETED, MODIFIED, START
from tidemark.operators import fold, scd2
from tidemark.operators.common import moment


def backlog(spark, sf_dir, make=snapshot):
    parts = [make(spark, sf_dir, i).withColumn(BATCH, F.lit(i)) for i in SNAPSHOTS]
    return reduce(lambda a, b: a.unionByName(b), parts)


def batch_log(spark):
    rows = [(i, snapshot_time(i), snapshot_time(i)) for i in SNAPSHOTS]
    log = spark.createDataFrame(rows, f"{BATCH} int, archived string, modified string")
    return log.select(
        BATCH,
        F.col("archived").cast("timestamp_ntz").alias(ARCHIVED),
        F.col("modified").cast("timestamp_ntz").alias(MODIFIED),
    )


def _live(df):
    return df.withColumn(DELETED, F.lit(None).cast("timestamp_ntz"))


def scd1_fold(spark, sf_dir):
    return fold.scd1_fold(snapshot(spark, sf_dir, 0), backlog(spark, sf_dir), ORDER_KEYS)


def fact_fold(spark, sf_dir):
    return fold.fact_fold(
        _live(snapshot(spark, sf_dir, 0)), backlog(spark, sf_dir), ORDER_KEYS, batch_log(spark)
    )


def fact_fold_scoped(spark, sf_dir):
    return fold.fact_fold(
        _live(scoped_base(spark, sf_dir)),
        backlog(spark, sf_dir, scoped_snapshot),
        ORDER_KEYS,
        batch_log(spark),
        deletes=["o_year"],
    )


def scd2_fold(spark, sf_dir):
    base = scd2.scd2_init(snapshot(spark, sf_dir, 0), snapshot_time(0))
    return fold.scd2_fold(base, backlog(spark, sf_dir), ORDER_KEYS, batch_log(spark))


def scd2_fold_scoped(spark, sf_dir):
    base = scd2.scd2_init(scoped_base(spark, sf_dir), snapshot_time(0))
    return fold.scd2_fold(
        base,
        backlog(spark, sf_dir, scoped_snapshot),
        ORDER_KEYS,
        batch_log(spark),
        deletes=["o_year"],
    )


def scd2_append_fold(spark, sf_dir):
    base = snapshot(spark, sf_dir, 0).withColumn(START, moment(snapshot_time(0)))
    fresh = fold.append_fold(base, backlog(spark, sf_dir), ORDER_KEYS)
    return base.unionByName(fresh)


# --- SQL twins: one merge per batch --------------------------------------------------------------

_SAME = "t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey"
_CHANGED = 's."__HashDiff" <> t."__HashDiff"'
_TAKE = f"t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND {_CHANGED})"
_YEAR_COLUMNS = (*TAGGED_COLUMNS, "o_year")


def replay_sql(base: str, step, source=snapshot_sql) -> str:
    parts = [f"t0 AS MATERIALIZED ({base})"]
    for i in SNAPSHOTS:
        parts.append(f"s{i} AS MATERIALIZED ({source(i)})")
        parts.append(f"t{i} AS MATERIALIZED ({step(i)})")
    return f"WITH {', '.join(parts)} SELECT * FROM t{SNAPSHOTS[-1]}"


def scd1_step(i: int) -> str:
    out = ", ".join(
        f'CASE WHEN {_TAKE} THEN s."{c}" ELSE t."{c}" END AS "{c}"' for c in TAGGED_COLUMNS
    )
    return f"SELECT {out} FROM t{i - 1} t FULL JOIN s{i} s ON {_SAME}"


def fact_step(columns, scope: str = ""):
    def step(i: int) -> str:
        now = ts(snapshot_time(i))
        gone = 's.o_orderkey IS NULL AND t."__DeletedDatetimeUTC" IS NULL'
        if scope:
            gone += f" AND t.{scope} IN (SELECT {scope} FROM s{i})"
        back = f's."__HashDiff" = t."__HashDiff" AND t."{DELETED}" IS NOT NULL'
        out = []
        for c in columns:
            value = f'CASE WHEN {_TAKE} THEN s."{c}" '
            if c == MODIFIED:
                value += f"WHEN {gone} THEN {now} "
            if c in AUDIT_COLUMNS:
                value += f'WHEN {back} THEN s."{c}" '
            out.append(value + f'ELSE t."{c}" END AS "{c}"')
        out.append(
            f'CASE WHEN {_TAKE} THEN NULL WHEN {gone} THEN {now} WHEN {back} THEN NULL '
            f'ELSE t."{DELETED}" END AS "{DELETED}"'
        )
        return f"SELECT {', '.join(out)} FROM t{i - 1} t FULL JOIN s{i} s ON {_SAME}"

    return step


_OPEN_END = ts("9999-12-31 00:00:00")


def scd2_step(columns, scope: str = ""):
    def step(i: int) -> str:
        now = ts(snapshot_time(i))
        lost = "s.o_orderkey IS NULL"
        if scope:
            lost += f" AND t.{scope} IN (SELECT {scope} FROM s{i})"
        return f"""SELECT * FROM t{i - 1} WHERE NOT "__Current"
            UNION ALL SELECT {names(columns, "t.")}, t."__StartDatetimeUTC",
                CASE WHEN ({lost}) OR coalesce({_CHANGED}, FALSE) THEN {now}
                    ELSE t."__EndDatetimeUTC" END,
                NOT (({lost}) OR coalesce({_CHANGED}, FALSE))
            FROM t{i - 1} t LEFT JOIN s{i} s ON {_SAME} WHERE t."__Current"
            UNION ALL SELECT {names(columns, "s.")}, {now}, {_OPEN_END}, TRUE FROM s{i} s
            WHERE NOT EXISTS (SELECT 1 FROM t{i - 1} t WHERE t."__Current" AND {_SAME}
                AND s."__HashDiff" = t."__HashDiff")"""

    return step


def append_step(i: int) -> str:
    return f"""SELECT * FROM t{i - 1} UNION ALL
        SELECT {names(TAGGED_COLUMNS, "s.")}, {ts(snapshot_time(i))} FROM s{i} s
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM t{i - 1} QUALIFY
            rank() OVER (PARTITION BY o_orderkey ORDER BY "__StartDatetimeUTC" DESC) = 1) t
            WHERE {_SAME} AND s."__HashDiff" = t."__HashDiff")"""


def opened_sql(base: str, columns) -> str:
    return f"""SELECT {names(columns)}, {ts(snapshot_time(0))} AS "__StartDatetimeUTC",
        {_OPEN_END} AS "__EndDatetimeUTC", TRUE AS "__Current" FROM ({base})"""


def unstamped_sql(base: str, columns) -> str:
    return f'SELECT {names(columns)}, CAST(NULL AS TIMESTAMP) AS "{DELETED}" FROM ({base})'


QUERIES = {
    "scd1_fold": scd1_fold,
    "fact_fold": fact_fold,
    "fact_fold_scoped": fact_fold_scoped,
    "scd2_fold": scd2_fold,
    "scd2_fold_scoped": scd2_fold_scoped,
    "scd2_append_fold": scd2_append_fold,
}

ORACLES = {
    "scd1_fold": replay_sql(f"SELECT {names(TAGGED_COLUMNS)} FROM ({snapshot_sql(0)})", scd1_step),
    "fact_fold": replay_sql(
        unstamped_sql(snapshot_sql(0), TAGGED_COLUMNS), fact_step(TAGGED_COLUMNS)
    ),
    "fact_fold_scoped": replay_sql(
        unstamped_sql(SCOPED_BASE_SQL, _YEAR_COLUMNS),
        fact_step(_YEAR_COLUMNS, "o_year"),
        scoped_snapshot_sql,
    ),
    "scd2_fold": replay_sql(opened_sql(snapshot_sql(0), TAGGED_COLUMNS), scd2_step(TAGGED_COLUMNS)),
    "scd2_fold_scoped": replay_sql(
        opened_sql(SCOPED_BASE_SQL, _YEAR_COLUMNS),
        scd2_step(_YEAR_COLUMNS, "o_year"),
        scoped_snapshot_sql,
    ),
    "scd2_append_fold": replay_sql(
        f"""SELECT {names(TAGGED_COLUMNS)}, {ts(snapshot_time(0))} AS "__StartDatetimeUTC"
            FROM ({snapshot_sql(0)})""",
        append_step,
    ),
}
