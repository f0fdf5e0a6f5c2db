"""Single-batch change operators on the rolling order extract."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakequeries.extracts import (
    AUDIT_COLUMNS,
    BATCH_SQL,
    FACT_SQL,
    HISTORY_SQL,
    NOW,
    ORDER_KEYS,
    RECENT_SQL,
    T0,
    T0_SQL,
    T1,
    TAGGED_COLUMNS,
    TARGET_SQL,
    batch_orders,
    fact_orders,
    history_orders,
    names,
    read,
    recent,
    tagged,
    target_orders,
    ts,
    with_year,
)
from tidemark.names import START
from tidemark.operators import merge, scd2
from tidemark.operators.common import moment
from tidemark.operators.evolve import evolve_union, repair_type

# --- SCD1 ---------------------------------------------------------------------------------------


def scd1_upsert(spark, sf_dir):
    return merge.scd1_merge(target_orders(spark, sf_dir), batch_orders(spark, sf_dir), ORDER_KEYS)


_FROZEN = "t.o_orderdate >= {}'1998-01-01' AND s.o_totalprice < 300000"


def scd1_update_filter(spark, sf_dir):
    return merge.scd1_merge(
        target_orders(spark, sf_dir),
        batch_orders(spark, sf_dir),
        ORDER_KEYS,
        update_filter=_FROZEN.format("TIMESTAMP_NTZ "),
    )


_LOOSE_KEY = "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderdate >= {}'2000-01-01' "
_LOOSE_KEY += "THEN NULL ELSE o_orderkey END"


def scd1_nullunsafe(spark, sf_dir):
    """Orders without a number never match under plain equality: always inserted."""
    key = F.expr(_LOOSE_KEY.format("TIMESTAMP_NTZ "))
    return merge.scd1_merge(
        target_orders(spark, sf_dir).withColumn("order_no", key),
        batch_orders(spark, sf_dir).withColumn("order_no", key),
        ["order_no"],
        null_safe=False,
    )


def partition_pruned_merge(spark, sf_dir):
    """The batch holds three years; only those partitions of the table are merged."""
    merged, untouched = merge.partition_pruned_merge(
        with_year(target_orders(spark, sf_dir)),
        recent(batch_orders(spark, sf_dir)),
        ORDER_KEYS,
        ["o_year"],
    )
    return merged.unionByName(untouched)


# --- FACT ---------------------------------------------------------------------------------------


def fact_merge(spark, sf_dir):
    return merge.fact_merge(fact_orders(spark, sf_dir), batch_orders(spark, sf_dir), ORDER_KEYS)


def fact_merge_simple(spark, sf_dir):
    return merge.fact_merge(
        fact_orders(spark, sf_dir), batch_orders(spark, sf_dir), ORDER_KEYS, resurrect=False
    )


def soft_delete_full(spark, sf_dir):
    return merge.mark_deleted(
        fact_orders(spark, sf_dir), batch_orders(spark, sf_dir), ORDER_KEYS, NOW
    )


def soft_delete_scoped(spark, sf_dir):
    return merge.mark_deleted(
        with_year(fact_orders(spark, sf_dir)),
        recent(batch_orders(spark, sf_dir)),
        ORDER_KEYS,
        NOW,
        scope_cols=["o_year"],
    )


def fact_apply(spark, sf_dir):
    """Merge and scoped soft delete in one join."""
    return merge.fact_apply(
        with_year(fact_orders(spark, sf_dir)),
        recent(batch_orders(spark, sf_dir)),
        ORDER_KEYS,
        NOW,
        deletes=["o_year"],
    )


# --- SCD2 ---------------------------------------------------------------------------------------


def scd2_init(spark, sf_dir):
    """A first load of all orders."""
    return scd2.scd2_init(tagged(read(spark, sf_dir, "orders"), T0, "orders_0"), T0)


def scd2_merge(spark, sf_dir):
    return scd2.scd2_merge(
        history_orders(spark, sf_dir), batch_orders(spark, sf_dir), ORDER_KEYS, T1
    )


def scd2_merge_full(spark, sf_dir):
    return scd2.scd2_merge(
        history_orders(spark, sf_dir), batch_orders(spark, sf_dir), ORDER_KEYS, T1, deletes="full"
    )


def scd2_close_missing(spark, sf_dir):
    return scd2.close_missing(
        history_orders(spark, sf_dir), batch_orders(spark, sf_dir), ORDER_KEYS, T1
    )


def scd2_close_scoped(spark, sf_dir):
    return scd2.close_missing(
        with_year(history_orders(spark, sf_dir)),
        recent(batch_orders(spark, sf_dir)),
        ORDER_KEYS,
        T1,
        scope_cols=["o_year"],
    )


def _versions(spark, sf_dir):
    """An append-only history with two versions of the changed orders."""
    first = target_orders(spark, sf_dir).drop("__ModifiedDatetimeUTC")
    second = batch_orders(spark, sf_dir).drop("__ModifiedDatetimeUTC")
    return scd2.scd2_append(first.withColumn(START, moment(T0)), second, ORDER_KEYS, T1)


def scd2_append(spark, sf_dir):
    return _versions(spark, sf_dir)


def current_versions(spark, sf_dir):
    return scd2.current_versions(_versions(spark, sf_dir), ORDER_KEYS)


# --- schema -------------------------------------------------------------------------------------


def schema_evolve_union(spark, sf_dir):
    """The batch brings a new column and a wider key."""
    old = target_orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_custkey", "o_orderstatus"
    )
    new = batch_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return evolve_union(old, new)


def schema_type_repair(spark, sf_dir):
    items = read_items(spark, sf_dir).withColumn("l_quantity", F.col("l_quantity").cast("int"))
    return repair_type(items, "l_quantity", "bigint")


def read_items(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


# --- SQL twins ----------------------------------------------------------------------------------

_WITH = f"WITH t AS MATERIALIZED ({TARGET_SQL}), s AS MATERIALIZED ({BATCH_SQL})"
_CHANGED = 's."__HashDiff" <> t."__HashDiff"'


def _scd1_sql(extra: str = "") -> str:
    take = f"t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND {_CHANGED}{extra})"
    out = ", ".join(
        f'CASE WHEN {take} THEN s."{c}" ELSE t."{c}" END AS "{c}"' for c in TAGGED_COLUMNS
    )
    return f"{_WITH} SELECT {out} FROM t FULL JOIN s ON t.o_orderkey IS NOT DISTINCT FROM s.o_orderkey"


def _nullunsafe_sql() -> str:
    key = _LOOSE_KEY.format("TIMESTAMP ")
    columns = (*TAGGED_COLUMNS, "order_no")
    out = ", ".join(
        f'CASE WHEN t."__HashDiff" IS NULL OR (s."__HashDiff" IS NOT NULL AND {_CHANGED}) '
        f'THEN s."{c}" ELSE t."{c}" END AS "{c}"'
        for c in columns
    )
    return f"""WITH t AS (SELECT *, {key} AS order_no FROM ({TARGET_SQL})),
        s AS (SELECT *, {key} AS order_no FROM ({BATCH_SQL}))
        SELECT {out} FROM t FULL JOIN s ON t.order_no = s.order_no"""


def _pruned_sql() -> str:
    columns = (*TAGGED_COLUMNS, "o_year")
    out = ", ".join(
        f'CASE WHEN t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND {_CHANGED}) '
        f'THEN s."{c}" ELSE t."{c}" END AS "{c}"'
        for c in columns
    )
    return f"""WITH t AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year
        FROM ({TARGET_SQL})), s AS ({RECENT_SQL})
        SELECT {out} FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey"""


def _fact_sql(
    resurrect: bool,
    target: str = FACT_SQL,
    source: str = BATCH_SQL,
    columns=TAGGED_COLUMNS,
    gone: str = "FALSE",
) -> str:
    take = f"t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND {_CHANGED})"
    back = 's."__HashDiff" = t."__HashDiff" AND t."__DeletedDatetimeUTC" IS NOT NULL'
    out = []
    for c in columns:
        value = f'CASE WHEN {take} THEN s."{c}" '
        if c == "__ModifiedDatetimeUTC":
            value += f"WHEN {gone} THEN {ts(NOW)} "
        if resurrect and c in AUDIT_COLUMNS:
            value += f'WHEN {back} THEN s."{c}" '
        out.append(value + f'ELSE t."{c}" END AS "{c}"')
    deleted = f"CASE WHEN {take} THEN NULL WHEN {gone} THEN {ts(NOW)} "
    if resurrect:
        deleted += f"WHEN {back} THEN NULL "
    out.append(deleted + 'ELSE t."__DeletedDatetimeUTC" END AS "__DeletedDatetimeUTC"')
    return f"""WITH t AS MATERIALIZED ({target}), s AS MATERIALIZED ({source})
        SELECT {", ".join(out)} FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey"""


_FACT_YEAR_SQL = f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({FACT_SQL})"


def _delete_sql(target: str, source: str, columns, scoped: bool) -> str:
    test = 't."__DeletedDatetimeUTC" IS NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey)'
    if scoped:
        test += " AND EXISTS (SELECT 1 FROM s WHERE s.o_year IS NOT DISTINCT FROM t.o_year)"
    plain = names([c for c in columns if c != "__ModifiedDatetimeUTC"])
    return f"""WITH t AS ({target}), s AS ({source}), f AS (SELECT *, {test} AS gone FROM t)
        SELECT {plain},
        CASE WHEN gone THEN {ts(NOW)} ELSE "__ModifiedDatetimeUTC" END AS "__ModifiedDatetimeUTC",
        CASE WHEN gone THEN {ts(NOW)} ELSE "__DeletedDatetimeUTC" END AS "__DeletedDatetimeUTC"
        FROM f"""


_OPEN = f"""{ts(T1)} AS "__StartDatetimeUTC", {ts("9999-12-31 00:00:00")} AS "__EndDatetimeUTC",
    TRUE AS "__Current" """


def _scd2_sql(closes: str, target=HISTORY_SQL, source=BATCH_SQL, columns=TAGGED_COLUMNS, insert=True):
    sql = f"""WITH t AS MATERIALIZED ({target}), s AS MATERIALIZED ({source}),
        f AS (SELECT t.*, {closes} AS closes FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey)
        SELECT {names(columns)}, "__StartDatetimeUTC",
        CASE WHEN closes THEN {ts(T1)} ELSE "__EndDatetimeUTC" END AS "__EndDatetimeUTC",
        NOT closes AS "__Current" FROM f"""
    if insert:
        sql += f""" UNION ALL SELECT {names(columns, "s.")}, {_OPEN} FROM s
            WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey
            AND t."__HashDiff" = s."__HashDiff")"""
    return sql


_HISTORY_YEAR_SQL = f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({HISTORY_SQL})"
_DIFFERS = f"coalesce({_CHANGED}, FALSE)"
_APPEND_COLUMNS = [c for c in TAGGED_COLUMNS if c != "__ModifiedDatetimeUTC"]
_APPEND_SQL = f"""{_WITH}, v AS MATERIALIZED (
    SELECT {names(_APPEND_COLUMNS)}, {ts(T0)} AS "__StartDatetimeUTC" FROM t
    UNION ALL SELECT {names(_APPEND_COLUMNS)}, {ts(T1)} FROM s WHERE NOT EXISTS (
    SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey AND t."__HashDiff" = s."__HashDiff"))"""

QUERIES = {
    "scd1_upsert": scd1_upsert,
    "scd1_update_filter": scd1_update_filter,
    "scd1_nullunsafe": scd1_nullunsafe,
    "partition_pruned_merge": partition_pruned_merge,
    "fact_merge": fact_merge,
    "fact_merge_simple": fact_merge_simple,
    "fact_apply": fact_apply,
    "soft_delete_full": soft_delete_full,
    "soft_delete_scoped": soft_delete_scoped,
    "scd2_init": scd2_init,
    "scd2_merge": scd2_merge,
    "scd2_merge_full": scd2_merge_full,
    "scd2_close_missing": scd2_close_missing,
    "scd2_close_scoped": scd2_close_scoped,
    "scd2_append": scd2_append,
    "current_versions": current_versions,
    "schema_evolve_union": schema_evolve_union,
    "schema_type_repair": schema_type_repair,
}

ORACLES = {
    "scd1_upsert": _scd1_sql(),
    "scd1_update_filter": _scd1_sql(" AND " + _FROZEN.format("TIMESTAMP ")),
    "scd1_nullunsafe": _nullunsafe_sql(),
    "partition_pruned_merge": _pruned_sql(),
    "fact_merge": _fact_sql(True),
    "fact_merge_simple": _fact_sql(False),
    "fact_apply": _fact_sql(
        True,
        _FACT_YEAR_SQL,
        RECENT_SQL,
        (*TAGGED_COLUMNS, "o_year"),
        's.o_orderkey IS NULL AND t."__DeletedDatetimeUTC" IS NULL '
        "AND t.o_year IN (SELECT o_year FROM s)",
    ),
    "soft_delete_full": _delete_sql(FACT_SQL, BATCH_SQL, TAGGED_COLUMNS, False),
    "soft_delete_scoped": _delete_sql(
        _FACT_YEAR_SQL, RECENT_SQL, (*TAGGED_COLUMNS, "o_year"), True
    ),
    "scd2_init": HISTORY_SQL.replace(T0_SQL, "SELECT * FROM orders"),
    "scd2_merge": _scd2_sql(_DIFFERS),
    "scd2_merge_full": _scd2_sql(f"(s.o_orderkey IS NULL OR {_DIFFERS})"),
    "scd2_close_missing": _scd2_sql("s.o_orderkey IS NULL", insert=False),
    "scd2_close_scoped": _scd2_sql(
        "(s.o_orderkey IS NULL AND t.o_year IN (SELECT o_year FROM s))",
        _HISTORY_YEAR_SQL,
        RECENT_SQL,
        (*TAGGED_COLUMNS, "o_year"),
        insert=False,
    ),
    "scd2_append": f"{_APPEND_SQL} SELECT * FROM v",
    "current_versions": f"""{_APPEND_SQL} SELECT * FROM v QUALIFY
        rank() OVER (PARTITION BY o_orderkey ORDER BY "__StartDatetimeUTC" DESC) = 1""",
    "schema_evolve_union": f"""{_WITH} SELECT o_orderkey, o_custkey, o_orderstatus,
        CAST(NULL AS VARCHAR) AS o_orderpriority FROM t UNION ALL
        SELECT o_orderkey, NULL, o_orderstatus, o_orderpriority FROM s""",
    "schema_type_repair": """SELECT l_orderkey, l_linenumber,
        CAST(CAST(l_quantity AS INTEGER) AS BIGINT) AS l_quantity FROM lineitem""",
}
