"""Projections, hashes and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakequeries.extracts import ORDER_COLUMNS, read
from tidemark.functions import columns as C
from tidemark.functions import text as X
from tidemark.functions.hashing import with_primary_key, with_row_hash

_ORDER_LIST = ", ".join(ORDER_COLUMNS)


def row_hash(spark, sf_dir):
    return with_row_hash(read(spark, sf_dir, "orders")).select("o_orderkey", "__HashDiff")


def _json_events(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return events.select(
        "event_id", "event_type", F.from_json("props", "struct<k:int>").alias("props")
    )


def row_hash_json(spark, sf_dir):
    return with_row_hash(_json_events(spark, sf_dir), mode="json").select("event_id", "__HashDiff")


def surrogate_key(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem")
    keyed = with_primary_key(items, ["l_orderkey", "l_linenumber"])
    return keyed.select("l_orderkey", "l_linenumber", "__PrimaryKey")


def extract_columns(spark, sf_dir):
    return C.select_columns(
        read(spark, sf_dir, "orders"),
        "[o_orderkey], upper([o_orderpriority]) AS priority, [o_totalprice] * 2 AS twice",
    )


def exclude_columns(spark, sf_dir):
    kept = C.exclude_columns(read(spark, sf_dir, "customer"), ["c_acctbal", "c_name", "absent"])
    return with_row_hash(kept)


def derived_partitions(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return C.derive_columns(
        orders,
        "year(o_orderdate) AS __year, month(o_orderdate) AS __month, "
        "dayofmonth(o_orderdate) AS __dayofmonth",
    )


def clean_names(spark, sf_dir):
    supplier = read(spark, sf_dir, "supplier")
    return C.clean_names(
        supplier.withColumnsRenamed({"s_suppkey": "supplier key", "s_acctbal": "account balance"})
    )


def clean_names_full(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return C.clean_names_full(
        part.withColumnsRenamed(
            {
                "p_partkey": "value.part key",
                "p_name": "[name]",
                "p_brand": "brand(code)",
                "p_type": "kind.of=part",
                "p_size": "size;cm,whole",
                "p_retailprice": "price{retail}",
            }
        )
    )


def complex_as_string(spark, sf_dir):
    nested = _json_events(spark, sf_dir).withColumn(
        "labels", F.array(F.col("event_type"), F.col("props.k").cast("string"))
    )
    return C.complex_as_string(nested)


def nonnull_keys(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.expr("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END")
    )
    return C.nonnull_keys(orders, ["o_orderkey", "o_custkey"])


def bounded_strings(spark, sf_dir):
    """Which string columns of the documents and conversations would overflow 4000 characters."""
    docs = X.string_length_report(read(spark, sf_dir, "documents"), 4000)
    talk = X.string_length_report(read(spark, sf_dir, "conversations"), 4000)
    tagged = docs.withColumn("table_name", F.lit("documents"))
    return tagged.unionByName(talk.withColumn("table_name", F.lit("conversations")))


def checked_strings(spark, sf_dir):
    """Whole texts that pass the length check of a warehouse column."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    fits = X.bound_strings(docs, 1_000_000)
    return fits.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n"))


def _report_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
        f"CAST(max(length({c})) AS INTEGER) AS max_length, "
        f"count(*) FILTER (WHERE length({c}) > 4000) AS n_too_long FROM {table}"
        for c in columns
    )


QUERIES = {
    "row_hash": row_hash,
    "row_hash_json": row_hash_json,
    "surrogate_key": surrogate_key,
    "extract_columns": extract_columns,
    "exclude_columns": exclude_columns,
    "derived_partitions": derived_partitions,
    "clean_names": clean_names,
    "clean_names_full": clean_names_full,
    "complex_as_string": complex_as_string,
    "nonnull_keys": nonnull_keys,
    "bounded_strings": bounded_strings,
    "checked_strings": checked_strings,
}

ORACLES = {
    "row_hash": f"""SELECT o_orderkey, sha256(concat_ws('||', {_ORDER_LIST})) AS "__HashDiff"
        FROM orders""",
    "row_hash_json": """SELECT event_id, sha256('{"event_id":' || event_id || ',"event_type":"'
        || event_type || '","props":{"k":' || json_extract_string(props, '$.k') || '}}')
        AS "__HashDiff" FROM events""",
    "surrogate_key": """SELECT l_orderkey, l_linenumber,
        sha1(concat_ws('||', l_orderkey, l_linenumber)) AS "__PrimaryKey" FROM lineitem""",
    "extract_columns": """SELECT o_orderkey, upper(o_orderpriority) AS priority,
        o_totalprice * 2 AS twice FROM orders""",
    "exclude_columns": """SELECT c_custkey, c_nationkey, c_mktsegment,
        sha256(concat_ws('||', c_custkey, c_nationkey, c_mktsegment)) AS "__HashDiff"
        FROM customer""",
    "derived_partitions": """SELECT o_orderkey, o_orderdate,
        CAST(year(o_orderdate) AS INTEGER) AS "__year",
        CAST(month(o_orderdate) AS INTEGER) AS "__month",
        CAST(day(o_orderdate) AS INTEGER) AS "__dayofmonth" FROM orders""",
    "clean_names": """SELECT s_suppkey AS supplier_key, s_name, s_nationkey,
        s_acctbal AS account_balance FROM supplier""",
    "clean_names_full": """SELECT p_partkey AS part_key, p_name AS name, p_brand AS brand_code_,
        p_type AS kind_of_part, p_size AS size_cm_whole, p_retailprice AS price_retail_
        FROM part""",
    "complex_as_string": """SELECT event_id, event_type,
        '{' || json_extract_string(props, '$.k') || '}' AS props,
        '[' || event_type || ', ' || json_extract_string(props, '$.k') || ']' AS labels
        FROM events""",
    "nonnull_keys": """SELECT * FROM (SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus,
        o_totalprice, o_orderdate, o_orderpriority FROM orders)
        WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL""",
    "bounded_strings": _report_sql("documents", ["text", "lang", "source"])
    + " UNION ALL "
    + _report_sql("conversations", ["role", "text"]),
    "checked_strings": """SELECT doc_id, md5(text) AS text_md5,
        CAST(length(text) AS INTEGER) AS n FROM documents""",
}
