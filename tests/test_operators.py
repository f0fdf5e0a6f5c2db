"""Edge cases of merges, schema evolution, lookups, columns and retention."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import day
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions import text as X
from tidemark.functions.hashing import with_primary_key, with_row_hash
from tidemark.names import DELETED, MODIFIED
from tidemark.operators import config, evolve, export, logs, merge, retention, upkeep
from tidemark.operators.common import with_audit
from tidemark.plans import lookup
from tidemark.session import MAX_SHUFFLE_PARTITIONS, SHUFFLE_PARTITION_BYTES, shuffles_for
from tidemark.spec import PurgePolicy, TableSpec


def tagged(df, i):
    return with_audit(with_row_hash(df), day(i), day(i), f"f{i}", f"n{i}")


# --- merges -------------------------------------------------------------------------------------


def test_new_and_missing_columns(spark):
    target = tagged(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, old int"), 0)
    source = tagged(spark.createDataFrame([(1, "c", 1.5), (3, "d", 2.5)], "k long, v string, new double"), 1)
    out = {r["k"]: r for r in merge.scd1_merge(target, source, ["k"]).collect()}
    assert out[1]["v"] == "c" and out[1]["new"] == 1.5
    assert out[1]["old"] == 5  # the batch does not carry it, so it stays
    assert out[2]["old"] == 6 and out[2]["new"] is None
    assert out[3]["old"] is None
    schema = merge.scd1_merge(target, source, ["k"]).schema
    assert schema["k"].dataType == T.LongType()


def test_null_keys_under_plain_equality(spark):
    target = tagged(spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string"), 0)
    source = tagged(spark.createDataFrame([(None, "a"), (None, "a"), (1, "b")], "k int, v string"), 1)
    out = merge.scd1_merge(target, source, ["k"], null_safe=False)
    assert out.where("k IS NULL").count() == 3
    assert out.where("k = 1").count() == 1


def test_null_keys_match_by_default(spark):
    target = tagged(spark.createDataFrame([(None, "a")], "k int, v string"), 0)
    source = tagged(spark.createDataFrame([(None, "b")], "k int, v string"), 1)
    assert [r["v"] for r in merge.scd1_merge(target, source, ["k"]).collect()] == ["b"]


def test_pruned_merge_equals_full_merge(spark):
    rows = [(k, "p" + str(k // 4), None if k == 7 else "q") for k in range(12)]
    target = tagged(spark.createDataFrame(rows, "k int, p string, q string"), 0)
    touched = [(k, "p1", "r") for k in (4, 5, 7)] + [(20, "p2", None)]
    source = tagged(spark.createDataFrame(touched, "k int, p string, q string"), 1)
    full = merge.scd1_merge(target, source, ["k"]).orderBy("k").collect()
    for options in ({}, {"max_values": 1}):
        merged, untouched = merge.partition_pruned_merge(target, source, ["k"], ["p"], **options)
        assert merged.unionByName(untouched).orderBy("k").collect() == full
    fixed = spark.createDataFrame([(7, "p1", None), (20, "p2", None)], "k int, p string, q string")
    merged, untouched = merge.partition_pruned_merge(target, tagged(fixed, 1), ["k"], ["p", "q"])
    assert (merged.count(), untouched.count()) == (2, 11)


def test_scoped_delete_is_null_safe(spark):
    rows = [(1, "a"), (2, None), (3, "b")]
    target = tagged(spark.createDataFrame(rows, "k int, g string"), 0)
    target = target.withColumn(DELETED, F.lit(None).cast("timestamp_ntz"))
    source = tagged(spark.createDataFrame([(9, None)], "k int, g string"), 1)
    out = merge.mark_deleted(target, source, ["k"], day(1), ["g"])
    assert [r["k"] for r in out.where(F.col(DELETED).isNotNull()).collect()] == [2]
    assert out.where("k = 2").first()[MODIFIED] == day(1)


# --- skew ---------------------------------------------------------------------------------------


def test_salted_lookup_equals_broadcast_on_a_hot_value(spark):
    """Two thirds of the rows share one lookup value; one value is NULL."""
    value = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string"))
    )
    big = spark.range(3000).select(F.col("id").alias("k"), value.alias("g"))
    small = spark.createDataFrame([("hot", 1), ("2", 2), (None, 3)], "g string, n int")
    plain = lookup.lookup_join(big, small, ["g"], "left").orderBy("k").collect()
    salted = lookup.lookup_join(big, small, ["g"], "left", spread_by=["k"], max_rows=1, salts=8)
    assert salted.orderBy("k").collect() == plain
    left, right = lookup._salted(big, small, ["g"], ["k"], 8)
    parts = {r["g"]: r["n"] for r in left.groupBy("g").agg(F.countDistinct("_tm_salt").alias("n")).collect()}
    assert parts.pop("hot") == 8 and set(parts.values()) <= {1, 8}
    assert right.where("g = 'hot'").count() == 8 and right.where("g = '2'").count() == 1
    semi = lookup.lookup_join(big, small.select("g"), ["g"], "left_semi", ["k"], 1, 8)
    assert semi.count() == sum(r["n"] is not None for r in plain)


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with shuffles_for(spark, 1000) as n:
        assert n == int(before)
    with shuffles_for(spark, 10 * SHUFFLE_PARTITION_BYTES) as n:
        assert n == 30 and spark.conf.get(key) == "30"
    with shuffles_for(spark, 10**18) as n:
        assert n == MAX_SHUFFLE_PARTITIONS
    assert spark.conf.get(key) == before


# --- schema -------------------------------------------------------------------------------------


def test_wider_types():
    wide = evolve.wider_type
    assert wide(T.IntegerType(), T.LongType()) == T.LongType()
    assert wide(T.IntegerType(), T.FloatType()) == T.DoubleType()
    assert wide(T.DecimalType(10, 2), T.IntegerType()) == T.DecimalType(12, 2)
    assert wide(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    for pair in ((T.StringType(), T.IntegerType()), (T.LongType(), T.DoubleType())):
        with pytest.raises(TypeError):
            wide(*pair)


# --- columns ------------------------------------------------------------------------------------


def test_column_text():
    assert C.parse_column_list(" [a b], `c` ,d") == ["a b", "c", "d"]
    assert C.parse_column_list("") == [] == C.parse_column_list(None)
    assert C.bracket_text("[a b]", as_backticks=True) == "`a b`"
    assert C.clean_name_full("value.a b,c;d{e}f(g)h\ni\tj=k.l[m]") == "a_b_c_d_e_f_g_h_i_j_k_lm"


def test_name_clash_is_an_error(spark):
    with pytest.raises(ValueError, match="clash"):
        C.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_select_keeps_a_column(spark):
    df = spark.createDataFrame([(1, 2, "p")], "`a b` int, c int, path string")
    assert C.select_columns(df, "[a b] AS x", "quote", "path").first() == Row(x=1, path="p")
    assert C.select_columns(df, "*, c + 1 AS d", keep="path").columns == ["a b", "c", "d", "path"]
    assert C.select_columns(df, ["c", F.col("c").alias("e")], keep="path").columns == ["c", "e", "path"]
    assert C.select_columns(df, "named_struct('x{y}', c) AS s").first()["s"]["x{y}"] == 2


def test_hashes(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "a", None)], "k int, x string, y string")
    assert with_row_hash(df).select("__HashDiff").distinct().count() == 1
    assert with_row_hash(df, null_token="~").select("__HashDiff").distinct().count() == 2
    nested = df.select("k", F.struct("x", "y").alias("s"), F.array("x").alias("a"))
    with pytest.raises(ValueError, match="json"):
        with_row_hash(nested)
    assert with_row_hash(nested, mode="json").select("__HashDiff").distinct().count() == 2
    assert C.complex_as_string(nested).dtypes[1:3] == [("s", "string"), ("a", "string")]
    assert with_primary_key(df, ["k"]).select("__PrimaryKey").distinct().count() == 1


def test_human_bytes(spark):
    sizes = [None, 0, 1, 1023, 1024, 1536, 1024**2 - 1, 1024**3, 5 * 1024**4, 2**62]
    df = spark.createDataFrame([(s,) for s in sizes], "n long")
    texts = [r[0] for r in df.select(X.human_bytes(F.col("n"))).collect()]
    assert texts == ["0B", "0B", "1.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "1024.0 KB", "1.0 GB", "5.0 TB", "4.0 EB"]


def test_bound_strings(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",), (None,)], "s string")
    assert [r[0] for r in X.bound_strings(df, 6).collect()] == ["abc", "abcdef", None]
    with pytest.raises(Exception, match="longer than 4"):
        X.bound_strings(df, 4).collect()
    report = X.string_length_report(df, 4).first()
    assert (report["n_rows"], report["max_length"], report["n_too_long"]) == (3, 6, 1)


# --- logs, export, config, upkeep -----------------------------------------------------------------


def test_pending_without_modification_time_and_with_corrupted_flag(spark):
    rows = [("b", day(1), False, True), ("a", day(1), False, False), ("c", day(2), True, False)]
    log = spark.createDataFrame(
        rows,
        "ArchiveFilePath string, ArchiveDatetimeUTC timestamp_ntz, IsPurged boolean, IsCorrupted boolean",
    )
    assert [r[0] for r in logs.pending_files(log, day(0)).collect()] == ["a"]
    assert logs.pending_files(log, day(1)).count() == 0
    assert logs.pending_files(log, day(1), include_previous=True).count() == 1


def test_watermark_starts_days_back(spark):
    assert logs.read_watermark(None, datetime(2024, 3, 15, 12), 5) == datetime(2024, 3, 10)


def test_export_window(spark):
    df = spark.createDataFrame([(1, day(1)), (2, day(5))], f"k int, {MODIFIED} timestamp_ntz")
    assert export.changed_rows(df, day(1)).count() == 1
    assert export.changed_rows(df, day(1), include_previous=True, select="k").columns == ["k"]
    assert export.new_watermark(df, day(0), day(3)).first()[0] == day(1)
    assert export.new_watermark(df, day(6), day(9)).first() is None
    assert export.export_start(None) == export.FIRST_EXPORT


def test_spec_from_configuration(spark):
    row = {n: "" for n in config.SILVER_COLUMNS}
    row.update(Type="fact", BronzeSchema="b", BronzeTable="t", SilverSchema="s", SilverTable="u")
    row.update(BusinessKeyColumns="[a b], c", DeleteFilterColumns="y")
    spec = config.spec_from_row(Row(**row), "/tables", "/archive", "/log")
    assert spec.keys == ["a_b", "c"] and spec.deletes == ["y"] and spec.select == "*"
    assert spec.target == "/tables/s/u" and spec.source_id == ("b", "t")
    with pytest.raises(ValueError):
        TableSpec("t", "p", "a", ["k"], kind="scd1", deletes="full")


def test_maintenance_due(spark):
    df = spark.createDataFrame(
        [("a", day(0), "WRITE"), ("b", day(0), "VACUUM END"), ("c", day(13), "VACUUM START")],
        "t string, timestamp timestamp_ntz, operation string",
    )
    due = {r["t"]: (r[1], r[2]) for r in upkeep.maintenance_due(df, day(14), ["t"]).collect()}
    assert due == {"a": (-1, True), "b": (14, True), "c": (1, False)}


# --- retention ------------------------------------------------------------------------------------


def retention_log(spark, n: int, seed: int):
    """One table and one moment hold much of the log; some moments fall in the same second."""
    rng = random.Random(seed)
    hot = datetime(2024, 12, 30, 8, 0, 0)
    rows = []
    for i in range(n):
        pick = rng.random()
        if pick < 0.35:
            at = hot
        elif pick < 0.5:
            at = hot + timedelta(microseconds=rng.randrange(5) * 100_000)
        else:
            at = datetime(2023, 12, 20) + timedelta(hours=rng.randrange(24 * 400))
        table = "archive_hot" if rng.random() < 0.7 else f"archive_{rng.randrange(3)}"
        rows.append((table, at, at.year, at.month, at.day, i + 1, f"/a/{i}", rng.random() < 0.2))
    return spark.createDataFrame(
        rows,
        "ArchiveTable string, ArchiveDatetimeUTC timestamp_ntz, ArchiveYearUTC int, "
        "ArchiveMonthUTC int, ArchiveDayUTC int, OriginalStagingFileSize long, "
        "ArchiveFilePath string, IsPurged boolean",
    )


def brute_ranks(rows):
    from hashlib import md5

    def order(r):
        return (r["ArchiveDatetimeUTC"], md5(r["ArchiveFilePath"].encode()).hexdigest()[:2], r["ArchiveFilePath"])

    periods = (
        lambda d: (d.year,),
        lambda d: (d.year, d.month),
        lambda d: (d.year, "w", d.isocalendar()[1]),
        lambda d: (d.year, d.month, d.day),
    )
    counts: dict = {}
    out = {}
    for r in sorted(rows, key=order, reverse=True):
        ranks = []
        for i, p in enumerate(periods):
            bucket = (r["ArchiveTable"], i, p(r["ArchiveDatetimeUTC"]))
            counts[bucket] = counts.get(bucket, 0) + 1
            ranks.append(counts[bucket])
        out[r["ArchiveFilePath"]] = tuple(ranks)
    return out


def test_ranks_and_classes_on_a_hot_moment(spark):
    log = retention_log(spark, 600, 1)
    now = datetime(2025, 3, 1)
    want = brute_ranks(log.collect())
    ranked = retention.retention_ranks(log, now, PurgePolicy(), ["ArchiveTable"])
    names = [n for n, _ in retention.RANKS]
    assert {r["ArchiveFilePath"]: tuple(r[n] for n in names) for r in ranked.collect()} == want
    for policy in (
        PurgePolicy(),
        PurgePolicy(keep_day=False, keep_month=False),
        PurgePolicy(keep_year=False, keep_month=False, keep_week=False, keep_day=False),
    ):
        flags = (policy.keep_year, policy.keep_month, policy.keep_week, policy.keep_day)
        doomed = {
            p for p, ranks in want.items()
            if not any(f and r == 1 for f, r in zip(flags, ranks, strict=True))
        }
        classified = retention.retention_classify(log, now, policy, ["ArchiveTable"])
        got = classified.where("IsToBePurged").select("ArchiveFilePath").collect()
        assert {r[0] for r in got} == doomed


def test_young_files_are_not_judged(spark):
    log = retention_log(spark, 50, 2)
    cut = datetime(2024, 12, 1)
    judged = retention.retention_classify(log, cut, PurgePolicy(age_days=31), ["ArchiveTable"])
    newest = judged.agg(F.max("ArchiveDatetimeUTC")).first()[0]
    assert newest <= cut - timedelta(days=31)
