"""Apply a whole backlog of batches in one pass.

Every pending batch is read at once and tagged with its number 1..n, taken from the log of pending
files so that an empty extract still counts. The rows the table holds enter as batch 0 (soft
deleted ones as -1), and one shuffle by business key replays all batches: a window per key holds at
most one row per batch. The result equals applying the batches one by one.

``late`` has the row hash and surrogate key of a batch's rows as expressions over their columns, where the
caller knows them: then they are computed behind the shuffle. ``deal_by`` names functions of the key by which rows
are dealt over tasks, for a write that follows them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted
from tidemark.names import (
    ARCHIVED,
    AUDIT,
    BATCH,
    CARRIED,
    CURRENT,
    DELETED,
    END,
    HASH,
    MODIFIED,
    OPEN_END,
    START,
    TECHNICAL,
)
from tidemark.operators.common import any_null, cols, fail_on_repeat, moment, packed, unpacked
from tidemark.operators.evolve import conform, merged_schema
from tidemark.operators.scd2 import current_versions
from tidemark.plans.lookup import lookup_join

_PREV_BATCH = "_tm_prev_batch"
_PREV_HASH = "_tm_prev_hash"
_PREV_GONE = "_tm_prev_gone"
_NEXT_BATCH = "_tm_next_batch"
_SCOPE_BATCHES = "_tm_scope_batches"
_GONE_BATCH = "_tm_gone_batch"
_HASHES = "_tm_hashes"
_HELD = "_tm_held"
_OUTSIDE = "_tm_outside"


class NeedsReplay(ValueError):
    """The requested combination depends on the evolving table: replay batch by batch."""


def _one_per_key(batches: DataFrame, keys: Sequence[str], policy: str) -> DataFrame:
    """Policy ``any`` keeps one row per key and batch; ``error`` is checked along the fold."""
    if policy == "any":
        return batches.dropDuplicates([*keys, BATCH])
    if policy != "error":
        raise ValueError(f"a fold takes on_duplicate 'error' or 'any', not {policy!r}")
    return batches


def _stack(
    target: DataFrame | None,
    batches: DataFrame,
    target_batch: Column,
    late: Mapping[str, Column] | None = None,
    deal_by: Mapping[str, Column] | None = None,
) -> tuple:
    """Table rows and batch rows under one schema, each with its batch number."""
    batches = batches.withColumns({c: F.lit(None).cast("string") for c in late or ()})
    rows = batches.drop(BATCH, CARRIED)
    base = rows.schema if target is None else merged_schema(target.schema, rows.schema)
    schema = T.StructType([f for f in base if f.name != BATCH])
    own, held = [F.col(BATCH).cast("int").alias(BATCH)], [target_batch.cast("int").alias(BATCH)]
    if CARRIED in batches.columns:
        own.append(F.col(CARRIED))
        held.append(F.lit(None).cast("array<string>").alias(CARRIED))
    stacked = conform(batches, schema, *own)
    if target is not None:
        stacked = conform(target, schema, *held).unionAll(stacked)
    return stacked.withColumns(dict(deal_by or {})), schema


def _by_key(keys: Sequence[str]):
    return Window.partitionBy(*cols(keys)).orderBy(BATCH)


def _whole(keys: Sequence[str]):
    return _by_key(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _dealt(
    df: DataFrame, keys: Sequence[str], late: Mapping[str, Column] | None, deal_by: Sequence[str]
) -> DataFrame:
    """The rows of a key in one task, through the one exchange of a fold.

    Hashes are half of a row there. The row hash crosses as bytes; the columns ``late`` of rows of
    batches do not cross at all but are computed behind the exchange.
    """
    dealt = unpacked(packed(df).repartition(*cols(deal_by or keys)))
    own = F.col(BATCH) > 0
    return dealt.withColumns({c: F.when(own, v).otherwise(F.col(c)) for c, v in (late or {}).items()})


def _with_neighbours(
    df: DataFrame, keys: Sequence[str], late: Mapping[str, Column] | None = None, deal_by: Sequence[str] = ()
) -> DataFrame:
    """The row before and after within the key, in one window operator over all rows.

    Everything after it works on the few rows where something happens to a key. A key that occurs
    twice in one batch fails the query. ``deal_by`` names those of ``keys`` that tell tasks apart.
    """
    df = _dealt(df, keys, late, deal_by)
    order = _by_key(keys)
    seen = {
        _PREV_BATCH: F.lag(BATCH).over(order),
        _PREV_HASH: F.lag(HASH).over(order),
        _NEXT_BATCH: F.lead(BATCH).over(order),
    }
    if _GONE_BATCH in df.columns:
        seen[_PREV_GONE] = F.lag(_GONE_BATCH).over(order)
    repeat = (F.col(_PREV_BATCH) == F.col(BATCH)) & (F.col(BATCH) > 0)
    return df.withColumns(seen).where(fail_on_repeat(repeat))


def _changed() -> Column:
    """The first row of a key, and every row that differs from the one before."""
    return F.col(_PREV_BATCH).isNull() | (F.col(_PREV_HASH) != F.col(HASH))


def _removed() -> Column:
    """A batch between the row before and this one deleted the key."""
    return F.coalesce(F.col(_PREV_GONE) < F.col(BATCH), F.lit(False))


def batch_times(batch_log: DataFrame, time_col: str) -> Column:
    """Times of batches 1..n as one array, n being bounded by the files of one fold."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(BATCH), F.col(time_col).alias("ts"))))
    return batch_log.agg(F.transform(entries, lambda e: e["ts"]).alias("times")).scalar()


def _kept_from_table(
    df: DataFrame,
    schema: T.StructType,
    batches: DataFrame,
    keys: Sequence[str],
    changed: Column | None = None,
) -> DataFrame:
    """Columns that a row's batch does not carry keep the value that its key had before.

    No batch carries it: the table's value, in the first row of the key. Only some do (``CARRIED``
    says which columns a row's batch has): the value of the last row before that changed the key
    (``changed``, all rows by default) and whose batch has the column.
    """
    held = F.col(BATCH) <= 0
    kept = {
        f.name: F.first(F.when(held, F.col(quoted(f.name)))).over(_whole(keys))
        for f in schema
        if f.name not in batches.columns
    }
    if CARRIED in df.columns:
        so_far = _by_key(keys).rowsBetween(Window.unboundedPreceding, 0)
        for f in schema:
            if f.name in batches.columns and f.name not in TECHNICAL and f.name not in keys:
                has = held | F.array_contains(CARRIED, f.name)
                has = has if changed is None else has & changed
                value = F.when(has, F.struct(F.col(quoted(f.name)).alias("v")))
                kept[f.name] = F.last(value, ignorenulls=True).over(so_far)["v"]
    return df.withColumns(kept)


def scd1_fold(
    target: DataFrame | None,
    batches: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    on_duplicate: str = "error",
    late: Mapping[str, Column] | None = None,
    deal_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Type-1 result of all batches: the first row of the last run of equal hashes per key."""
    if not null_safe:
        loose = any_null(keys)
        strict = scd1_fold(
            None if target is None else target.where(~loose),
            batches.where(~loose),
            keys,
            True,
            on_duplicate,
        )
        inserted = conform(batches.where(loose).drop(BATCH, CARRIED), strict.schema)
        if target is not None:
            inserted = inserted.unionAll(conform(target.where(loose), strict.schema))
        return strict.unionAll(inserted)

    batches = _one_per_key(batches, keys, on_duplicate)
    stacked, schema = _stack(target, batches, F.lit(0), late, deal_by)
    keys = [*(deal_by or ()), *keys]
    seen = _with_neighbours(stacked, keys, late, tuple(deal_by or ())).where(_changed())
    seen = _kept_from_table(seen, schema, batches, keys)
    later = F.lead(BATCH).over(_by_key(keys))
    kept = seen.withColumn("_tm_later", later).where(F.col("_tm_later").isNull())
    return kept.select(*cols(schema.names))


def scd1_filtered_fold(
    target: DataFrame | None,
    batches: DataFrame,
    keys: Sequence[str],
    update_filter: str,
    on_duplicate: str = "error",
    late: Mapping[str, Column] | None = None,
    deal_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Type-1 result of all batches where a stored row is replaced only if ``update_filter`` holds.

    The filter names columns of the stored row ``t`` and the new row ``s``, so what a batch does depends
    on what the batches before it left. The rows of a key, sorted by batch, are folded into one: the
    carried row is ``t``, the next one ``s``. A key has one row for each batch at most, so its array is
    bounded by the files of a fold; a repeated key fails before anything is collected.
    """
    if CARRIED in batches.columns:
        raise NeedsReplay("with columns that only some files carry, a filter depends on the stored row")
    batches = _one_per_key(batches, keys, on_duplicate)
    stacked, schema = _stack(target, batches, F.lit(0), late, deal_by)
    keys = [*(deal_by or ()), *keys]
    seen = _with_neighbours(stacked, keys, late, tuple(deal_by or ()))
    rows = F.collect_list(F.struct(F.col(BATCH), *cols(schema.names)))
    grouped = seen.groupBy(*cols(keys)).agg(rows.alias("_tm_rows"))
    by_batch = F.array_sort("_tm_rows", lambda a, b: a[BATCH] - b[BATCH])
    sorted_rows = grouped.select(by_batch.alias("_tm_rows"))
    # Columns that no batch carries keep the stored value.
    carried = {BATCH, *batches.columns}
    taken = ", ".join(
        f"'{f}', {'s' if f in carried else 't'}.{quoted(f)}" for f in (BATCH, *schema.names)
    )
    state = F.expr(
        f"""aggregate(slice(_tm_rows, 2, size(_tm_rows)), _tm_rows[0], (t, s) -> CASE
            WHEN s.{quoted(HASH)} <> t.{quoted(HASH)} AND ({update_filter})
            THEN named_struct({taken}) ELSE t END)"""
    )
    folded = sorted_rows.select(state.alias("_tm_row"))
    return folded.select(*[F.col("_tm_row").getField(n).alias(n) for n in schema.names])


def _with_removal(
    df: DataFrame,
    batches: DataFrame,
    batch_log: DataFrame,
    keys: Sequence[str],
    deletes: str | Sequence[str],
) -> DataFrame:
    """Number of the first batch after a row that would delete its key if it does not hold it."""
    if isinstance(deletes, str):
        number = F.when(F.col(BATCH) >= 0, F.col(BATCH) + 1) if deletes == "full" else F.lit(None)
        return df.withColumn(_GONE_BATCH, number.cast("int"))
    scope = list(deletes)
    unstable = [c for c in scope if c in TECHNICAL]
    if unstable:
        raise NeedsReplay(f"scope columns {unstable} are not part of the row hash")
    # One row per scope value with the sorted numbers of the batches that hold it: partially
    # aggregated, n numbers at most.
    reached = (
        batches.select(*cols(scope), F.col(BATCH).cast("int").alias(BATCH))
        .groupBy(*cols(scope))
        .agg(F.sort_array(F.collect_set(BATCH)).alias(_SCOPE_BATCHES))
    )
    reached = conform(reached, df.select(*cols(scope)).schema, F.col(_SCOPE_BATCHES))
    joined = lookup_join(df, reached, scope, "left", spread_by=keys)
    later = F.get(F.filter(F.col(_SCOPE_BATCHES), lambda b: b > F.col(BATCH)), F.lit(0))
    number = F.when(F.col(BATCH) >= 0, later)
    return joined.withColumn(_GONE_BATCH, number.cast("int")).drop(_SCOPE_BATCHES)


def scd2_fold(
    target: DataFrame | None,
    batches: DataFrame,
    keys: Sequence[str],
    batch_log: DataFrame,
    deletes: str | Sequence[str] = "full",
    touch_modified: bool = False,
    on_duplicate: str = "error",
    late: Mapping[str, Column] | None = None,
    deal_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Type-2 interval table after all batches.

    ``batches`` carry the archive time of their batch; ``batch_log`` lists every batch with it. A
    version starts where the key appears, returns or changes its hash, and ends where the next
    version starts or where a batch deletes the key, whichever comes first.
    """
    batches = _one_per_key(batches, keys, on_duplicate)
    rows = batches.withColumns(
        {START: F.col(ARCHIVED), END: moment(OPEN_END), CURRENT: F.lit(True)}
    )
    current = None if target is None else target.where(F.col(CURRENT))
    stacked, schema = _stack(current, rows, F.lit(0), late, deal_by)
    stacked = _with_removal(stacked, batches, batch_log, keys, deletes)
    keys = [*(deal_by or ()), *keys]
    seen = _with_neighbours(stacked, keys, late, tuple(deal_by or ()))
    starts = _changed() | _removed()
    is_last = F.col(_NEXT_BATCH).isNull()
    # What a row says about the version before it: a start ends it, or the deletion before the
    # start did; the last row of a key says when the key is deleted, if ever.
    before = F.when(_removed(), F.col(_PREV_GONE)).otherwise(F.col(BATCH))
    seen = seen.withColumns(
        {"_tm_starts": starts, "_tm_before": F.when(starts, before).otherwise(F.col(_GONE_BATCH))}
    ).where(F.col("_tm_starts") | is_last)
    order = _by_key(keys)
    opened = seen.withColumns(
        {"_tm_next": F.lead(BATCH).over(order), "_tm_next_before": F.lead("_tm_before").over(order)}
    ).where("_tm_starts")
    end_batch = F.when(F.col("_tm_next").isNull(), F.col(_GONE_BATCH)).otherwise(
        F.col("_tm_next_before")
    )
    ended = opened.withColumn(
        "_tm_end", F.get(batch_times(batch_log, ARCHIVED), end_batch - F.lit(1))
    )
    out = []
    for f in schema:
        value = F.col(quoted(f.name))
        if f.name == END or (touch_modified and f.name == MODIFIED):
            value = F.coalesce(F.col("_tm_end"), value)
        elif f.name == CURRENT:
            value = value & F.col("_tm_end").isNull()
        out.append(value.alias(f.name))
    versions = ended.select(*out)
    if target is None:
        return versions
    return versions.unionAll(conform(target.where(~F.col(CURRENT)), versions.schema))


def fact_fold(
    target: DataFrame | None,
    batches: DataFrame,
    keys: Sequence[str],
    batch_log: DataFrame,
    deletes: str | Sequence[str] = "full",
    resurrect: bool = True,
    on_duplicate: str = "error",
    late: Mapping[str, Column] | None = None,
    deal_by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """FACT table after all batches: last version per key, stamped if a later batch dropped it.

    ``batch_log`` gives the modification time of every batch, which is the deletion stamp.
    """
    if not resurrect and deletes != "none":
        raise NeedsReplay("without resurrection an equal row depends on the stored stamp")
    batches = _one_per_key(batches, keys, on_duplicate)
    none = F.lit(None).cast("timestamp_ntz")
    rows = batches if DELETED in batches.columns else batches.withColumn(DELETED, none)
    if target is not None and DELETED not in target.columns:
        target = target.withColumn(DELETED, none)
    entry = F.when(F.col(DELETED).isNull(), F.lit(0)).otherwise(F.lit(-1))
    stacked, schema = _stack(target, rows, entry, late, deal_by)
    stacked = _with_removal(stacked, batches, batch_log, keys, deletes)
    keys = [*(deal_by or ()), *keys]
    seen = _with_neighbours(stacked, keys, late, tuple(deal_by or ()))
    # A key returns after a deletion in the backlog, or from a row already stamped in the table.
    returns = _removed()
    if resurrect:
        returns = returns | F.coalesce(F.col(_PREV_BATCH) == -1, F.lit(False))
    is_last = F.col(_NEXT_BATCH).isNull()
    seen = seen.withColumns(
        {"_tm_changed": _changed(), "_tm_event": _changed() | returns}
    ).where(F.col("_tm_event") | is_last)
    # A row that only returns keeps the stored content and takes the new audit columns.
    refreshed = [c for c in (*AUDIT, DELETED) if c in schema.names]
    taken = F.last(F.when(F.col("_tm_event"), F.struct(*cols(refreshed))), ignorenulls=True)
    whole = _whole(keys)
    seen = seen.withColumns(
        {
            "_tm_taken": taken.over(whole),
            "_tm_content": F.max(F.when(F.col("_tm_changed"), F.col(BATCH))).over(whole),
            "_tm_gone": F.last(_GONE_BATCH).over(whole),
        }
    )
    seen = _kept_from_table(seen, schema, rows, keys, F.col("_tm_changed"))
    kept = seen.where(F.col("_tm_changed") & (F.col(BATCH) == F.col("_tm_content")))
    kept = kept.withColumns({c: F.col("_tm_taken")[c] for c in refreshed})
    stamp = F.get(batch_times(batch_log, MODIFIED), F.col("_tm_gone") - F.lit(1))
    kept = kept.withColumn("_tm_stamp", stamp)
    out = []
    for f in schema:
        value = F.col(quoted(f.name))
        if f.name in (DELETED, MODIFIED):
            value = F.coalesce(F.col("_tm_stamp"), value)
        out.append(value.alias(f.name))
    return kept.select(*out)


def append_fold(
    target: DataFrame | None,
    batches: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    on_duplicate: str = "error",
    late: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Versions to append to an append-only history after all batches.

    A row is appended where its hash is none of the newest versions' of its key so far. The table may
    hold several of one start; they enter as one row with the set of their hashes. It counts until a
    row outside of it is appended, and from then on the row before does.
    """
    if not null_safe:
        loose = any_null(keys)
        strict = append_fold(target, batches.where(~loose), keys, True, on_duplicate)
        free = batches.where(loose).withColumn(START, F.col(ARCHIVED)).drop(BATCH)
        return strict.unionAll(conform(free, strict.schema))
    rows = _one_per_key(batches, keys, on_duplicate).withColumn(START, F.col(ARCHIVED))
    newest = None
    if target is not None:
        hashes = F.collect_set(HASH).alias(_HASHES)
        newest = current_versions(target, keys).groupBy(*cols(keys)).agg(hashes)
    stacked, schema = _stack(newest, rows, F.lit(0), late)
    if newest is None:
        seen = _with_neighbours(stacked, keys, late).where((F.col(BATCH) > 0) & _changed())
        return seen.select(*cols(schema.names))
    order = _by_key(keys)
    held = F.first(_HASHES).over(order.rowsBetween(Window.unboundedPreceding, 0))
    outside = F.col(_HELD).isNull() | ~F.array_contains(_HELD, F.col(HASH))
    seen = _with_neighbours(stacked, keys, late).withColumn(_HELD, held)
    seen = seen.withColumn(_OUTSIDE, (F.col(BATCH) > 0) & outside)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.coalesce(F.max(_OUTSIDE).over(before), F.lit(False))
    differs = F.when(left, F.col(_PREV_HASH) != F.col(HASH)).otherwise(F.col(_OUTSIDE))
    fresh = seen.withColumn("_tm_fresh", differs).where((F.col(BATCH) > 0) & F.col("_tm_fresh"))
    return conform(fresh.drop(_HASHES), merged_schema(target.schema, rows.drop(BATCH, CARRIED).schema))
