"""Single-batch merges that keep one row per key: SCD type 1 and FACT.

Each merge is one full outer join on the business key and one projection. Keys are unique on both
sides, so no key is hot in that join; keys that never match (NULL under plain equality) bypass it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.names import AUDIT, DELETED, HASH, MODIFIED
from tidemark.operators.common import Moment, any_null, cols, moment, unique_source
from tidemark.operators.evolve import conform, merged_schema, widened
from tidemark.plans.lookup import flag_members, null_safe_match

_IN_TARGET = "_tm_in_target"
_IN_SOURCE = "_tm_in_source"
_IN_SCOPE = "_tm_in_scope"
_MAX_TUPLES = 200


def _t(name: str) -> Column:
    return F.col(f"t.{quoted(name)}")


def _s(name: str) -> Column:
    return F.col(f"s.{quoted(name)}")


def _outer(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    t = target.withColumn(_IN_TARGET, F.lit(True)).alias("t")
    s = source.withColumn(_IN_SOURCE, F.lit(True)).alias("s")
    return t.join(s, null_safe_match("s", "t", keys, null_safe), "full_outer")


def _update_test(update_filter: str | Column | None) -> Column:
    changed = _s(HASH) != _t(HASH)
    if update_filter is None:
        return changed
    extra = F.expr(update_filter) if isinstance(update_filter, str) else update_filter
    return changed & extra


def _pick(name: str, target_cols: Sequence[str], source_cols: Sequence[str]) -> tuple:
    """The target's and the source's value of a column, where the frame has it."""
    return (
        _t(name) if name in target_cols else F.lit(None),
        _s(name) if name in source_cols else None,
    )


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_filter: str | Column | None = None,
    null_safe: bool = True,
    on_duplicate: str = "error",
    newest_by: str | None = None,
) -> DataFrame:
    """Latest row per key.

    A matched row with another hash is replaced, one with the same hash keeps its audit columns,
    an unmatched source row is inserted and a row absent from the source stays. ``update_filter``
    is ANDed to the hash test and may name ``s.`` and ``t.`` columns. With ``null_safe=False`` a
    NULL key never matches, so such source rows are always inserted.
    """
    return _merge(target, source, keys, update_filter, null_safe, on_duplicate, newest_by)


def fact_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    resurrect: bool = True,
    update_filter: str | Column | None = None,
    on_duplicate: str = "error",
    newest_by: str | None = None,
) -> DataFrame:
    """SCD1 rules, and a soft-deleted row that returns unchanged becomes live again.

    Resurrection clears the deletion stamp and refreshes the audit columns; a row that returns with
    another hash is replaced as a whole, which clears the stamp as well.
    """
    source = _with_deleted(source)
    return _merge(
        _with_deleted(target), source, keys, update_filter, True, on_duplicate, newest_by, resurrect
    )


def fact_apply(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    now: Moment,
    deletes: str | Sequence[str] = "full",
    resurrect: bool = True,
    update_filter: str | Column | None = None,
    on_duplicate: str = "error",
    newest_by: str | None = None,
) -> DataFrame:
    """``fact_merge`` followed by ``mark_deleted``, in one join."""
    target, source = _with_deleted(target), _with_deleted(source)
    return _merge(
        target,
        source,
        keys,
        update_filter,
        True,
        on_duplicate,
        newest_by,
        resurrect,
        deletes,
        moment(now),
    )


def _with_deleted(df: DataFrame) -> DataFrame:
    if DELETED in df.columns:
        return df
    return df.withColumn(DELETED, F.lit(None).cast("timestamp_ntz"))


def _merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_filter: str | Column | None,
    null_safe: bool,
    on_duplicate: str,
    newest_by: str | None,
    resurrect: bool = False,
    deletes: str | Sequence[str] = "none",
    now: Column | None = None,
) -> DataFrame:
    schema = merged_schema(target.schema, source.schema)
    target, source = widened(target, schema), widened(source, schema)
    never_match = None
    if not null_safe:
        loose = any_null(keys)
        never_match = conform(target.where(loose), schema).unionAll(
            conform(source.where(loose), schema)
        )
        target, source = target.where(~loose), source.where(~loose)
    source = unique_source(source, keys, on_duplicate, newest_by)

    target_cols, source_cols = target.columns, source.columns
    scoped = not isinstance(deletes, str)
    if scoped:
        target = flag_members(target, source, list(deletes), _IN_SCOPE, spread_by=keys)
    joined = _outer(target, source, keys, null_safe)

    is_new = _t(_IN_TARGET).isNull()
    both = _t(_IN_TARGET).isNotNull() & _s(_IN_SOURCE).isNotNull()
    take = is_new | F.coalesce(both & _update_test(update_filter), F.lit(False))
    back = F.lit(False)
    if resurrect:
        back = F.coalesce(
            both & (_s(HASH) == _t(HASH)) & _t(DELETED).isNotNull(), F.lit(False)
        )
    gone = F.lit(False)
    if deletes != "none":
        gone = _s(_IN_SOURCE).isNull() & _t(DELETED).isNull()
        if scoped:
            gone = gone & _t(_IN_SCOPE)

    out = []
    for f in schema:
        old, new = _pick(f.name, target_cols, source_cols)
        if new is None:
            # A column the batch does not carry keeps the value the table has.
            value = old
        else:
            use_new = take | back if (resurrect and f.name in (*AUDIT, DELETED)) else take
            value = F.when(use_new, new).otherwise(old)
        if deletes != "none" and f.name in (DELETED, MODIFIED):
            value = F.when(gone, now).otherwise(value)
        out.append(value.cast(f.dataType).alias(f.name))
    merged = joined.select(*out)
    return merged if never_match is None else merged.unionAll(never_match)


def mark_deleted(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    now: Moment,
    scope_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Stamp live rows whose key the batch does not hold.

    Without ``scope_cols`` the batch is a full extract. With them only rows whose scope values
    occur in the batch (NULL matching NULL) can be deleted. The keys are reduced to distinct ones
    before the shuffle, so the join is one to one.
    """
    out_cols = target.columns
    source = widened(source, merged_schema(target.schema, source.schema))
    if scope_cols:
        target = flag_members(target, source, list(scope_cols), _IN_SCOPE, spread_by=keys)
    present = source.select(*cols(keys)).distinct().withColumn(_IN_SOURCE, F.lit(True))
    joined = target.alias("t").join(present.alias("s"), null_safe_match("s", "t", keys), "left")
    gone = _s(_IN_SOURCE).isNull() & _t(DELETED).isNull()
    if scope_cols:
        gone = gone & _t(_IN_SCOPE)
    stamp = moment(now)
    return joined.select(
        *[
            (F.when(gone, stamp).otherwise(_t(c)) if c in (DELETED, MODIFIED) else _t(c)).alias(c)
            for c in out_cols
        ]
    )


def partition_pruned_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    merge=scd1_merge,
    max_values: int = 10_000,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Merge only the partitions the batch touches; a key must never leave its partition.

    Returns ``(merged, untouched)``: the new content of the touched partitions and the rows of all
    others. A table writer replaces just the touched partitions and never reads the second frame.
    The distinct partition values of the batch become a literal filter, which prunes directories
    or row groups of the target scan; beyond ``max_values`` the split is a semi and an anti join.
    """
    touched, untouched = split_by_partition(target, source, partition_cols, max_values)
    return merge(touched, source, keys, **options), untouched


def split_by_partition(
    target: DataFrame, source: DataFrame, partition_cols: Sequence[str], max_values: int = 10_000
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``target`` in the partitions that occur in ``source``, and all others."""
    values = widened(source, merged_schema(target.schema, source.schema))
    values = values.select(*cols(partition_cols)).distinct()
    # A tuple list becomes one OR term per value, so it stays short.
    most = max_values if len(partition_cols) == 1 else min(max_values, _MAX_TUPLES)
    rows = values.limit(most + 1).collect()
    if len(rows) <= most:
        touched = _is_one_of(partition_cols, rows)
        return target.where(touched), target.where(~touched)
    match = null_safe_match("t", "v", partition_cols)
    t, v = target.alias("t"), values.alias("v")
    return t.join(v, match, "left_semi"), t.join(v, match, "left_anti")


def _is_one_of(names: Sequence[str], rows: Sequence) -> Column:
    """Null-safe membership of the columns in a literal list; never NULL itself."""
    if len(names) == 1:
        column = F.col(quoted(names[0]))
        known = [r[0] for r in rows if r[0] is not None]
        has_null = len(known) < len(rows)
        test = column.isNotNull() & column.isin(known) if known else F.lit(False)
        return (test | column.isNull()) if has_null else F.coalesce(test, F.lit(False))
    # One column at a time keeps the filter prunable; the tuple test makes it exact.
    condition = F.lit(True)
    for i, n in enumerate(names):
        condition = condition & _is_one_of([n], list({(r[i],) for r in rows}))
    exact = F.lit(False)
    for r in rows:
        same = F.lit(True)
        for n, value in zip(names, r, strict=True):
            same = same & F.col(quoted(n)).eqNullSafe(F.lit(value))
        exact = exact | same
    return condition & exact
