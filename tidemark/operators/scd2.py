"""SCD type 2 for one batch: interval tables and append-only histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.names import CURRENT, END, HASH, MODIFIED, OPEN_END, START
from tidemark.operators.common import Moment, cols, fail_on_repeat, moment, packed, unpacked
from tidemark.operators.evolve import conform, evolve_union, merged_schema, widened
from tidemark.plans.lookup import flag_members, null_safe_match

_SIDE = "_tm_side"
_SEEN = "_tm_seen"
_IN_SCOPE = "_tm_in_scope"
_RANK = "_tm_rank"


def scd2_init(source: DataFrame, batch_ts: Moment) -> DataFrame:
    """First load: every row opens an interval at the time of its batch."""
    return source.withColumns(
        {START: moment(batch_ts), END: moment(OPEN_END), CURRENT: F.lit(True)}
    )


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    batch_ts: Moment,
    deletes: str | Sequence[str] = "none",
    touch_modified: bool = False,
    on_duplicate: str = "error",
) -> DataFrame:
    """Close changed versions and open new ones; optionally close keys the extract lost.

    Closed versions do not take part: they pass through without a shuffle. Current versions and the
    batch meet in one window per key, which holds two rows at most. ``deletes`` is ``none``,
    ``full`` (every absent key is closed) or a list of columns (absent keys whose values occur in
    the batch are closed). ``touch_modified`` also stamps closed rows as modified.
    """
    stamp = moment(batch_ts)
    if on_duplicate == "any":
        source = source.dropDuplicates(list(keys))
    elif on_duplicate != "error":
        raise ValueError(f"a type-2 merge takes on_duplicate 'error' or 'any', not {on_duplicate!r}")
    opened = scd2_init(source, batch_ts)
    schema = merged_schema(target.schema, opened.schema)
    closed = conform(target.where(~F.col(CURRENT)), schema)
    current = target.where(F.col(CURRENT))
    extra = []
    if not isinstance(deletes, str):
        wide = widened(source, schema)
        current = flag_members(widened(current, schema), wide, list(deletes), _IN_SCOPE, keys)
        extra = [F.col(_IN_SCOPE)]
    both = _sided(current, schema, 0, extra).unionAll(
        _sided(opened, schema, 1, [F.lit(True)] if extra else [])
    )

    order = Window.partitionBy(*cols(keys)).orderBy(_SIDE)
    seen = both.withColumns(
        {
            "_tm_prev_side": F.lag(_SIDE).over(order),
            "_tm_prev_hash": F.lag(HASH).over(order),
            "_tm_next_side": F.lead(_SIDE).over(order),
            "_tm_next_hash": F.lead(HASH).over(order),
        }
    )
    seen = seen.where(
        fail_on_repeat((F.col("_tm_prev_side") == F.col(_SIDE)) & (F.col(_SIDE) == 1))
    )
    is_old = F.col(_SIDE) == 0
    # A row is kept if it is the stored one or differs from it.
    kept = seen.where(
        is_old | F.col("_tm_prev_side").isNull() | (F.col("_tm_prev_hash") != F.col(HASH))
    )
    changed = F.col("_tm_next_side").isNotNull() & (F.col("_tm_next_hash") != F.col(HASH))
    absent = F.col("_tm_next_side").isNull()
    if isinstance(deletes, str):
        lost = absent if deletes == "full" else F.lit(False)
    else:
        lost = absent & F.col(_IN_SCOPE)
    ends = is_old & F.coalesce(changed | lost, F.lit(False))
    return closed.unionAll(_end_rows(kept, schema, ends, stamp, touch_modified))


def _sided(df: DataFrame, schema, side: int, extra: Sequence[Column]) -> DataFrame:
    flags = [c.alias(_IN_SCOPE) for c in extra]
    return conform(df, schema, *flags).withColumn(_SIDE, F.lit(side))


def _end_rows(
    df: DataFrame, schema, ends: Column, stamp: Column, touch_modified: bool
) -> DataFrame:
    out = []
    for f in schema:
        value = F.col(quoted(f.name))
        if f.name == END or (touch_modified and f.name == MODIFIED):
            value = F.when(ends, stamp).otherwise(value)
        elif f.name == CURRENT:
            value = value & ~ends
        out.append(value.alias(f.name))
    return df.select(*out)


def close_missing(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    batch_ts: Moment,
    scope_cols: Sequence[str] | None = None,
    touch_modified: bool = False,
) -> DataFrame:
    """Close current versions whose key the extract does not hold (within its scope, if given)."""
    schema = target.schema
    source = widened(source, merged_schema(schema, source.schema))
    closed = target.where(~F.col(CURRENT))
    current = target.where(F.col(CURRENT))
    if scope_cols:
        current = flag_members(current, source, list(scope_cols), _IN_SCOPE, keys)
    present = source.select(*cols(keys)).distinct().withColumn(_SEEN, F.lit(True))
    joined = current.alias("t").join(present.alias("s"), null_safe_match("s", "t", keys), "left")
    flagged = joined.select("t.*", F.col(f"s.{_SEEN}"))
    ends = F.col(_SEEN).isNull()
    if scope_cols:
        ends = ends & F.col(_IN_SCOPE)
    return closed.unionAll(_end_rows(flagged, schema, ends, moment(batch_ts), touch_modified))


def scd2_append(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    batch_ts: Moment,
    null_safe: bool = True,
) -> DataFrame:
    """Append-only history: the table followed by the rows ``appended_versions`` finds."""
    fresh = appended_versions(target, source, keys, batch_ts, null_safe)
    return fresh if target is None else evolve_union(target, fresh)


def appended_versions(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    batch_ts: Moment,
    null_safe: bool = True,
) -> DataFrame:
    """Source rows whose (key, hash) is not among the current versions of the history.

    Of the history only keys, hashes and starts are shuffled, older versions being left out in each
    task before, so a key with a very long history is not collected into one task.
    ``null_safe=False`` appends rows with a NULL key on every batch.
    """
    opened = source.withColumn(START, moment(batch_ts))
    if target is None:
        return opened
    typed = widened(opened, merged_schema(target.schema, opened.schema))
    history = widened(target, merged_schema(target.schema, opened.schema))
    current = _current_hashes(history, keys)
    match = null_safe_match("s", "c", [*keys, HASH], null_safe)
    return typed.alias("s").join(current.alias("c"), match, "left_anti")


def _current_hashes(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    return current_versions(history.select(*cols([*keys, HASH, START])), keys).drop(START)


def current_versions(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of an append-only history with the greatest start per key; ties are all kept.

    The history is read once and its rows cross one exchange by key. A first place by rank is known
    in part before it: each task leaves out what is older than its own newest version of the key, so
    the versions of one long-lived key are not gathered in one task.
    """
    newest = Window.partitionBy(*cols(keys)).orderBy(F.col(START).desc())
    ranked = _packed_if_hashed(history.where(F.col(START).isNotNull())).withColumn(_RANK, F.rank().over(newest))
    first = ranked.where(F.col(_RANK) == 1).drop(_RANK)
    return (unpacked(first) if HASH in history.columns else first).select(*cols(history.columns))


def _packed_if_hashed(df: DataFrame) -> DataFrame:
    return packed(df) if HASH in df.columns else df
