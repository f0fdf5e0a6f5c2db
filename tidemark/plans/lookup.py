"""Joins of a large side with a pre-aggregated lookup, safe under skew.

The lookup is written once to the shared folder and broadcast only after its rows and bytes were
counted there. Beyond the bound both sides are shuffled, and the large side is spread over a number of salts, so one lookup value that holds a
large share of the rows is still shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.session import written

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 64

_SALT = "_tm_salt"
_FOUND = "_tm_found"
_HOT = "_tm_hot"


def null_safe_match(left: str, right: str, cols: Sequence[str], null_safe: bool = True) -> Column:
    """Conjunction of key equalities between two aliased frames."""
    condition = None
    for c in cols:
        a, b = F.col(f"{left}.{quoted(c)}"), F.col(f"{right}.{quoted(c)}")
        part = a.eqNullSafe(b) if null_safe else a == b
        condition = part if condition is None else condition & part
    return condition


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Count rows and text bytes of ``df`` in one job and compare them with the bounds."""
    width = F.lit(0)
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(quoted(c)).cast("string")), F.lit(0)) + 8
    n_rows, n_bytes = df.agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
    return n_rows <= max_rows and (n_bytes or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] = (),
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` with ``lookup`` (unique on ``on``), NULL matching NULL.

    ``how`` is ``left`` or ``left_semi``; ``left`` adds the lookup's other columns. ``spread_by``
    names columns of ``big`` with many values, used to salt a shuffled join; without them the join
    keys are taken to be spread already.
    """
    values = [c for c in lookup.columns if c not in on]
    lookup = written(lookup, "lookup")
    b = big
    small = lookup
    extra: list[str] = []
    if fits_broadcast(lookup, max_rows):
        small = F.broadcast(lookup)
    elif spread_by:
        b, small = _salted(big, lookup, on, spread_by, salts)
        extra = [_SALT]
    condition = null_safe_match("tm_big", "tm_small", on)
    for c in extra:
        condition = condition & (F.col(f"tm_big.{c}") == F.col(f"tm_small.{c}"))
    joined = b.alias("tm_big").join(small.alias("tm_small"), condition, how)
    kept = [F.col(f"tm_big.{quoted(c)}") for c in big.columns]
    if how == "left":
        kept += [F.col(f"tm_small.{quoted(c)}") for c in values]
    return joined.select(*kept)


def _salted(
    big: DataFrame, lookup: DataFrame, on: Sequence[str], spread_by: Sequence[str], salts: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: 0, but for hot values 0..salts-1.

    A value is hot if it holds more than a quarter of an even share of the rows per salt, so there
    are at most ``4 * salts`` hot values, whatever the data.
    """
    names = [F.col(quoted(c)) for c in on]
    counts = written(big.groupBy(*names).agg(F.count(F.lit(1)).alias("_tm_n")), "lookup-counts")
    n_rows = counts.agg(F.sum("_tm_n")).first()[0] or 0
    hot = counts.where(F.col("_tm_n") > n_rows / (4 * salts)).select(*names)
    hot = F.broadcast(hot.withColumn(_HOT, F.lit(True)))

    def flagged(df: DataFrame) -> DataFrame:
        joined = df.alias("d").join(hot.alias("h"), null_safe_match("d", "h", on), "left")
        return joined.select("d.*", F.col(f"h.{_HOT}"))

    spread = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in spread_by]), F.lit(salts)).cast("int")
    salt = F.when(F.col(_HOT), spread).otherwise(F.lit(0))
    repeats = F.sequence(F.lit(0), F.when(F.col(_HOT), F.lit(salts - 1)).otherwise(F.lit(0)))
    return (
        flagged(big).withColumn(_SALT, salt).drop(_HOT),
        flagged(lookup).withColumn(_SALT, F.explode(repeats)).drop(_HOT),
    )


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a frame: the file sizes for a plain scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def split_by_reach(
    target: DataFrame,
    batches: DataFrame,
    keys: Sequence[str],
    scope: Sequence[str] = (),
    max_rows: int = MAX_BROADCAST_ROWS,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of a table the batches can change, and the rest.

    A row is within reach if its key, or its scope value where there is a scope, occurs in the
    batches. If the distinct keys and values are few enough to broadcast, the rest of the table is
    found without a shuffle and need not take part in one. If not, everything is within reach.
    """
    flagged = target
    flags = []
    for i, names in enumerate([list(keys), *([list(scope)] if scope else [])]):
        found = f"{_FOUND}_{i}"
        members = batches.select(*[F.col(quoted(c)) for c in names]).distinct()
        members = written(members, "reach")
        if not fits_broadcast(members, max_rows):
            return target, None
        members = F.broadcast(members.withColumn(found, F.lit(True)))
        match = null_safe_match("t", "m", names)
        flagged = flagged.alias("t").join(members.alias("m"), match, "left").select(
            "t.*", F.col(f"m.{found}")
        )
        flags.append(F.col(found).isNotNull())
    reached = flags[0] if len(flags) == 1 else flags[0] | flags[1]
    columns = [F.col(quoted(c)) for c in target.columns]
    return flagged.where(reached).select(*columns), flagged.where(~reached).select(*columns)


def flag_members(
    big: DataFrame,
    members: DataFrame,
    on: Sequence[str],
    flag: str,
    spread_by: Sequence[str] = (),
    **bounds: int,
) -> DataFrame:
    """Add ``flag``: does the row's ``on`` value occur in ``members``?"""
    lookup = members.select(*[F.col(quoted(c)) for c in on]).distinct()
    lookup = lookup.withColumn(_FOUND, F.lit(True))
    joined = lookup_join(big, lookup, on, "left", spread_by, **bounds)
    return joined.withColumn(flag, F.coalesce(F.col(_FOUND), F.lit(False))).drop(_FOUND)
