"""Pieces shared by the change operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.names import ARCHIVED, FILE_PATH, HASH, MODIFIED, STAGING_NAME

Moment = datetime | date | str | Column

_PACKED_HASH = "_tm_packed_hash"
_DUPLICATE_TEXT = "the batch holds more than one row for a business key"


def moment(value: Moment) -> Column:
    """A zone-less UTC timestamp column from a datetime, ISO text or column."""
    if isinstance(value, Column):
        return value
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def cols(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def packed(df: DataFrame) -> DataFrame:
    """The row hash as bytes, half as long in a shuffle; text that is no lower-case hex stays text."""
    found = F.unhex(HASH)
    is_hex = F.coalesce(F.lower(F.hex(found)) == F.col(HASH), F.lit(False))
    return df.withColumns(
        {_PACKED_HASH: F.when(is_hex, found), HASH: F.when(~is_hex, F.col(HASH))}
    )


def unpacked(df: DataFrame) -> DataFrame:
    """The row hash as it was before ``packed``."""
    text = F.lower(F.hex(_PACKED_HASH))
    return df.withColumn(HASH, F.coalesce(HASH, text)).drop(_PACKED_HASH)


def any_null(names: Sequence[str]) -> Column:
    condition = F.lit(False)
    for n in names:
        condition = condition | F.col(quoted(n)).isNull()
    return condition


def with_audit(
    df: DataFrame,
    modified: Moment,
    archived: Moment,
    file_path: str | Column | None = None,
    staging_name: str | Column | None = None,
) -> DataFrame:
    """Tag the rows of a batch with the time of the run and the lineage of the file."""
    audit = {MODIFIED: moment(modified), ARCHIVED: moment(archived)}
    for name, value in ((FILE_PATH, file_path), (STAGING_NAME, staging_name)):
        if value is not None:
            audit[name] = value if isinstance(value, Column) else F.lit(value)
    return df.withColumns(audit)


def unique_source(
    source: DataFrame, keys: Sequence[str], policy: str = "error", newest_by: str | None = None
) -> DataFrame:
    """Make sure a batch holds one row per key.

    ``error`` fails the query: a scalar subquery counts repeated keys (only the key columns are
    read, and partially aggregated before the shuffle). ``any`` keeps one row per key, ``latest``
    the one with the greatest ``newest_by``. ``allow`` skips the check.
    """
    if policy == "allow":
        return source
    if policy == "error":
        repeated = source.groupBy(*cols(keys)).count().where(F.col("count") > 1)
        n_repeated = repeated.agg(F.count(F.lit(1)).alias("n")).scalar()
        guard = F.when(
            n_repeated > 0, F.raise_error(F.lit(_DUPLICATE_TEXT)).cast("boolean")
        ).otherwise(F.lit(True))
        return source.where(guard)
    if policy == "any":
        return source.dropDuplicates(list(keys))
    if policy == "latest":
        if not newest_by:
            raise ValueError("policy 'latest' needs newest_by")
        rest = [c for c in source.columns if c not in keys]
        newest = F.max_by(F.struct(*cols(rest)), F.col(quoted(newest_by))).alias("_tm_row")
        picked = source.groupBy(*cols(keys)).agg(newest)
        return picked.select(
            *[F.col(quoted(c)) if c in keys else F.col("_tm_row")[c].alias(c) for c in source.columns]
        )
    raise ValueError(f"unknown duplicate policy {policy!r}")


def fail_on_repeat(is_repeat: Column) -> Column:
    """A filter that lets every row pass and fails the query on a repeated key."""
    return F.when(is_repeat, F.raise_error(F.lit(_DUPLICATE_TEXT)).cast("boolean")).otherwise(
        F.lit(True)
    )
