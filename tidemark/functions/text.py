"""Small column expressions over text, sizes and tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted

# Size units, each 1024 times the one before.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB", "ZB", "YB")


def human_bytes(size: Column) -> Column:
    """Bytes as text with two decimals at most: ``1536`` → ``1.5 KB``; ``0B`` for zero or NULL."""
    size = size.cast("long")
    # floor(log1024(n)) from the number of binary digits, exact for every long.
    power = F.floor((F.length(F.bin(size)) - 1) / 10).cast("int")
    value = F.round(size / F.pow(F.lit(1024.0), power), 2)
    unit = F.get(F.array(*[F.lit(u) for u in SIZE_UNITS]), power)
    text = F.concat_ws(" ", value.cast("string"), unit)
    return F.when(size.isNull() | (size == 0), F.lit("0B")).otherwise(text)


def wanted_tags(tag: str | None) -> list[str] | None:
    """Lower-cased requested tags, or None when every tag is wanted."""
    text = (tag or "").strip()
    if text in ("", "*"):
        return None
    return [part.strip().lower() for part in text.split(",")]


def tag_matches(tags: Column, tag: str | None) -> Column:
    """True where the comma list ``tags`` holds one of the requested tags; a NULL list never does."""
    wanted = wanted_tags(tag)
    if wanted is None:
        return tags.isNotNull()
    have = F.transform(F.split(F.lower(tags), ","), lambda t: F.trim(t))
    return F.coalesce(F.arrays_overlap(have, F.array(*[F.lit(t) for t in wanted])), F.lit(False))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def string_length_report(
    df: DataFrame, max_length: int, cols: Sequence[str] | None = None
) -> DataFrame:
    """One row per string column: rows seen, longest value, values over the limit. One scan."""
    cols = list(cols or string_columns(df))
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        size = F.length(F.col(quoted(c)))
        aggregates.append(F.max(size).alias(f"max_{i}"))
        aggregates.append(F.count_if(size > max_length).alias(f"over_{i}"))
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("n_rows"),
                F.col(f"max_{i}").alias("max_length"),
                F.col(f"over_{i}").alias("n_too_long"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.agg(*aggregates).select(F.inline(entries))


def bound_strings(df: DataFrame, max_length: int, cols: Sequence[str] | None = None) -> DataFrame:
    """Let whole strings pass that fit ``max_length`` and fail the query on a longer one."""
    checked = {}
    for c in cols or string_columns(df):
        column = F.col(quoted(c))
        message = F.lit(f"value longer than {max_length} characters in column {c}")
        failure = F.raise_error(message).cast("string")
        checked[c] = F.when(F.length(column) > max_length, failure).otherwise(column)
    return df.withColumns(checked) if checked else df
