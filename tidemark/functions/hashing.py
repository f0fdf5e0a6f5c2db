"""Row hash and surrogate key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted
from tidemark.names import HASH, PRIMARY_KEY

# Fixed value: separator between the hashed values.
SEPARATOR = "||"


def _as_text(field: T.StructField, null_token: str | None) -> Column:
    column = F.col(quoted(field.name))
    if isinstance(field.dataType, T.ArrayType):
        if not isinstance(field.dataType.elementType, T.StringType):
            raise ValueError(f"column {field.name!r} is nested: hash it with mode='json'")
    elif isinstance(field.dataType, (T.StructType, T.MapType, T.VariantType)):
        raise ValueError(f"column {field.name!r} is nested: hash it with mode='json'")
    else:
        column = column.cast("string")
    return column if null_token is None else F.coalesce(column, F.lit(null_token))


def joined_text(df: DataFrame, cols: Sequence[str], null_token: str | None = None) -> Column:
    return F.concat_ws(SEPARATOR, *[_as_text(df.schema[c], null_token) for c in cols])


def with_row_hash(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    mode: str = "concat",
    null_token: str | None = None,
    name: str = HASH,
) -> DataFrame:
    """Append the sha-256 change hash over ``cols`` (all columns by default).

    ``concat`` joins the values as text and, like the built-in ``concat_ws``, skips NULLs unless a
    ``null_token`` is given; ``json`` hashes the row as a JSON document and takes nested columns.
    """
    return df.withColumn(name, row_hash(df, cols, mode, null_token))


def row_hash(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    mode: str = "concat",
    null_token: str | None = None,
) -> Column:
    """The hash of ``with_row_hash`` as an expression over the columns of ``df``."""
    cols = list(cols or df.columns)
    if mode == "concat":
        payload = joined_text(df, cols, null_token)
    elif mode == "json":
        payload = F.to_json(F.struct(*[F.col(quoted(c)) for c in cols]))
    else:
        raise ValueError(f"unknown hash mode {mode!r}")
    return F.sha2(payload, 256)


def with_primary_key(df: DataFrame, keys: Sequence[str], name: str = PRIMARY_KEY) -> DataFrame:
    """Append the sha-1 surrogate of the business key."""
    return df.withColumn(name, primary_key(df, keys))


def primary_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """The key of ``with_primary_key`` as an expression over the columns of ``df``."""
    return F.sha1(joined_text(df, keys))
