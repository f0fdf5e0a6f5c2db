"""Additive schema evolution: columns are added and widened, never dropped."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted

# Numeric types from narrow to wide.
_NUMERIC_ORDER = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
)
_LONG_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def wider_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest type that holds both without loss, or an error when there is none."""
    if left == right:
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType):
        return left
    kinds = (type(left), type(right))
    if all(k in _NUMERIC_ORDER for k in kinds):
        wide = max(kinds, key=_NUMERIC_ORDER.index)
        # A float has too few digits for an int, a double holds every int exactly.
        if wide is T.FloatType and any(k in (T.IntegerType, T.LongType) for k in kinds):
            wide = T.DoubleType
        if wide is T.DoubleType and T.LongType in kinds:
            raise TypeError("a bigint does not fit a double without loss")
        return wide()
    if any(isinstance(t, T.DecimalType) for t in (left, right)):
        parts = [_as_decimal(t) for t in (left, right)]
        if None not in parts:
            scale = max(p.scale for p in parts)
            precision = max(p.precision - p.scale for p in parts) + scale
            if precision <= 38:
                return T.DecimalType(precision, scale)
    dates = (T.DateType, T.TimestampNTZType)
    if all(isinstance(t, dates) for t in (left, right)):
        return T.TimestampNTZType()
    raise TypeError(f"cannot widen {left.simpleString()} and {right.simpleString()}")


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = _LONG_DIGITS.get(type(kind))
    return T.DecimalType(digits, 0) if digits else None


def merged_schema(left: T.StructType, right: T.StructType) -> T.StructType:
    """Columns of ``left`` first, then the new ones of ``right``; shared columns widened."""
    fields = []
    names = {f.name for f in left}
    for f in left:
        if f.name in right.names:
            fields.append(T.StructField(f.name, wider_type(f.dataType, right[f.name].dataType)))
        else:
            fields.append(T.StructField(f.name, f.dataType))
    fields += [T.StructField(f.name, f.dataType) for f in right if f.name not in names]
    return T.StructType(fields)


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns ``df`` has to their type in ``schema``; absent columns stay absent."""
    casts = {
        f.name: F.col(quoted(f.name)).cast(schema[f.name].dataType)
        for f in df.schema
        if f.name in schema.names and f.dataType != schema[f.name].dataType
    }
    return df.withColumns(casts) if casts else df


def conform(df: DataFrame, schema: T.StructType, *extra: Column) -> DataFrame:
    """The columns of ``schema``, cast where needed and NULL where missing, then ``extra``."""
    return df.select(
        *[
            (F.col(quoted(f.name)) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ],
        *extra,
    )


def evolve_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION ALL by name; missing columns become NULL and shared columns are widened."""
    schema = merged_schema(left.schema, right.schema)
    return conform(left, schema).unionAll(conform(right, schema))


def evolve_union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(evolve_union, frames)


def repair_type(df: DataFrame, column: str, kind: str | T.DataType) -> DataFrame:
    """Rewrite one column with another type."""
    return df.withColumn(column, F.col(quoted(column)).cast(kind))
