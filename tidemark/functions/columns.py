"""Column lists, select lists and name clean-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters not allowed in stored column names and what they become.
INVALID_NAME_CHARACTERS = {
    " ": "_",
    ",": "_",
    ";": "_",
    "{": "_",
    "}": "_",
    "(": "_",
    ")": "_",
    "\n": "_",
    "\t": "_",
    "=": "_",
    ".": "_",
    "[": "",
    "]": "",
}
DROPPED_NAME_PART = "value."

ColumnLike = str | Column


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parse_column_list(text: str | None) -> list[str]:
    """``"[a], b"`` → ``["a", "b"]``; empty text is an empty list."""
    if not text or not text.strip():
        return []
    return [part.strip().strip("[]`").strip() for part in text.split(",") if part.strip()]


def bracket_text(text: str, as_backticks: bool = False) -> str:
    """Bracketed names in SQL text: brackets removed, or turned into back-ticks."""
    opening, closing = ("`", "`") if as_backticks else ("", "")
    return text.replace("[", opening).replace("]", closing)


def _sql_select(df: DataFrame, select_list: str) -> DataFrame:
    text = select_list.replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT {text} FROM {{src}}", src=df)


def select_columns(
    df: DataFrame,
    select: str | Sequence[ColumnLike] = "*",
    brackets: str = "strip",
    keep: str | None = None,
) -> DataFrame:
    """Project ``df``: SQL text as one string, or a list of columns / SQL expressions.

    ``brackets="strip"`` removes square brackets from SQL text, ``"quote"`` turns them into
    back-ticks so that bracketed names may hold spaces. ``keep`` names one more column to carry.
    """
    if not isinstance(select, str):
        picked = [F.expr(c) if isinstance(c, str) else c for c in select]
        return df.select(*picked, *([quoted(keep)] if keep else []))
    text = bracket_text(select, as_backticks=brackets == "quote")
    if text.strip() == "*":
        return df
    if keep is None:
        return _sql_select(df, text)
    # A star in the text brings the kept column along, so it travels under another name.
    aside = f"{keep}_kept"
    picked = _sql_select(df, f"{text}, {quoted(keep)} AS {quoted(aside)}")
    return picked.drop(keep).withColumnRenamed(aside, keep)


def derive_columns(df: DataFrame, derive: str | Mapping[str, ColumnLike] | None) -> DataFrame:
    """Add partition columns from SQL text (``year(d) AS __year, …``) or a name → expression map."""
    if not derive:
        return df
    if isinstance(derive, str):
        return _sql_select(df, "*, " + derive)
    return df.withColumns(
        {name: F.expr(e) if isinstance(e, str) else e for name, e in derive.items()}
    )


def exclude_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns that must not cause changes; unknown names are ignored."""
    return df.drop(*[c for c in cols if c])


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after clean-up: {clashes}")
    return df.toDF(*names)


def clean_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return _renamed(df, [c.replace(" ", "_") for c in df.columns])


def clean_name_full(name: str) -> str:
    return name.replace(DROPPED_NAME_PART, "").translate(str.maketrans(INVALID_NAME_CHARACTERS))


def clean_names_full(df: DataFrame) -> DataFrame:
    """Drop the flattening prefix, replace invalid characters, remove brackets."""
    return _renamed(df, [clean_name_full(c) for c in df.columns])


def complex_as_string(df: DataFrame) -> DataFrame:
    """Cast struct and array columns to string; maps stay as they are."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    return df.withColumns({c: F.col(quoted(c)).cast("string") for c in nested}) if nested else df


def nonnull_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose whole business key is present."""
    return df.dropna(subset=list(keys))
