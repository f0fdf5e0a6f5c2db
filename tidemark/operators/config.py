"""Metadata-driven runs: configuration look-up by tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_name_full, parse_column_list, quoted
from tidemark.functions.text import tag_matches
from tidemark.names import CONFIG_SILVER
from tidemark.spec import TableSpec

SILVER_COLUMNS = tuple(n for n in CONFIG_SILVER.names if n not in ("IsActive", "Tag"))


def active_rows(config: DataFrame, tag: str | None) -> DataFrame:
    """Active rows that carry one of the requested tags; an empty tag or ``*`` takes all."""
    return config.where(F.col("IsActive") & tag_matches(F.col("Tag"), tag))


def config_lookup(config: DataFrame, tag: str | None, columns: Sequence[str]) -> DataFrame:
    """Distinct requested columns of the matching rows, NULL text as empty text."""
    rows = active_rows(config, tag)
    return rows.select(
        *[F.coalesce(F.col(quoted(c)), F.lit("")).alias(c) for c in columns]
    ).distinct()


def bronze_lookup(config: DataFrame, tag: str | None) -> DataFrame:
    """Distinct source queries and lower-cased data set names to ingest."""
    return active_rows(config, tag).select("Query", F.lower("Dataset").alias("Dataset")).distinct()


def silver_lookup(config: DataFrame, tag: str | None) -> DataFrame:
    return config_lookup(config, tag, SILVER_COLUMNS)


# Load types of the configuration table.
_KINDS = {"SCD1": "scd1", "SCD2": "scd2_append", "FACT": "fact"}


def spec_from_row(row: Row, table_root: str, archive_root: str, process_log: str) -> TableSpec:
    """The load one configuration row describes; its process log is below ``process_log``.

    Every target has a log of its own: two targets of one source advance on their own.
    """
    name = row["Type"].strip().upper()
    if name not in _KINDS:
        raise ValueError(f"{row['SilverSchema']}.{row['SilverTable']}: load type {row['Type']!r} is none of {sorted(_KINDS)}")
    kind = _KINDS[name]
    scope = [clean_name_full(c) for c in parse_column_list(row["DeleteFilterColumns"])]
    deletes: str | list[str] = "none"
    if kind == "fact":
        deletes = scope or "full"
    return TableSpec(
        target=f"{table_root}/{row['SilverSchema']}/{row['SilverTable']}",
        process_log=f"{process_log}/{row['SilverSchema']}/{row['SilverTable']}",
        archive_log=f"{archive_root}/{row['BronzeSchema']}/{row['BronzeTable']}",
        keys=[clean_name_full(c) for c in parse_column_list(row["BusinessKeyColumns"])],
        kind=kind,
        select=row["ExtractColumns"].strip() or "*",
        exclude=[clean_name_full(c) for c in parse_column_list(row["ExcludeColumns"])],
        deletes=deletes,
        clean="full",
        with_primary_key=True,
        source_id=(row["BronzeSchema"], row["BronzeTable"]),
        default_lookback_days=90,
    )


def rows_from_config(config: DataFrame, tag: str | None) -> list[Row]:
    """The selected loads; a configuration table has one row per managed table."""
    return silver_lookup(config, tag).orderBy(*SILVER_COLUMNS).collect()
