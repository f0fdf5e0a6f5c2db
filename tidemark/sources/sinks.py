"""Publish folders, staged sets, warehouse writers and external tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import clean_names, quoted, select_columns
from tidemark.names import ARCHIVED, STAGING_NAME
from tidemark.operators.common import cols
from tidemark.plans.lookup import lookup_join
from tidemark.sources.hadoop import Folder
from tidemark.sources.readers import SOURCE_PATH, with_source_path


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Gather the rows of each table partition in few even files, splitting large partitions.

    Only a partitioned write needs it: without it every task would add a file to every partition.
    The tasks of an unpartitioned write are sized by AQE or by the scan already.
    """
    return df.hint("rebalance", *by) if by else df


def staged_rows(
    extracts: DataFrame, files: DataFrame, select: str | Sequence = "*", tag_lineage: bool = True
) -> DataFrame:
    """Selected columns of many pending files in one frame, with clean names and file lineage.

    ``files`` lists the pending archive files with their archive time and original name.
    """
    picked = select_columns(with_source_path(extracts), select, brackets="quote", keep=SOURCE_PATH)
    if not tag_lineage:
        return clean_names(picked.drop(SOURCE_PATH))
    lineage = files.select(
        F.col("ArchiveFilePath").alias(SOURCE_PATH),
        F.col("ArchiveDatetimeUTC").alias(ARCHIVED),
        F.col("OriginalStagingFileName").alias(STAGING_NAME),
    )
    content = [c for c in picked.columns if c != SOURCE_PATH]
    tagged = lookup_join(picked, lineage, [SOURCE_PATH], "left", spread_by=content)
    return clean_names(tagged.drop(SOURCE_PATH))


def publish(rows: DataFrame, target_path: str, mode: str = "append") -> None:
    """Write published rows as Parquet."""
    rows.write.mode(mode).parquet(target_path)


def create_table(
    df: DataFrame, table: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Create a table from its first batch, partitioned if asked to."""
    writer = rebalanced(df, partition_by).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def register_table(spark: SparkSession, table: str, path: str) -> None:
    """Register an external table over existing Parquet files, with its partitions."""
    spark.catalog.createTable(table, path=path, source="parquet")
    if Folder(spark, path).folders("*=*"):
        spark.catalog.recoverPartitions(table)


def archive_table_name(path: str) -> str:
    """``source/table`` → ``archive_source_table``."""
    return "archive_" + path.strip("/").replace("/", "_").lower()


def jdbc_write_options(
    schema: T.StructType,
    url: str,
    table: str,
    max_string_length: int | None = None,
    distribution: str | None = None,
    num_partitions: int = 16,
    batch_size: int = 10_000,
    truncate: bool = True,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a full overwrite of a warehouse table.

    ``max_string_length`` declares string columns as bounded text; None leaves the dialect's
    largest text type. ``distribution`` becomes the table's distribution clause.
    """
    options = {
        "url": url,
        "dbtable": table,
        "numPartitions": str(num_partitions),
        "batchsize": str(batch_size),
        "truncate": str(truncate).lower(),
        **dict(properties or {}),
    }
    if max_string_length is not None:
        text = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
        if text:
            options["createTableColumnTypes"] = ", ".join(
                f"{quoted(c)} VARCHAR({max_string_length})" for c in text
            )
    if distribution is not None:
        options["createTableOptions"] = f"WITH(DISTRIBUTION = {distribution}, HEAP)"
    return options


def write_jdbc(df: DataFrame, url: str, table: str, spread_by: Sequence[str] = (), **options) -> None:
    """Overwrite a warehouse table; ``spread_by`` matches its distribution key."""
    settings = jdbc_write_options(df.schema, url, table, **options)
    if spread_by:
        df = df.repartition(int(settings["numPartitions"]), *cols(spread_by))
    df.write.format("jdbc").options(**settings).mode("overwrite").save()
