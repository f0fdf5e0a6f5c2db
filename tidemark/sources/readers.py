"""Readers for archived extracts, tables and query sources."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.evolve import evolve_union_all
from tidemark.sources.blocks import first_line_digest, storage_options
from tidemark.sources.hadoop import Folder
from tidemark.sources.paths import file_path_col

SOURCE_PATH = "_tm_path"

# CSV defaults of table loads, and the delimiter of publish and stage runs.
CSV_DEFAULTS = {"header": "true", "sep": ",", "encoding": "ISO-8859-1"}
PUBLISH_SEPARATOR = ";"

# Files whose kind or schema is asked for at a time.
PROBES = 16


def read_parquet(
    spark: SparkSession,
    paths: Sequence[str],
    merge_schema: bool = True,
    schema: Any = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All files in one scan; columns missing in a file are NULL for it."""
    reader = spark.read.options(**dict(options or {}))
    if schema is not None:
        return reader.schema(schema).parquet(*paths)
    return reader.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def read_csv(
    spark: SparkSession,
    paths: Sequence[str],
    options: Mapping[str, str] | None = None,
    same_header: bool = True,
) -> DataFrame:
    """Delimited text with a header, every column a string.

    Files that share their header are read in one scan, which fails on a deviating header. With
    ``same_header=False`` the first lines are read by the executors, files with equal ones are
    scanned together and the scans are united by column name.
    """
    settings = {**CSV_DEFAULTS, **dict(options or {})}
    reader = spark.read.options(**settings).option("enforceSchema", "false")
    paths = list(paths)
    if same_header or len(paths) == 1:
        return reader.csv(paths)
    return evolve_union_all(
        [with_source_path(reader.csv(group)) for group in _by_first_line(spark, paths)]
    )


def _by_first_line(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    lines = listed.repartition(tasks, "path").mapInPandas(
        partial(_first_lines, storage_options(spark)), "path string, line binary"
    )
    groups: dict[bytes, list[str]] = {}
    for row in lines.orderBy("path").collect():
        groups.setdefault(bytes(row["line"]), []).append(row["path"])
    return list(groups.values())


def _first_lines(
    options: Mapping[str, str], batches: Iterator[pd.DataFrame]
) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.assign(line=[first_line_digest(p, options) for p in pdf["path"]])


def read_json(
    spark: SparkSession,
    paths: Sequence[str],
    schema: Any = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """JSON lines; a given schema saves the pass over the data that infers one."""
    reader = spark.read.options(**dict(options or {}))
    return (reader if schema is None else reader.schema(schema)).json(list(paths))


def with_source_path(df: DataFrame, of_folder: bool = False) -> DataFrame:
    """Add the plain path of the file each row comes from, or of that file's folder."""
    if SOURCE_PATH in df.columns:
        return df
    path = file_path_col()
    return df.withColumn(SOURCE_PATH, F.regexp_replace(path, "/[^/]+$", "") if of_folder else path)


def _probed(paths: Sequence[str], probe: Callable[[str], Any]) -> list[Any]:
    """The answers to one question about each path, several asked at a time."""
    with ThreadPool(min(PROBES, max(1, len(paths)))) as pool:
        return pool.map(probe, paths)


def _by_kind(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], bool]]:
    """Single files and folders of part files apart, each with whether they are folders."""
    kinds = _probed(paths, lambda p: Folder(spark, p).is_folder())
    groups = [([p for p, k in zip(paths, kinds, strict=True) if k == kind], kind) for kind in (False, True)]
    return [g for g in groups if g[0]]


def read_extracts(
    spark: SparkSession,
    paths: Sequence[str],
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: Any = None,
    same_header: bool = True,
) -> DataFrame:
    """Archived extracts of one format, each row tagged with the path of its extract.

    An extract is one file, or a folder of part files; the two kinds are scanned apart.
    """
    scans = []
    for group, of_folder in _by_kind(spark, paths):
        if file_format == "parquet":
            df = read_parquet(spark, group, schema=schema, options=options)
        elif file_format == "csv":
            df = read_csv(spark, group, options, same_header or of_folder)
        elif file_format == "json":
            df = read_json(spark, group, schema, options)
        else:
            raise ValueError(f"unknown file format {file_format!r}")
        scans.append(with_source_path(df, of_folder))
    return evolve_union_all(scans)


def scans_by_schema(
    spark: SparkSession,
    paths: Sequence[str],
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: Any = None,
) -> list[DataFrame]:
    """One scan for the extracts of each schema, so that each is seen as if it were read alone.

    Column order and types count. Without a given schema the footer of each Parquet extract, the
    first line of each CSV file or the content of each JSON extract is asked for its own.
    """
    scans = []
    for group, of_folder in _by_kind(spark, paths):
        if file_format == "csv":
            parts = [[p] for p in group] if of_folder else _by_first_line(spark, group)
            frames = [read_csv(spark, part, options) for part in parts]
        elif file_format not in ("parquet", "json"):
            raise ValueError(f"unknown file format {file_format!r}")
        else:
            reader = spark.read.options(**dict(options or {}))
            scan = reader.parquet if file_format == "parquet" else lambda p, r=reader: r.json(p)
            found = [schema] * len(group) if schema is not None else _probed(group, lambda p, s=scan: s(p).schema)
            by_schema: dict[str, tuple[Any, list[str]]] = {}
            for path, own in zip(group, found, strict=True):
                by_schema.setdefault(own if isinstance(own, str) else own.json(), (own, []))[1].append(path)
            read = {"parquet": read_parquet, "json": read_json}[file_format]
            frames = [read(spark, part, schema=own, options=options) for own, part in by_schema.values()]
        scans += [with_source_path(df, of_folder) for df in frames]
    return scans


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or Parquet files by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database as rows: ``namespace, tableName, isTemporary``."""
    return spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database})


def jdbc_query_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC read of user SQL.

    With a partition column and its bounds the rows are read by several tasks; then the SQL is
    wrapped as a derived table, which a partitioned read needs.
    """
    options = {"url": url, "fetchsize": str(fetch_size), **dict(properties or {})}
    if partition_column is None:
        return {**options, "query": query}
    if bounds is None or not num_partitions:
        raise ValueError("a partitioned read needs bounds and num_partitions")
    return {
        **options,
        "dbtable": f"({query}) tidemark_source",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(num_partitions),
    }


def read_jdbc_query(spark: SparkSession, url: str, query: str, **options: Any) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_query_options(url, query, **options)).load()


