"""Table snapshots as Parquet folders and one small commit file per version.

Plain Parquet cannot be merged in place: a path must not be overwritten while it is read. Each
commit writes a new run folder and then one commit file that lists the folders making up the
version; readers see the last commit file only. A partition-wise commit carries the untouched
partition folders over. This is file lay-out, not a transaction engine: one writer per table.

A ``Layout`` deals the rows of a table over folders of its own, whatever its columns: by a hash of the
key, which never changes, and closed versions away from open ones. A merge then reads and writes the
folders of the keys it touches, and adds versions it closes to those closed before.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted
from tidemark.names import BUCKET, CURRENT, HISTORY_LOG, OPEN, PART
from tidemark.operators.evolve import evolve_union, merged_schema
from tidemark.sources.hadoop import Folder
from tidemark.sources.sinks import rebalanced

TARGET_FILE_BYTES = 134_217_728
_RUN = "tmrun"
_COMMITS = "_commits"


@dataclass(frozen=True)
class Layout:
    """Folders by key bucket (``buckets`` of them, 0 for none) and by open and closed versions."""

    keys: tuple[str, ...] = ()
    buckets: int = 0
    closed_apart: bool = False

    def __str__(self) -> str:
        """What tells two layouts apart; empty for none."""
        return json.dumps([self.keys, self.buckets, self.closed_apart]) if self.columns() else ""

    def bucket(self) -> Column:
        """The bucket of a row; as text, so a key column that gets a wider type keeps it."""
        keys = [F.col(quoted(k)).cast("string") for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def dealing(self, groups: int) -> dict[str, Column]:
        """The bucket of a row and a part of it, so that there are ``groups`` of both or more."""
        parts = -(-groups // self.buckets)
        keys = [F.col(quoted(k)).cast("string") for k in self.keys]
        return {BUCKET: self.bucket(), PART: F.pmod(F.hash(*keys), F.lit(parts))}

    def columns(self) -> dict[str, Column]:
        found = {BUCKET: self.bucket()} if self.buckets else {}
        return found | ({OPEN: F.col(CURRENT)} if self.closed_apart else {})

    def is_closed(self, folder: str) -> bool:
        return self.closed_apart and f"{OPEN}=false" in folder.split("/")

    def takes_part(self, folder: str, touched: Collection[int] | None) -> bool:
        """Does a merge of these buckets (None: of all) read and replace the folder?"""
        if self.is_closed(folder):
            return False
        found = re.search(rf"/{BUCKET}=(\d+)(/|$)", folder)
        return touched is None or found is None or int(found[1]) in touched


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...]
    schema: T.StructType
    partition_by: tuple[str, ...]
    operation: str
    timestamp: str
    applied: tuple[str, ...] = ()
    layout: str = ""

    def to_json(self) -> str:
        body = dict(self.__dict__, schema=json.loads(self.schema.json()))
        return json.dumps(body)

    @staticmethod
    def from_json(text: str) -> Version:
        body = json.loads(text)
        body["schema"] = T.StructType.fromJson(body["schema"])
        for name in ("folders", "partition_by", "applied"):
            body[name] = tuple(body[name])
        return Version(**body)


class SnapshotStore:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partition_by: Sequence[str] = (),
        layout: Layout | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = tuple(partition_by)
        self.layout = layout or Layout()
        self._folder = Folder(spark, self.path)
        # What this object has written and carried over so far.
        self.written_bytes = self.carried_folders = 0

    # --- reading -------------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        names = self._folder.names(_COMMITS)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version | None:
        numbers = self._numbers()
        if not numbers:
            return None
        number = numbers[-1] if number is None else number
        return Version.from_json(self._folder.read_text(f"{_COMMITS}/{number:012d}.json"))

    def read(
        self, number: int | None = None, keep: Callable[[str], bool] = lambda folder: True
    ) -> DataFrame | None:
        """The table at a version, the last one by default; None before the first commit.

        ``keep`` picks folders by name, before anything is scanned.
        """
        version = self.version(number)
        if version is None:
            return None
        return self._scan([f for f in version.folders if keep(f)], version.schema)

    def fits_layout(self) -> bool:
        """Is the last version laid out as this object would write it?"""
        last = self.version()
        return last is not None and last.layout == str(self.layout)

    def _scan(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        data = f"{self.path}/data"
        reader = self.spark.read.schema(schema).option("basePath", data)
        return reader.parquet(*[f"{data}/{f}" for f in folders]).select(*_quoted(schema.names))

    def history(self) -> DataFrame:
        """Commit times and operations, newest last."""
        if not self._numbers():
            return self.spark.createDataFrame([], HISTORY_LOG)
        commits = self.spark.read.schema("timestamp string, operation string").json(
            f"{self.path}/{_COMMITS}"
        )
        return commits.select(F.col("timestamp").cast("timestamp_ntz"), "operation")

    # --- writing -------------------------------------------------------------------------------

    def _write_run(self, df: DataFrame, dealt: bool = False) -> list[str]:
        run = f"{_RUN}={uuid.uuid4().hex}"
        by = [*self.layout.columns(), *self.partition_by]
        rows = df.withColumns(self.layout.columns())
        # Half of a row is its hash, hex digits that only an entropy coder makes shorter.
        writer = (rows if dealt else rebalanced(rows, by)).write.option("compression", "zstd")
        if by:
            writer = writer.partitionBy(*by)
        writer.parquet(f"{self.path}/data/{run}")
        self.written_bytes += self._folder.size(f"data/{run}")
        return self._folder.folders("data/" + run + "/*" * len(by)) if by else [run]

    def commit(
        self,
        df: DataFrame,
        operation: str = "WRITE",
        mode: str = "replace",
        applied: Sequence[str] = (),
        now: datetime | None = None,
        touched: Collection[int] | None = None,
        dealt: bool = False,
    ) -> Version:
        """Write a version.

        ``replace`` makes ``df`` the whole table, ``append`` adds it, ``partitions`` replaces just
        the partitions that occur in ``df``, ``buckets`` the folders that take part in a merge of the
        ``touched`` buckets (all by default). ``applied`` records the source files the version
        includes. A table of another layout must be replaced; an append rewrites it. Rows that are
        ``dealt`` by the layout over tasks already are written as they are.
        """
        last = self.version()
        if last is not None and mode != "replace" and last.layout != str(self.layout):
            if mode != "append":
                raise ValueError(f"the table has the layout {last.layout!r}: replace it as a whole")
            df, mode = evolve_union(self.read(), df), "replace"
        schema = _nullable(df.schema)
        written = [f.removeprefix("data/") for f in self._write_run(df, dealt)]
        kept: list[str] = []
        if last is not None and mode == "append":
            kept = list(last.folders)
        elif last is not None and mode == "partitions":
            replaced = {_partition_of(f) for f in written}
            kept = [f for f in last.folders if _partition_of(f) not in replaced]
        elif last is not None and mode == "buckets":
            kept = [f for f in last.folders if not self.layout.takes_part(f, touched)]
        self.carried_folders += len(kept)
        if last is not None and mode != "replace":
            schema = _nullable(merged_schema(last.schema, schema))
        return self._commit_folders([*kept, *written], schema, operation, applied, now, last)

    def _commit_folders(self, folders, schema, operation, applied, now, last) -> Version:
        number = 1 if last is None else last.number + 1
        stamp = (now or datetime.utcnow()).isoformat(sep=" ")
        version = Version(
            number,
            tuple(folders),
            schema,
            self.partition_by,
            operation,
            stamp,
            tuple(applied),
            str(self.layout),
        )
        self._folder.write_text(f"{_COMMITS}/{number:012d}.json", version.to_json())
        return version

    # --- upkeep --------------------------------------------------------------------------------

    def compact(self, target_bytes: int = TARGET_FILE_BYTES, now: datetime | None = None) -> int:
        """Rewrite the folders whose files are much smaller than the target; returns how many.

        Folders of one partition are merged; folders with well-sized files are left alone.
        """
        last = self.version()
        if last is None or not last.folders:
            return 0
        data = f"{self.path}/data"
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        sizes = files.load([f"{data}/{f}" for f in last.folders]).select(
            F.regexp_extract("path", rf"({_RUN}=.*)/[^/]+$", 1).alias("folder"), "length"
        )
        by_folder = {
            r["folder"]: (r["n"], r["bytes"])
            for r in sizes.groupBy("folder")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
            .collect()
        }
        groups: dict[str, list[str]] = {}
        for f in last.folders:
            groups.setdefault(_partition_of(f), []).append(f)
        small = []
        for folders in groups.values():
            n = sum(by_folder.get(f, (0, 0))[0] for f in folders)
            size = sum(by_folder.get(f, (0, 0))[1] for f in folders)
            if n > 1 and size / n < target_bytes / 2:
                small += folders
        if not small:
            return 0
        written = [f.removeprefix("data/") for f in self._write_run(self._scan(small, last.schema))]
        kept = [f for f in last.folders if f not in set(small)]
        self._commit_folders([*kept, *written], last.schema, "OPTIMIZE", last.applied, now, last)
        return len(small)

    def vacuum(
        self,
        keep_versions: int = 1,
        now: datetime | None = None,
        min_age: timedelta = timedelta(days=7),
    ) -> int:
        """Remove folders that no kept version needs; returns how many.

        The newest versions are kept, and all that were the newest within ``min_age``, which a running
        reader may still use. So are folders written within it: a running writer may commit them.
        """
        numbers = self._numbers()
        if not numbers:
            return 0
        before = (now or datetime.utcnow()) - min_age
        last = self.version()
        versions = {n: self.version(n) for n in numbers}
        kept = set(numbers[-keep_versions:])
        for n, after in zip(numbers, numbers[1:], strict=False):
            if datetime.fromisoformat(versions[after].timestamp) > before:
                kept.add(n)
        needed = {f for n in kept for f in versions[n].folders}
        known = {f for v in versions.values() for f in v.folders}
        depth = 1 + len(self.layout.columns()) + len(self.partition_by)
        present = [f.removeprefix("data/") for f in self._folder.folders("data" + "/*" * depth)]
        unneeded = [
            f
            for f in present
            if f not in needed and (f in known or self._folder.modified(f"data/{f}") <= before)
        ]
        for f in unneeded:
            self._folder.remove(f"data/{f}", recursive=True)
        for n in numbers:
            if n not in kept:
                self._folder.remove(f"{_COMMITS}/{n:012d}.json")
        self._commit_folders(
            last.folders, last.schema, "VACUUM END", last.applied, now, last
        )
        return len(unneeded)


def _quoted(names: Sequence[str]) -> list[str]:
    return ["`" + n.replace("`", "``") + "`" for n in names]


def _partition_of(folder: str) -> str:
    """The partition part of a run folder: empty for an unpartitioned table."""
    return folder.partition("/")[2]


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
