"""Declarative description of an incremental load and of a retention policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column

KINDS = ("scd1", "scd2", "scd2_append", "fact")


@dataclass(frozen=True)
class TableSpec:
    """One target table and how pending archive files are applied to it."""

    target: str
    process_log: str
    archive_log: str
    keys: Sequence[str]
    kind: str = "scd1"
    file_format: str = "parquet"
    select: str | Sequence[str | Column] = "*"
    exclude: Sequence[str] = ()
    derive: str | Mapping[str, str | Column] | None = None
    deletes: str | Sequence[str] = "none"
    partition_by: Sequence[str] = ()
    immutable_partitions: bool = False
    # Folders by a hash of the key: a run rewrites those of the keys its files hold. About a gigabyte
    # each is a good size. Deletions may reach any key, so with them all buckets are rewritten.
    key_buckets: int = 0
    # Closed versions of a type-2 table in folders of their own, which runs add to and never read.
    closed_apart: bool = False
    include_previous: bool = False
    update_filter: str | None = None
    complex_as_string: bool = False
    clean: str = "spaces"
    hash_mode: str = "concat"
    with_primary_key: bool = False
    resurrect: bool = True
    # Closing a type-2 version also sets its modification time.
    touch_modified: bool = False
    # Text that stands for NULL in the row hash; without one NULLs are skipped.
    null_token: str | None = None
    # Leave out files that the process log names, for runs that overlap.
    skip_applied: bool = False
    on_duplicate: str = "error"
    reader_options: Mapping[str, str] = field(default_factory=dict)
    schema: Any = None
    source_id: tuple[str, str] | None = None
    default_lookback_days: int = 5
    max_files: int = 5000
    # Tables of this size keep the rows out of a small batch's reach away from the shuffle.
    bypass_min_bytes: int = 1 << 30

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}, got {self.kind!r}")
        if not self.keys:
            raise ValueError("at least one business key column is needed")
        if isinstance(self.deletes, str) and self.deletes not in ("none", "full"):
            raise ValueError("deletes is 'none', 'full' or a list of scope columns")
        if self.kind in ("scd1", "scd2_append") and self.deletes != "none":
            raise ValueError(f"{self.kind} never deletes")
        allowed = ("error", "any", "allow") if self.kind == "scd2_append" else ("error", "any")
        if self.on_duplicate not in allowed:
            raise ValueError(f"on_duplicate of {self.kind} is one of {allowed}, not {self.on_duplicate!r}")
        if self.closed_apart and self.kind != "scd2":
            raise ValueError("closed_apart is for type-2 tables")
        if self.key_buckets < 0:
            raise ValueError("key_buckets is a number of folders, or 0")
        if self.touch_modified and self.kind != "scd2":
            raise ValueError("touch_modified is for type-2 tables")


@dataclass(frozen=True)
class PurgePolicy:
    """Keep the last file of each enabled period; only files older than ``age_days`` are judged."""

    age_days: int = 31
    keep_year: bool = True
    keep_month: bool = True
    keep_week: bool = True
    keep_day: bool = True
    include_prefixes: Sequence[str] = ("archive_",)
    exclude_prefixes: Sequence[str] = ()
