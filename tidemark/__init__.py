"""Change-data operators for medallion lakes, written as Spark DataFrame transforms."""

from tidemark.spec import PurgePolicy, TableSpec

__all__ = ["PurgePolicy", "TableSpec"]
