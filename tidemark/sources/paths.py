"""One spelling for file paths, on the driver and in columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOCAL = r"^file:/+"


# Slashes that repeat, but for those behind a scheme.
_REPEATED = r"(?<![:/])/{2,}"


def plain_path(path: str) -> str:
    """Local paths without their scheme; no slash repeated."""
    return re.sub(_REPEATED, "/", re.sub(_LOCAL, "/", path))


def plain_path_col(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, _LOCAL, "/"), _REPEATED, "/")


def file_path_col() -> Column:
    """The plain path of the file a row was read from."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return plain_path_col(F.url_decode(encoded))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """The last suffix with its dot, empty for a name without one."""
    return F.regexp_extract(name, r"^\.*[^.].*?(\.[^.]*)$", 1)


def stem(name: Column) -> Column:
    """The name without its last suffix."""
    return F.left(name, F.length(name) - F.length(extension(name)))
