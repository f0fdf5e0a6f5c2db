"""Technical column names and the schemas of the control tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

# Technical column names and the open end of an interval.
HASH = "__HashDiff"
PRIMARY_KEY = "__PrimaryKey"
MODIFIED = "__ModifiedDatetimeUTC"
ARCHIVED = "__ArchiveDatetimeUTC"
FILE_PATH = "__ArchiveFilePath"
STAGING_NAME = "__OriginalStagingFileName"
DELETED = "__DeletedDatetimeUTC"
START = "__StartDatetimeUTC"
END = "__EndDatetimeUTC"
CURRENT = "__Current"
OPEN_END = datetime(9999, 12, 31)

AUDIT = (MODIFIED, ARCHIVED, FILE_PATH, STAGING_NAME)
TECHNICAL = (HASH, PRIMARY_KEY, *AUDIT, DELETED, START, END, CURRENT)

# Batch number of a row inside one fold: 1..n for pending batches.
BATCH = "__Batch"
# Columns of a row's file, where the files of a fold differ in them.
CARRIED = "__Carried"

# Folder columns of a stored table that are no columns of its rows: a hash of the key, and whether a
# version is open.
BUCKET = "__KeyBucket"
OPEN = "__IsOpen"
# Part of a key bucket inside one fold.
PART = "__KeyPart"

# Names, types and order of the columns of the control tables.
_NTZ = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The columns of the control tables.
ARCHIVE_LOG = _schema(
    ("ArchiveDatetimeUTC", _NTZ),
    ("ArchiveYearUTC", T.IntegerType()),
    ("ArchiveMonthUTC", T.IntegerType()),
    ("ArchiveDayUTC", T.IntegerType()),
    ("ArchiveyyyyMMddUTC", T.IntegerType()),
    ("OriginalStagingFilePath", T.StringType()),
    ("OriginalStagingFileName", T.StringType()),
    ("OriginalStagingFileSize", T.LongType()),
    ("OriginalModificationTime", _NTZ),
    ("ArchiveFilePath", T.StringType()),
    ("ArchiveFileName", T.StringType()),
    ("IsPurged", T.BooleanType()),
    ("PurgeDatetimeUTC", _NTZ),
    ("IsIgnorable", T.BooleanType()),
    ("Notes", T.StringType()),
)

# A purged file of the archive log; kept beside it.
PURGE_MARK = _schema(
    ("ArchiveyyyyMMddUTC", T.IntegerType()),
    ("ArchiveDatetimeUTC", _NTZ),
    ("ArchiveFilePath", T.StringType()),
    ("PurgeDatetimeUTC", _NTZ),
)

PROCESS_LOG = _schema(
    ("ProcessDatetime", _NTZ),
    ("ArchiveDatetimeUTC", _NTZ),
    ("OriginalStagingFilePath", T.StringType()),
    ("OriginalStagingFileName", T.StringType()),
    ("OriginalStagingFileSize", T.LongType()),
    ("ArchiveFilePath", T.StringType()),
    ("ArchiveFileName", T.StringType()),
    ("BronzeSchema", T.StringType()),
    ("BronzeTable", T.StringType()),
)

EXPORT_LOG = _schema(("ProcessDatetime", _NTZ))

HISTORY_LOG = _schema(("timestamp", _NTZ), ("operation", T.StringType()))

CONFIG_BRONZE = _schema(
    ("IsActive", T.BooleanType()),
    ("Query", T.StringType()),
    ("Dataset", T.StringType()),
    ("Tag", T.StringType()),
)

CONFIG_SILVER = _schema(
    ("IsActive", T.BooleanType()),
    ("Type", T.StringType()),
    ("BronzeSchema", T.StringType()),
    ("BronzeTable", T.StringType()),
    ("SilverSchema", T.StringType()),
    ("SilverTable", T.StringType()),
    ("BusinessKeyColumns", T.StringType()),
    ("ExtractColumns", T.StringType()),
    ("ExcludeColumns", T.StringType()),
    ("DeleteFilterColumns", T.StringType()),
    ("Tag", T.StringType()),
)
