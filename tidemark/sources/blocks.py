"""Moving and peeking at single files inside tasks, for any file system Arrow knows."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import SparkSession

from tidemark.sources.paths import plain_path

_BLOCK = 8 * 1024 * 1024
_LINE_BLOCK = 64 * 1024


# How Spark's file systems are called here.
_ARROW_SCHEMES = {
    "file": "file",
    "s3": "s3",
    "s3a": "s3",
    "s3n": "s3",
    "gs": "gs",
    "hdfs": "hdfs",
    "viewfs": "viewfs",
    "abfs": "abfs",
    "abfss": "abfss",
}
# Session settings that carry credentials, and the option each stands for.
_S3_SETTINGS = {
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.endpoint.region": "region",
}


def arrow_uri(path: str) -> str:
    """A path as Arrow names it; an error for a file system that it does not know.

    ``wasb(s)`` becomes ``abfs(s)`` of the same account, ``dbfs`` its mount on every machine.
    """
    path = plain_path(path)
    scheme, colon, rest = path.partition(":")
    if path.startswith("/") or not colon:
        return path
    if scheme == "dbfs":
        return "/dbfs/" + rest.lstrip("/")
    if scheme in ("wasb", "wasbs"):
        host, slash, name = rest.removeprefix("//").partition("/")
        host = host.replace(".blob.", ".dfs.")
        return f"{scheme.replace('wasb', 'abfs')}://{host}{slash}{name}"
    if scheme not in _ARROW_SCHEMES:
        raise ValueError(f"files on {scheme!r} cannot be moved: {path}")
    return f"{_ARROW_SCHEMES[scheme]}:{rest}"


def storage_options(spark: SparkSession) -> dict[str, str]:
    """The credentials that the session has for its object store, for the tasks that move files."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {option: conf.get(setting) for setting, option in _S3_SETTINGS.items()}
    return {option: value for option, value in found.items() if value}


def _open_fs(path: str, options: Mapping[str, str] | None = None):
    from pyarrow import fs

    uri = arrow_uri(path)
    if uri.startswith("s3://") and options:
        return fs.S3FileSystem(**dict(options)), uri.removeprefix("s3://")
    return fs.FileSystem.from_uri(uri)


def copy_file(source: str, destination: str, options: Mapping[str, str] | None = None) -> None:
    """Stream a file to another place, block by block."""
    from_fs, from_path = _open_fs(source, options)
    to_fs, to_path = _open_fs(destination, options)
    to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
    with from_fs.open_input_stream(from_path) as reader, to_fs.open_output_stream(to_path) as out:
        while block := reader.read(_BLOCK):
            out.write(block)


def remove_file(
    source: str, destination: str | None = None, options: Mapping[str, str] | None = None
) -> None:
    """Remove a file; one already removed by an earlier attempt is fine."""
    fs, path = _open_fs(source, options)
    try:
        fs.delete_file(path)
    except FileNotFoundError:
        pass


def first_line_digest(path: str, options: Mapping[str, str] | None = None) -> bytes:
    """SHA-256 of the first line without its line end, read block by block, however long it is."""
    fs, plain = _open_fs(path, options)
    digest, held = hashlib.sha256(), b""
    with fs.open_input_stream(plain) as reader:
        while block := reader.read(_LINE_BLOCK):
            head, end, _ = block.partition(b"\n")
            line = held + head
            # Carriage returns count unless the line ends with them.
            text = line.rstrip(b"\r")
            digest.update(text)
            held = line[len(text) :]
            if end:
                break
    return digest.digest()
