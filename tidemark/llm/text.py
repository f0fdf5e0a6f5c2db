"""Words, digests and Arrow plumbing shared by the text operators."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# Rows are handed to Python in slices of about this many characters and at most this many rows,
# whatever Arrow's batch size is.
SLICE_CHARS = 4_000_000
SLICE_ROWS = 1_000


def words(data: bytes) -> list[bytes]:
    """Maximal runs of anything but space, tab, line feed, \\v, \\f and carriage return."""
    return data.split()


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def with_text(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The key columns and the text (null: empty), nothing else; extra columns never clash."""
    return df.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("text"))


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """The same frame; sees to it that its session hands at most 1,000 rows to Python at once.

    Texts are long: ten thousand of them, Spark's default, are held several times over by an executor
    and its workers. The setting changes no result; one that is lower already stays.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_ROWS)) <= SLICE_ROWS:
        conf.set(_BATCH_ROWS, str(SLICE_ROWS))
    return df


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_schema(ddl: str) -> pa.Schema:
    kind = _parse_datatype_string(ddl)
    assert isinstance(kind, StructType)
    return to_arrow_schema(kind)


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[dict[str, list]]:
    """Columns of a batch as Python lists, cut where the texts seen so far get long."""
    at = batch.schema.get_field_index(text)
    lengths = pc.utf8_length(batch.column(at)).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths, 1):
        total += n or 0
        if total >= SLICE_CHARS or i - start >= SLICE_ROWS or i == len(lengths):
            part = batch.slice(start, i - start)
            yield {name: part.column(k).to_pylist() for k, name in enumerate(part.schema.names)}
            start, total = i, 0


def map_slices(
    df: DataFrame, fn: Callable[[dict[str, list]], Iterable[dict[str, list]]], ddl: str, text: str = "text"
) -> DataFrame:
    """``mapInArrow`` by slices; ``fn`` yields dicts of equally long columns that ``ddl`` names."""

    schema, module = arrow_schema(ddl), fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work(module)
        for batch in batches:
            for columns in slices(batch, text):
                for out in fn(columns):
                    arrays = [pa.array(out[f.name], f.type) for f in schema]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return in_small_batches(df).mapInArrow(run, ddl)


_forgetting: dict[str, Callable[[], None]] = {}
_at_work: str | None = None


def remembered_by(module: str, forget: Callable[[], None]) -> None:
    """``forget`` drops what the rows of ``module``'s operators make a worker remember."""
    _forgetting[module] = forget


def at_work(module: str) -> None:
    """Drop what this worker remembers of another module's work.

    Spark hands a worker from stage to stage, and all of an executor's workers in turn: tokenizers and words
    of one stage would be held several times over as long as the next ones run.
    """
    global _at_work
    if _at_work != module:
        if _at_work in _forgetting:
            _forgetting[_at_work]()
            gc.collect()
        pa.default_memory_pool().release_unused()
    _at_work = module


class Recent(dict):
    """What a worker has made lately, between ``limit`` and twice as many entries; makes what is missing.

    Full, it becomes the older half; an older entry that is used comes back.
    """

    def __init__(self, make: Callable, limit: int = 250_000):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.put_all({key: value})
        return value

    def put_all(self, made: dict) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self.update(made)
