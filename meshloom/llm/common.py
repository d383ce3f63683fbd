"""What the text operators share: reading, the shared folder, and row-wise work over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import materialise, shared_dir  # noqa: F401

#: Rows are handed to Python in slices of at most this many bytes of text.
SLICE_BYTES = 16 << 20

#: Bytes that are neither letters nor digits become spaces, A-Z become a-z; bytes above 0x7F stay.
ALNUM = bytes(c if c >= 0x80 or chr(c).isdigit() or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_id() -> Column:
    """A key for each row of a scan; doc_id may be null or repeated."""
    return F.monotonically_increasing_id()


def spare(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    return next(n for k in range(len(taken) + 1) if (n := f"__{name}{k or ''}") not in taken)


def is_remainder(of: Column, divisor: int, remainder: int) -> Column:
    """crc32 of the value as text, modulo; a null value counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(of.cast("string"), F.lit("")).cast("binary")), F.lit(divisor)) == remainder


def per_row(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str | T.StructType) -> DataFrame:
    """One output row for each input row.

    make() runs once in each task and returns a function from a row's columns to a tuple of the schema's columns.
    Strings should arrive cast to binary, so that no text is decoded without need.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for columns in slices(batches):
            out = [f(*row) for row in zip(*columns, strict=True)]
            yield to_batch(out, kind)

    return df.mapInArrow(rows, kind)


#: what the tasks of this worker built last, by name: the broadcast value and what was made of it
_BUILT: dict[str, tuple[object, object]] = {}


def once_a_worker(name: str, value: object, build: Callable[[object], object]) -> object:
    """build(value) of a broadcast value, made once by a worker process and kept until tasks with another value come."""
    held = _BUILT.pop(name, None)
    if held is None or held[0] is not value:
        held = None  # the old one goes before the new one is built
        held = (value, build(value))
    _BUILT[name] = held
    return held[1]


def many_rows(df: DataFrame, make: Callable[[], Callable[[Iterator[tuple]], Iterator[tuple]]], schema: str | T.StructType, flush: int = 50_000) -> DataFrame:
    """make()() turns a task's iterator of rows into an iterator of output tuples, sent on in groups of flush."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for x in make()(row for columns in slices(batches) for row in zip(*columns, strict=True)):
            out.append(x)
            if len(out) >= flush:
                yield to_batch(out, kind)
                out = []
        if out:
            yield to_batch(out, kind)

    return df.mapInArrow(rows, kind)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """Columns as Python lists, in slices of bounded size: a batch of long texts never becomes objects at once."""
    for b in batches:
        if not b.num_rows:
            continue
        step = max(1, min(b.num_rows, b.num_rows * SLICE_BYTES // max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield [c.to_pylist() for c in b.slice(at, step).columns]


def to_batch(rows: list[tuple], kind: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(kind)
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_udf(make: Callable[[], Callable[[bytes | None], object]], kind: T.DataType):
    """A vectorised column function from a text (cast to binary) to one value; make() runs once in each task."""
    from pyspark.sql.pandas.types import to_arrow_type

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f, to = make(), to_arrow_type(kind)
        for a in arrays:
            yield pa.array([f(x.as_py()) for x in a], to)

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)
