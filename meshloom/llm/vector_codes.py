"""Vector code compression: each vector becomes one byte a part, the nearest entry of that part's codebook, found by Lloyd's rounds.

Components become integers, vectors are cut into equal parts, and the parts live in tables dealt by (position, entry, salt): the part of a
codebook entry's members that one owner holds. In a round each owner compares its members with the new codebook where they lie. Those that
keep their entry stay where they are; only those that change it go through a shuffle, to the owners of their new entry. Then the owners
add up their resident members, and one row for each component of an entry meets to give the next codebook, which has a fixed size and is
all that reaches the driver or is broadcast. An entry has as many salts as its share of all parts asks for, so that a vector which a
third of all rows repeat is spread over as many owners. Each round's tables are written to the shared folder and the ones before deleted,
so a lost executor costs its tasks only.

Defined cases: rows whose vector is null, empty, holds null or non-finite components, or is of another length than that of the first
kept row have no code and are left out; the first rows are those of the smallest keys, null last, of equal keys those of the smaller
vector; fewer rows than entries give a smaller codebook; a length that the number of parts doesn't divide is filled up with zeros;
components beyond +-2^30 / sqrt(length) count as that, so that sums of squares fit 64 bits; repeated rows each have their code; equal
distances go to the lower index and an entry without members stays; an empty table gives no rows and an empty codebook.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import discard
from .common import materialise, row_id


@dataclass(frozen=True)
class Settings:
    scale: int = 1024
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    #: owners of an entry, for each task's mean share of the parts
    spread: int = 4


#: parts that are compared at once
ROWS = 4096
#: integers up to here are exact in a double
EXACT = 1 << 53


def whole(vector: str | Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def kept_rows(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has components, all of them finite numbers."""
    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows of x to rows of book, exact: with doubles where all numbers on the way are exact in them."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * most * most * x.shape[1] < EXACT:
        a, b = x.astype(float), book.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in book], axis=1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row; the lower index of equals."""
    entry, error = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
    for a in range(0, len(x), ROWS):
        d = distances(x[a : a + ROWS], book)
        at = d.argmin(1)
        entry[a : a + ROWS], error[a : a + ROWS] = at, d[np.arange(len(d)), at]
    return entry, error


def matrix(parts: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(parts.to_pylist()), "<i8").reshape(len(parts), width)


def cut(df: DataFrame, key: str, label: str | None, length: int, settings: Settings) -> DataFrame:
    """One row a part, not yet of any entry (-1); key and label go with the first part."""
    width = -(-length // settings.parts)
    limit = int((1 << 30) / length**0.5)
    kind = {f.name: f.dataType for f in df.schema}
    of_key, of_label = kind[key], kind[label] if label else T.IntegerType()
    schema = T.StructType.fromDDL("row long, position int, entry int, part binary").add("key", of_key).add("label", of_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, keys, labels, vectors = b.columns
            n = len(row)
            x = np.zeros((n, settings.parts * width), "<i8")
            x[:, :length] = np.clip(vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, length), -limit, limit)
            for k in range(settings.parts):
                part = np.ascontiguousarray(x[:, k * width : (k + 1) * width]).view(f"V{8 * width}").ravel()
                none = lambda a: a if k == 0 else pa.nulls(n, a.type)  # noqa: B023,E731
                columns = [row, np.full(n, k, np.int32), np.full(n, -1, np.int32), pa.array([bytes(p) for p in part], pa.binary()), none(keys), none(labels)]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=schema.names)

    held = df.select(row_id().alias("row"), key, F.col(label) if label else F.lit(None).cast("int"), "__v")
    return held.mapInArrow(run, schema)


def compared(members: DataFrame, books: np.ndarray) -> DataFrame:
    """members with the entry nearest now, whether it is another, and the distance: each row stays in its task."""
    width, sent = books.shape[2], members.sparkSession.sparkContext.broadcast(books)
    schema = T.StructType([*members.schema, *T.StructType.fromDDL("moves boolean, error long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            position, old = (b.column(i).to_numpy() for i in (1, 2))
            x, entry, error = matrix(b.column(3), width), old.copy(), np.zeros(len(old), np.int64)
            for k in np.unique(position).tolist():
                here = position == k
                entry[here], error[here] = nearest(x[here], sent.value[k])
            columns = [*b.columns[:2], pa.array(entry), *b.columns[3:], pa.array(entry != old), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return members.mapInArrow(run, schema)


def owners_sums(members: DataFrame, width: int) -> DataFrame:
    """(position, entry, at, total, n): the sum of each component over the members of an entry, added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for b in batches:
            x, of = matrix(b.column(2), width), b.column(0).to_numpy().astype(np.int64) << 32 | b.column(1).to_numpy()
            order = np.argsort(of, kind="stable")
            of, x = of[order], x[order]
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else of
            for key, total, n in zip(of[starts].tolist(), np.add.reduceat(x, starts) if len(of) else x, np.diff(np.append(starts, len(of))).tolist(), strict=True):
                held = sums.setdefault(key, [np.zeros(width, np.int64), 0])
                held[0] += total
                held[1] += n
        rows = [(key >> 32, key & 0xFFFFFFFF, i, t, n) for key, (total, n) in sums.items() for i, t in enumerate(total.tolist())]
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["position", "entry", "at", "total", "n"])

    tasks = members.select("position", "entry", "part").mapInArrow(run, "position int, entry int, at int, total long, n long")
    # decimals, as a sum over all members may need more than 64 bits
    return tasks.groupBy("position", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def migrated(movers: DataFrame, counts: dict[tuple[int, int], int], settings: Settings) -> DataFrame:
    """The parts that change their entry, dealt to the owners of the new one."""
    spark = movers.sparkSession
    share = max(1, sum(counts.values()) // (settings.spread * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # a row for each entry of a codebook, which has a fixed size
    salts = spark.createDataFrame([(p, e, 1 + n // share) for (p, e), n in counts.items()], "position int, entry int, salts int")
    dealt = movers.join(F.broadcast(salts), ["position", "entry"]).withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")))
    return dealt.repartition("position", "entry", "salt").select(movers.columns)


def quantise(df: DataFrame, key: str, vector: str, label: str | None = None, settings: Settings = Settings()) -> tuple[DataFrame, np.ndarray]:
    """(key, label, code, error) of each row with a vector, one byte a part and the sum of squared distances, and the codebooks
    (part, entry, component within the part)."""
    spark = df.sparkSession
    rows = kept_rows(df, vector).withColumn("__v", whole(vector, settings.scale))
    order = [F.col(key).asc_nulls_last(), "__v"]
    head = rows.select(key, "__v").orderBy(*order).limit(1).collect()
    kind = {f.name: f.dataType for f in df.schema}
    schema = T.StructType().add(key, kind[key]).add(label or "label", kind[label] if label else T.IntegerType()).add("code", T.BinaryType()).add("error", T.LongType())
    if not head:
        return spark.createDataFrame([], schema), np.zeros((settings.parts, 0, 0), np.int64)
    length = len(head[0]["__v"])
    width, limit = -(-length // settings.parts), int((1 << 30) / length**0.5)
    rows = rows.where(F.size("__v") == length)
    first = [r["__v"] for r in rows.select(key, "__v").orderBy(*order).limit(settings.entries).collect()]
    start = np.zeros((len(first), settings.parts * width), np.int64)
    start[:, :length] = np.clip(np.array(first), -limit, limit)
    books = np.ascontiguousarray(start.reshape(len(first), settings.parts, width).transpose(1, 0, 2))
    resident = cut(rows, key, label, length, settings)
    held: list[DataFrame] = []
    for _ in range(settings.rounds):
        # written in place, by whether it moves; what moves is shuffled and written at its new owners
        now = materialise(compared(resident, books), "codes-compared", "moves")
        counts = {(r.position, r["entry"]): r["count"] for r in now.groupBy("position", "entry").count().collect()}
        came = materialise(migrated(now.where("moves").drop("moves", "error"), counts, settings), "codes-moved")
        stayed = now.where("NOT moves").drop("moves", "error")
        resident = stayed.unionByName(came)
        for r in owners_sums(resident, width).collect():  # a row for each component of a codebook
            books[r.position, r["entry"], r["at"]] = int(r.total) // r.n
        discard(*held)
        held = [now, came]
    last = compared(resident, books)
    byte = lambda k: F.max(F.when(F.col("position") == k, F.col("entry")))
    out = last.groupBy("row").agg(F.max("key").alias("key"), F.max("label").alias("label"), F.unhex(F.concat(*[F.lpad(F.hex(byte(k)), 2, "0") for k in range(settings.parts)])).alias("code"), F.sum("error").alias("error"))
    out = materialise(out.select(F.col("key").alias(key), F.col("label").alias(label or "label"), "code", "error"), "codes")
    discard(*held)
    return out, books


def restored(codes: DataFrame, books: np.ndarray, length: int, scale: int = Settings().scale, code: str = "code", out: str = "vector") -> DataFrame:
    """codes with the vectors that they stand for: the entries' components as floats."""
    sent = codes.sparkSession.sparkContext.broadcast(books)
    kept = [f for f in codes.schema if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.frombuffer(b"".join(b.column(code).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            x = np.concatenate([sent.value[k][at[:, k]] for k in range(at.shape[1])], axis=1)[:, :length] / scale
            vectors = pa.ListArray.from_arrays(np.arange(0, x.size + 1, length, dtype=np.int32), pa.array(x.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in kept), vectors], names=schema.names)

    return codes.mapInArrow(run, schema)
