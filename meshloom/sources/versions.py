"""Tables that are replaced as a whole: each write is a folder of its own, complete once it is marked, and readers take the newest complete one.

A job that fails or is killed half-way leaves a folder without the mark, so the table stays what it was. The version before the
newest one is kept, for plans that were made on it. Needs no rename, so it holds on object stores too.

A table with a batch_id may also have some batches written anew: a part is a version that holds these alone and lies over what is
older. Once there are more than a few parts they are put together to a whole version again.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: the mark of a whole version, that of a part, and the list of a part's batches, which is there before its mark
MARK, PART, BATCHES = "_complete", "_complete_part", "_batches"
NAME = re.compile(r"v(\d{8})-[0-9a-f]{8}")
#: parts that may lie over a whole version
PARTS = 8


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def has(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def create(spark: SparkSession, path: str, text: str = "") -> None:
    fs, p = hadoop(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def content(spark: SparkSession, path: str) -> str:
    fs, p = hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def listed(spark: SparkSession, path: str) -> list[tuple[str, str | None]]:
    """(name, mark) of the versions in the folder, oldest first; without a mark one isn't complete."""
    fs, root = hadoop(spark, path)
    if not fs.exists(root):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    return [(n, next((m for m in (MARK, PART) if has(spark, f"{path}/{n}/{m}")), None)) for n in names if NAME.fullmatch(n)]


def layers(spark: SparkSession, path: str) -> list[tuple[str, list[int] | None]]:
    """(folder, batches) of what makes up the table now, newest first: parts, and the newest whole version, of which batches is None."""
    out = []
    for n, mark in reversed(listed(spark, path)):
        if mark == MARK:
            return [*out, (f"{path}/{n}", None)]
        if mark == PART:
            out.append((f"{path}/{n}", json.loads(content(spark, f"{path}/{n}/{BATCHES}"))))
    return []


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete whole version; None where there is none."""
    return next((f"{path}/{n}" for n, mark in reversed(listed(spark, path)) if mark == MARK), None)


def read(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame | None:
    """The table as it is now, or the layer that holds a batch; None where no version is complete.

    Columns that a layer lacks are NULL in its rows.
    """
    out, newer = None, set()
    for folder, batches in layers(spark, path):
        df = spark.read.parquet(folder)
        if batch is not None:
            if batches is None or batch in batches:
                return df
            continue
        if newer:
            df = df.where(F.col("batch_id").isNull() | ~F.col("batch_id").isin(sorted(newer)))
        newer |= set(batches or [])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write(df: DataFrame, path: str, keep: int = 2, batches: list[int] | None = None, **options) -> str:
    """df as the newest version of the table, or as a part with these batches; its folder is returned. Of whole versions ``keep`` stay.

    Of two writers at once the one with the higher number wins, whole. What is older than the versions that are kept goes, unfinished
    folders too.
    """
    spark = df.sparkSession
    before = listed(spark, path)
    if batches is not None and not any(mark == MARK for _, mark in before):
        raise FileNotFoundError(f"{path}: no whole version to write batches over")
    number = int(NAME.fullmatch(before[-1][0])[1]) + 1 if before else 1
    folder = f"{path}/v{number:08}-{uuid.uuid4().hex[:8]}"
    df.write.options(compression="zstd", **options).parquet(folder)
    if batches is not None:
        create(spark, f"{folder}/{BATCHES}", json.dumps(sorted(set(batches))))
    create(spark, f"{folder}/{MARK if batches is None else PART}")
    kept = [n for n, mark in listed(spark, path) if mark == MARK][-max(1, keep) :]
    for n, _ in before:
        if n < kept[0]:
            fs, p = hadoop(spark, f"{path}/{n}")
            fs.delete(p, True)
    return folder
