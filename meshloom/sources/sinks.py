"""Artifacts, manifests and final datasets on disk."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions
from .shared import discard, materialise


#: bytes of a file of many batches, and of a row group in it
FILE, GROUP = 256 << 20, 32 << 20


def dealt(staged: DataFrame, size: int = FILE) -> DataFrame:
    """A written table with a batch_id, its rows dealt to files of about ``size`` bytes by ranges of batches and sorted in each.

    A file's rows, and each of its row groups, are a run of batches, so a batch is found by the statistics in the footers. Batches have
    the same number of rows, so ranges of equal length are of like size; rows without a batch_id lie in the first file.
    """
    spark = staged.sparkSession
    batches = staged.agg(F.min("batch_id").alias("low"), F.max("batch_id").alias("high")).first()
    if batches.low is None:
        return staged.coalesce(1)
    size_now = sum(fs.getFileStatus(p).getLen() for fs, p in (versions.hadoop(spark, f) for f in staged.inputFiles()))
    n = batches.high - batches.low + 1
    files = max(1, min(n, -(-size_now // size)))
    span = -(-n // files)
    place = F.coalesce(F.expr(f"(batch_id - {batches.low}) div {span}"), F.lit(0)).cast("int")
    return staged.repartitionById(-(-n // span), place).sortWithinPartitions("batch_id", "__row_id")


def write_artifact(df: DataFrame, root: str, module: str, batches: list[int] | None = None, size: int = FILE) -> str:
    """A module's rows (__row_id, batch_id, ..) as a new version, in files of many batches; its folder is returned.

    With batches only these are written anew, as a part over the version before, whose files stay as they are. A job that is killed
    half-way leaves the artifact as it was. Rows are written once as they come, so that they are made once and their size is known.
    """
    spark, path = df.sparkSession, f"{root}/{module}"
    if batches is not None:
        df = df.where(F.col("batch_id").isin(batches))
    staged = materialise(df, "artifact")
    out = versions.write(dealt(staged, size), path, batches=batches, **{"parquet.block.size": str(GROUP)})
    discard(staged)
    if len(versions.layers(spark, path)) > versions.PARTS + 1:
        staged = materialise(versions.read(spark, path), "artifact")
        out = versions.write(dealt(staged, size), path, **{"parquet.block.size": str(GROUP)})
        discard(staged)
    return out


def write_final(df: DataFrame, path: str, overwrite: bool = False, size: int = FILE) -> str:
    """In files of many batches, as artifacts are; an existing dataset is an error unless overwrite is set."""
    spark = df.sparkSession
    if not overwrite and versions.has(spark, path):
        raise FileExistsError(f"{path} exists")
    staged = materialise(df, "final")
    dealt(staged, size).write.mode("overwrite" if overwrite else "errorifexists").options(compression="zstd", **{"parquet.block.size": str(GROUP)}).parquet(path)
    discard(staged)
    return path


def write_forcing(series: DataFrame, path: str, start: int, end: int) -> str:
    """A consolidated forcing table (gridcell, lat, lon, series) with 4-byte floats at rest: a new version of it, whose folder is returned."""
    out = series.select(F.col("gridcell").cast("int"), F.col("lat").cast("double"), F.col("lon").cast("double"), F.col("series").cast("array<float>"), F.lit(start).alias("start_year"), F.lit(end).alias("end_year"))
    return versions.write(out, path)


def source_entry(spark: SparkSession, path: str) -> dict:
    """Path, newest change and size of a source, over all its files."""
    from .tables import file_stats

    row = file_stats(spark, path).agg(F.max("mtime").alias("mtime"), F.sum("size").alias("size")).first()
    return {"path": path, "mtime": row.mtime.timestamp() if row.mtime else None, "size": row["size"]}


def write_manifest(spark: SparkSession, root: str, module: str, sources: list[dict], **facts) -> dict:
    manifest = {"module": module, "created": datetime.now(timezone.utc).isoformat(timespec="seconds"), "sources": sources, **facts}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{module}")
    return manifest


def read_manifest(spark: SparkSession, root: str, module: str) -> dict | None:
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.text(f"{root}/{module}").first()
    except AnalysisException:
        return None
    return json.loads(row.value) if row else None


def is_current(spark: SparkSession, root: str, module: str, sources: list[dict], **facts) -> bool:
    """True if the module was made from these sources as they are now, with these facts (settings, the index it builds on)."""
    old = read_manifest(spark, root, module)
    return old is not None and old["sources"] == sources and all(k in old and old[k] == v for k, v in json.loads(json.dumps(facts)).items())


def source_lines(spark: SparkSession, paths: dict[str, str], wanted: tuple[str, ...] = ()) -> list[str]:
    """A line for each source with its newest change and its size, and its first columns where it is a table.

    Of a NetCDF file its dimensions and the wanted variables instead, in lines of their own kind.
    """
    from . import netcdf
    from .files import parquet_table
    from .tables import header

    out = []
    for name, path in sorted(paths.items()):
        x = source_entry(spark, path)
        out.append(f"source {name}: {path}, changed {x['mtime']}, {x['size']} bytes")
        if path.endswith(".nc"):
            out += [f"header {name}: {line}" for line in netcdf.header(path, wanted)]
            continue
        df = parquet_table(spark, path, "mesh")
        out += [f"source {name}: {line}" for line in header(df)] if df is not None else []
    return out


def write_record(spark: SparkSession, root: str, lines: list[str]) -> str:
    """The record of one run, in a folder of its own."""
    path = f"{root}/records/{datetime.now(timezone.utc).strftime('%Y%m%dT%H%M%S%f')}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def write_log(spark: SparkSession, root: str, lines: list[str]) -> None:
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{root}/log")
