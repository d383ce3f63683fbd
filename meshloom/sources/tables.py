"""Meshes, artifacts and file listings as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions

# Variable to the names it may have in a source, best first.
ALIASES = {"PSRF": ("PSRF", "PBOT"), "PRECTmms": ("PRECTmms", "PRECmms")}


def structured_grid(lats: DataFrame, lons: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """Axes (lat_idx, lat) and (lon_idx, lon), and a mask (lat_idx, lon_idx, mask), to one row a cell. Axes are short; cells are not collected."""
    grid = lats.crossJoin(F.broadcast(lons)) if axis_is_small(lons) else lats.crossJoin(lons)
    return grid.join(mask, ["lat_idx", "lon_idx"]) if mask is not None else grid


def axis_is_small(axis: DataFrame, most: int = 1_000_000) -> bool:
    return axis.limit(most + 1).count() <= most


def domain_grid(df: DataFrame) -> DataFrame:
    """A mesh table of either style to (lat_idx, lon_idx, lat, lon, mask); cells of a 1-D mesh have one index for both."""
    names = set(df.columns)
    index = [F.col("lat_idx"), F.col("lon_idx")] if {"lat_idx", "lon_idx"} <= names else [F.col("cell_idx").alias("lat_idx"), F.col("cell_idx").alias("lon_idx")]
    if {"lat", "lon", "landmask"} <= names:
        return df.select(*index, "lat", "lon", (F.col("landmask") == 1).cast("int").alias("mask"))  # land is 1 exactly
    if {"LATIXY", "LONGXY"} <= names:
        land = next((c for c in ("PFTDATA_MASK", "LANDFRAC_PFT") if c in names), None)
        if land:
            return df.select(*index, F.col("LATIXY").alias("lat"), F.col("LONGXY").alias("lon"), (F.col(land) > 0).cast("int").alias("mask"))
    raise KeyError(f"no mesh among {sorted(names)}")


def first_step(df: DataFrame) -> DataFrame:
    """Coordinates may have a time dimension; its first step is used, as a filter that reaches the scan."""
    return df.where("time_idx = 0").drop("time_idx") if "time_idx" in df.columns else df


def forcing_coordinates(lats: DataFrame, lons: DataFrame) -> DataFrame:
    """(forcing_idx, lat, lon) from 1-D coordinates (i, lat) and (i, lon): of unequal sizes they are axes, lat-major; of equal sizes, points."""
    lats, lons = first_step(lats), first_step(lons)
    n_lat, n_lon = lats.count(), lons.count()
    if n_lat == n_lon:
        return lats.join(lons, "i").select(F.col("i").alias("forcing_idx"), "lat", "lon")
    return lats.withColumnRenamed("i", "a").crossJoin(lons.withColumnRenamed("i", "b")).select((F.col("a") * n_lon + F.col("b")).alias("forcing_idx"), "lat", "lon")


def flat_coordinates(df: DataFrame) -> DataFrame:
    """(cell, lat, lon): coordinates flattened as they stand, first step only, never crossed."""
    return first_step(df).select(F.col("cell"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))


def resolve(df: DataFrame | Iterable[str], variable: str, aliases: dict[str, tuple[str, ...]] = ALIASES) -> str:
    """The column that holds the variable: the first of its names that df (or a list of names) has."""
    there = df.columns if isinstance(df, DataFrame) else list(df)
    for name in aliases.get(variable, (variable,)):
        if name in there:
            return name
    raise KeyError(f"{variable} is not among {sorted(there)}")


def present(df: DataFrame, variables: list[str], strict: bool) -> list[str]:
    """The variables that df has; strict: all must be there."""
    missing = [v for v in variables if v not in df.columns]
    if missing and strict:
        raise KeyError(f"{missing} not among {sorted(df.columns)}")
    return [v for v in variables if v in df.columns]


def artifact(spark: SparkSession, root: str, module: str, batch: int | None = None) -> DataFrame:
    """A module's rows, or one batch of them (of the files that may hold it, the row groups that do); FileNotFoundError where there are none.

    Of a table kept in versions, the newest complete one, with the batches that were written over it.
    """
    try:
        df = versions.read(spark, f"{root}/{module}", batch)
        df = spark.read.parquet(f"{root}/{module}") if df is None else df
    except AnalysisException as e:
        raise FileNotFoundError(f"{root}/{module}") from e
    if batch is None:
        return df
    df = df.where(F.col("batch_id") == batch)
    if df.isEmpty():
        raise FileNotFoundError(f"{root}/{module}: no batch {batch}")
    return df


def artifact_or_none(spark: SparkSession, root: str, module: str, batch: int | None = None) -> DataFrame | None:
    try:
        return artifact(spark, root, module, batch)
    except FileNotFoundError:
        return None


def final_dataset(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    df = spark.read.option("pathGlobFilter", pattern).parquet(root)
    if df.isEmpty():
        raise FileNotFoundError(f"{root}/{pattern}")
    return df


def file_stats(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, mtime, size) of files; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))


def header(df: DataFrame, most: int = 10) -> list[str]:
    """Names and types of a source's first columns, for the run log."""
    return [f"{n}: {t}" for n, t in df.dtypes[:most]]
