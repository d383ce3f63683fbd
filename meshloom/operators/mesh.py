"""Cell selection, numbering and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import batch_id, dense_row_id


def in_box(lat_min: float, lat_max: float, lon_min: float, lon_max: float, lat: str = "lat", lon: str = "lon") -> Column:
    """Inclusive on all sides; longitudes are compared as they stand."""
    return F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max)


def select_cells(grid: DataFrame, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> DataFrame:
    """Land cells in the box; both conditions reach the scan."""
    return grid.where(in_box(lat_min, lat_max, lon_min, lon_max)).where("mask = 1")


def index_cells(cells: DataFrame, batch_size: int, order: tuple[str, ...] = ("lat_idx", "lon_idx")) -> DataFrame:
    """cells with __row_id, dense from 0 in mesh order, and batch_id from 1."""
    out = dense_row_id(cells, list(order))
    return out.withColumn("batch_id", batch_id("__row_id", batch_size))


def batches(index: DataFrame) -> DataFrame:
    return index.select("batch_id").distinct().orderBy("batch_id")


def index_summary(index: DataFrame) -> DataFrame:
    return index.agg(F.count("*").alias("rows"), F.max("batch_id").alias("batches"))


def unravel(flat: Column, n_lon: int) -> tuple[Column, Column]:
    """The two indices of a flat, row-major one."""
    return F.floor(flat / F.lit(n_lon)).cast("long"), (flat % F.lit(n_lon)).cast("long")


def coordinate_range(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Extremes of both coordinates, NaN left out."""
    from ..functions.scalars import no_nan

    return df.agg(*[f(no_nan(F.col(c))).alias(f"{name}_{c}") for c in (lat, lon) for name, f in (("min", F.min), ("max", F.max))])
