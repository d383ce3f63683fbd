"""The tables of a source file: of a NetCDF file, or of the folder of Parquet tables that it was converted to.

A source has tables by kind: ``mesh`` (cells or points with coordinates), ``cells`` (values of cells), ``layers`` (values of cells and
levels), ``history`` (values of cells and steps), ``series`` (one array a cell), ``pfts`` and ``columns`` (ragged groups by gridcell_id),
``parameters`` (name, vals). A folder holds a table of each kind that it has, named so; a folder that is itself a table has one kind.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import netcdf, tables


def parquet_table(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """path/kind, or path where it is a table; None if there is neither."""
    for p in (f"{path}/{kind}", path):
        try:
            return spark.read.parquet(p)
        except AnalysisException:
            continue
    return None


class NetCDFFile:
    """The tables of one file; which dimensions a variable has is read from the header."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        netcdf.register(spark)
        self.shapes = netcdf.shapes(path)

    def rank(self, variable: str) -> int:
        if variable not in self.shapes:
            raise KeyError(f"{variable} is not in {self.path}")
        return len(self.shapes[variable][0])

    def has(self, *variables: str) -> bool:
        return all(v in self.shapes for v in variables)

    def timed(self, variable: str) -> bool:
        return self.shapes[variable][0][0].lower() == "time"

    def read(self, variables: list[str], dims: list[str], first: bool = False) -> DataFrame:
        """Variables of the same dimensions, named here, the first one left out where only its first step is wanted."""
        reader = self.spark.read.format("netcdf").option("path", self.path).option("variables", ",".join(variables)).option("dims", ",".join(["first", *dims] if first else dims))
        return (reader.option("first", "true") if first else reader).load()

    def of_cells(self, variables: list[str], before: list[str], first: bool = False) -> DataFrame:
        """Variables over cells, after the dimensions ``before``; a variable may be over (lat, lon) or over cells, which then count for both."""
        out = None
        for rank in (1, 2):
            some = [v for v in variables if self.rank(v) == rank + len(before) + first]
            if some:
                dims = ["lat", "lon"] if rank == 2 else ["cell"]
                one = self.read(some, [*before, *dims], first)
                one = one if rank == 2 else one.withColumn("lat_idx", F.col("cell_idx")).withColumnRenamed("cell_idx", "lon_idx")
                out = one if out is None else out.join(one, [*(f"{d}_idx" for d in before), "lat_idx", "lon_idx"])
        if out is None or (missing := [v for v in variables if v not in out.columns]):
            raise ValueError(f"{variables if out is None else missing}: other dimensions than {before} and cells")
        return out

    def mesh(self) -> DataFrame:
        """The cells of a domain, the points of a restart file, or those of a forcing file."""
        if self.has("grid1d_lat", "grid1d_lon"):
            return self.read(["grid1d_lat", "grid1d_lon"], ["restart"]).withColumnsRenamed({"grid1d_lat": "lat", "grid1d_lon": "lon"})
        if self.has("lat", "lon", "landmask"):
            if self.rank("landmask") == 1:
                return self.read(["lat", "lon", "landmask"], ["cell"])
            return tables.structured_grid(self.read(["lat"], ["lat"]), self.read(["lon"], ["lon"]), self.read(["landmask"], ["lat", "lon"]))
        land = next((v for v in ("PFTDATA_MASK", "LANDFRAC_PFT") if self.has(v)), None)
        if self.has("LATIXY", "LONGXY") and land:
            cells = self.of_cells(["LATIXY", "LONGXY", land], [])
            if self.rank("LATIXY") != 2:
                return cells
            # a structured mesh: the first column and the first row are its axes
            lats, lons = cells.where("lon_idx = 0").select("lat_idx", F.col("LATIXY").alias("lat")), cells.where("lat_idx = 0").select("lon_idx", F.col("LONGXY").alias("lon"))
            return cells.select("lat_idx", "lon_idx", land).join(lats, "lat_idx").join(lons, "lon_idx").select("lat_idx", "lon_idx", F.col("lat").alias("LATIXY"), F.col("lon").alias("LONGXY"), land)
        return self.forcing_mesh()

    def forcing_mesh(self) -> DataFrame:
        """(forcing_idx, lat, lon) of a forcing file's cells, the first step only."""
        lat, lon = ("LATIXY", "LONGXY") if self.has("LATIXY", "LONGXY") else ("lat", "lon")
        first = self.timed(lat)
        rank = self.rank(lat) - first
        if rank == 1:
            axis = lambda v, name: self.read([v], ["i"], first).select(F.col("i_idx").alias("i"), F.col(v).alias(name))
            return tables.forcing_coordinates(axis(lat, "lat"), axis(lon, "lon"))
        if rank != 2:
            raise ValueError(f"coordinates of {rank} dimensions in {self.path}")
        n = self.shapes[lon][1][-1]
        return self.read([lat, lon], ["lat", "lon"], first).select((F.col("lat_idx") * n + F.col("lon_idx")).alias("forcing_idx"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))

    def flat_cells(self) -> DataFrame:
        """(cell, lat, lon): coordinates as they lie in the file, the first step only, never crossed."""
        lat, lon = ("LATIXY", "LONGXY") if self.has("LATIXY", "LONGXY") else ("lat", "lon")
        first = self.timed(lat)
        if self.rank(lat) - first == 1:
            return tables.flat_coordinates(self.read([lat, lon], ["cell"], first).withColumnsRenamed({"cell_idx": "cell", lat: "lat", lon: "lon"}))
        return self.forcing_mesh().withColumnRenamed("forcing_idx", "cell")

    def series_blocks(self, variable: str, length: int = netcdf.LENGTH) -> DataFrame:
        """(forcing_idx, first, variable) of a variable over time and cells, in either order, or over time, lat and lon: a row for each cell
        and block of so many steps, with the number of its first step and the array of its values. No sample is a row of its own."""
        dims, sizes = self.shapes[variable]
        order = ["time", "lat", "lon"] if len(dims) == 3 else ["time", "cell"] if self.timed(variable) else ["cell", "time"]
        cell = F.col("lat_idx") * sizes[-1] + F.col("lon_idx") if len(dims) == 3 else F.col("cell_idx")
        reader = self.spark.read.format("netcdf").option("path", self.path).option("variables", variable).option("dims", ",".join(order))
        blocks = reader.option("along", "time").option("length", length).load()
        return blocks.select(cell.alias("forcing_idx"), F.col("time_first").alias("first"), F.col(variable))

    def axes(self) -> tuple[DataFrame, DataFrame]:
        """(lat_idx, lat) and (lon_idx, lon) of a rectilinear file."""
        return self.read(["lat"], ["lat"]), self.read(["lon"], ["lon"])

    def grid_blocks(self, variable: str, length: int = netcdf.LENGTH) -> DataFrame:
        """(lat_idx, lon_idx, first, variable): blocks of a variable over time, lat and lon, as 4-byte floats; other dimensions are an error."""
        if variable not in self.shapes:
            raise KeyError(f"{variable} is not in {self.path}")
        if self.shapes[variable][0] != ("time", "lat", "lon"):
            raise ValueError(f"{variable} has the dimensions {self.shapes[variable][0]}, not time, lat and lon")
        reader = self.spark.read.format("netcdf").option("path", self.path).option("variables", variable).option("dims", "time,lat,lon")
        blocks = reader.option("along", "time").option("length", length).load()
        return blocks.select("lat_idx", "lon_idx", F.col("time_first").alias("first"), F.col(variable).cast("array<float>").alias(variable))

    def groups(self, index: str | None, flat: list[str], layered: list[str]) -> DataFrame:
        """(pos, gridcell_id, variables) in file order, without an index no gridcell_id; a layered variable is an array over its levels."""
        if not index and not flat:
            out = self.read(layered[:1], ["pos", "level"]).select(F.col("pos_idx").alias("pos")).distinct()
        else:
            out = self.read([index, *flat] if index else flat, ["p"]).withColumnRenamed("p_idx", "pos")
        if index:
            out = out.withColumn(index, F.col(index).cast("long")).withColumnRenamed(index, "gridcell_id")
        for v in layered:
            long = self.read([v], ["pos", "level"]).withColumnRenamed("pos_idx", "pos")
            levels = F.array_sort(F.collect_list(F.struct(F.col("level_idx").alias("p"), F.col(v).alias("v"))))
            out = out.join(long.groupBy("pos").agg(F.transform(levels, lambda x: x["v"]).alias(v)), "pos", "left")
        return out

    def parameters(self, wanted: list[str]) -> DataFrame | None:
        """(name, vals) of the wanted variables that are there and have one dimension."""
        out = None
        for v in wanted:
            if self.has(v) and self.rank(v) == 1:
                packed = F.array_sort(F.collect_list(F.struct("p_idx", F.col(v).alias("v"))))
                one = self.read([v], ["p"]).agg(F.transform(packed, lambda x: x["v"]).alias("vals")).select(F.lit(v).alias("name"), "vals")
                out = one if out is None else out.unionByName(one)
        return out


def monthly_steps(spark: SparkSession, paths: list[str], variable: str) -> DataFrame:
    """(path, time_idx, cell, value) of files of one form, a task for each."""
    form = NetCDFFile(spark, paths[0])
    dims, sizes = form.shapes[variable]
    names = ["time", "lat", "lon"] if len(dims) == 3 else ["time", "cell"]
    steps = spark.read.format("netcdf").option("files", json.dumps(paths)).option("variables", variable).option("dims", ",".join(names)).load()
    cell = F.col("cell_idx") if len(dims) == 2 else F.col("lat_idx") * sizes[-1] + F.col("lon_idx")
    return steps.select("path", F.col("time_idx").cast("int").alias("time_idx"), cell.alias("cell"), F.col(variable).alias("value"))
