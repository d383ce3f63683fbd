"""Joins of meshes that hold the same points, and the checks that they do."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalars import rounded_key
from ..sources.shared import materialise


class MeshError(ValueError):
    """Two meshes that should be one are not."""


def keyed(points: DataFrame, digits: int) -> DataFrame:
    lat, lon = rounded_key(F.col("lat"), F.col("lon"), digits=digits)
    return points.withColumn("k_lat", lat).withColumn("k_lon", lon)


def duplicate_keys(points: DataFrame, digits: int = 6) -> DataFrame:
    """(k_lat, k_lon, n) of rounded coordinates that repeat."""
    return keyed(points, digits).groupBy("k_lat", "k_lon").agg(F.count("*").alias("n")).where("n > 1")


def matched(queries: DataFrame, points: DataFrame, key: str, index: str, digits: int = 6) -> DataFrame:
    """(key, index, d_lat, d_lon) of points with the query's rounded coordinates."""
    q = keyed(queries, digits).select(key, F.col("lat").alias("q_lat"), F.col("lon").alias("q_lon"), "k_lat", "k_lon")
    p = keyed(points, digits).select(F.col(index), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), "k_lat", "k_lon")
    return q.join(p, ["k_lat", "k_lon"]).select(key, index, F.abs(F.col("q_lat") - F.col("p_lat")).alias("d_lat"), F.abs(F.col("q_lon") - F.col("p_lon")).alias("d_lon"))


def unmatched(queries: DataFrame, points: DataFrame, digits: int = 6) -> DataFrame:
    return keyed(queries, digits).join(keyed(points, digits).select("k_lat", "k_lon"), ["k_lat", "k_lon"], "left_anti").drop("k_lat", "k_lon")


def beyond(pairs: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    return pairs.where((F.col("d_lat") > tolerance) | (F.col("d_lon") > tolerance))


def same_mesh_join(queries: DataFrame, points: DataFrame, key: str, index: str, digits: int = 6, tolerance: float = 1e-6) -> DataFrame:
    """(key, index): each query's point. MeshError for repeated keys, queries without a point and pairs beyond the tolerance.

    One join does it all: how often keys repeat, how many queries have no point and how far pairs lie apart are observed while its result
    is written, and the errors raised from them. The result is read back, so nothing is joined again.
    """
    here, there = Observation(), Observation()
    # keys that repeat are counted where points are grouped, whether a query meets them or not
    places = keyed(points, digits).groupBy("k_lat", "k_lon").agg(F.count("*").alias("n"), F.min(F.struct(F.col(index).alias("i"), "lat", "lon")).alias("p"))
    places = places.observe(here, F.count_if(F.col("n") > 1).alias("repeated"))
    q = keyed(queries, digits).select(F.col(key), F.col("lat").alias("q_lat"), F.col("lon").alias("q_lon"), "k_lat", "k_lon")
    pairs = q.join(places, ["k_lat", "k_lon"], "left")
    apart = (F.abs(F.col("q_lat") - F.col("p.lat")) > tolerance) | (F.abs(F.col("q_lon") - F.col("p.lon")) > tolerance)
    pairs = pairs.observe(there, F.count_if(F.col("p").isNull()).alias("alone"), F.count_if(apart).alias("apart"))
    out = materialise(pairs.select(key, F.col("p.i").alias(index)), "same-mesh")
    if here.get.get("repeated"):
        raise MeshError("points repeat at the rounded coordinates")
    if there.get.get("alone"):
        raise MeshError("queries without a point at their rounded coordinates")
    if there.get.get("apart"):
        raise MeshError(f"matched points differ by more than {tolerance}")
    return out


def sizes(**meshes: DataFrame) -> DataFrame:
    """(mesh, n), a row for each mesh."""
    out = None
    for name, df in meshes.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("mesh"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def max_difference(a: DataFrame, b: DataFrame, index: str) -> DataFrame:
    """(max_d_lat, max_d_lon) over points of equal index."""
    b = b.select(index, F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"))
    return a.join(b, index).agg(F.max(F.abs(F.col("lat") - F.col("b_lat"))).alias("max_d_lat"), F.max(F.abs(F.col("lon") - F.col("b_lon"))).alias("max_d_lon"))


def same_index(cells: DataFrame, restart: DataFrame, forcing: DataFrame, cell: str = "cell_idx", tolerance: float = 1e-6, chosen: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """cells with restart_idx and forcing_idx equal to the cell's index, and warnings. Meshes of other sizes or a restart mesh elsewhere are errors; a forcing mesh elsewhere is a warning. Places are compared for the chosen cells (all by default)."""
    n = {r.mesh: r.n for r in sizes(cells=cells, restart=restart, forcing=forcing).collect()}
    if len(set(n.values())) > 1:
        raise MeshError(f"mesh sizes differ: {n}")
    warnings = []
    for name, mesh, idx in (("restart", restart, "restart_idx"), ("forcing", forcing, "forcing_idx")):
        d = max(x or 0.0 for x in max_difference(cells if chosen is None else chosen, mesh.withColumnRenamed(idx, cell), cell).first())
        if d > tolerance:
            if name == "restart":
                raise MeshError(f"the restart mesh is off by {d}")
            warnings.append(f"the {name} mesh is off by {d}")
    return cells.withColumn("restart_idx", F.col(cell)).withColumn("forcing_idx", F.col(cell)), warnings


def with_reference_coordinates(points: DataFrame, reference: DataFrame, index: str) -> tuple[DataFrame, list[str]]:
    """points with the reference's coordinates where both have as many; else as they are, and a warning."""
    n, m = points.count(), reference.count()
    if n != m:
        return points, [f"the reference mesh has {m} points, not {n}: coordinates are kept"]
    return points.drop("lat", "lon").join(reference.select(index, "lat", "lon"), index), []
