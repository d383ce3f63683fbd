"""Each operator as a query over the driver's tables, with the SQL that it is held against.

The tables hold no meshes, so coordinates are made from keys by integer arithmetic that any engine does alike. Arrays are returned as
rows (key, pos, value).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import scalars
from ..operators import assemble, calendar, gather, mesh, nearest, samemesh, series, validate
from ..operators.numbering import batch_id, dense_row_id
from ..sources import sinks, tables
from ..sources.shared import shared_dir
from ..streaming import monthly
from . import modules, runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def degrees(key: str, a: int, b: int) -> list[Column]:
    """Coordinates in tenths of degrees."""
    return [((F.col(key) * a % 1800).cast("double") / 10 - 90).alias("lat"), ((F.col(key) * b % 3600).cast("double") / 10).alias("lon")]


def degrees_sql(key: str, a: int, b: int) -> str:
    return f"CAST({key} * {a} % 1800 AS DOUBLE) / 10 - 90 AS lat, CAST({key} * {b} % 3600 AS DOUBLE) / 10 AS lon"


def cells(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", *degrees("c_custkey", 37, 91), (F.col("c_nationkey") % 4 != 0).cast("int").alias("mask"))


CELLS = f"cells AS (SELECT c_custkey, c_acctbal, c_nationkey, {degrees_sql('c_custkey', 37, 91)}, CAST(c_nationkey % 4 <> 0 AS INTEGER) AS mask FROM customer)"
BOX = "lat BETWEEN -60 AND 75 AND lon BETWEEN 20 AND 340 AND mask = 1"
INDEX = f"""idx AS (SELECT *, CAST(row_number() OVER (ORDER BY lat, lon, c_custkey) - 1 AS BIGINT) AS __row_id FROM cells WHERE {BOX}),
batched AS (SELECT *, CAST(__row_id // 100 + 1 AS INTEGER) AS batch_id FROM idx)"""


def index(spark, sf_dir) -> DataFrame:
    chosen = mesh.select_cells(cells(spark, sf_dir), -60, 75, 20, 340)
    return mesh.index_cells(chosen, 100, ("lat", "lon", "c_custkey"))


def restart(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("restart_idx"), "s_acctbal", *degrees("s_suppkey", 53, 17))


RESTART = f"restart AS (SELECT s_suppkey AS restart_idx, s_acctbal, {degrees_sql('s_suppkey', 53, 17)} FROM supplier)"


@query(f"WITH {CELLS} SELECT c_custkey, lat, lon FROM cells WHERE {BOX}")
def bbox_mask_filter(spark, sf_dir):
    return mesh.select_cells(cells(spark, sf_dir), -60, 75, 20, 340).select("c_custkey", "lat", "lon")


@query(f"WITH {CELLS}, {INDEX} SELECT __row_id, batch_id, c_custkey, lat, lon FROM batched")
def index_batching(spark, sf_dir):
    return index(spark, sf_dir).select("__row_id", "batch_id", "c_custkey", "lat", "lon")


@query(f"WITH {CELLS}, {INDEX} SELECT DISTINCT batch_id FROM batched")
def batch_ids(spark, sf_dir):
    return mesh.batches(index(spark, sf_dir))


@query(f"WITH {CELLS}, {INDEX} SELECT count(*) AS rows, max(batch_id) AS batches FROM batched")
def index_manifest(spark, sf_dir):
    return mesh.index_summary(index(spark, sf_dir))


@query("SELECT p_partkey, p_partkey // 7 AS i, p_partkey % 7 AS j FROM part")
def flat_index_unravel(spark, sf_dir):
    i, j = mesh.unravel(F.col("p_partkey"), 7)
    return read(spark, sf_dir, "part").select("p_partkey", i.alias("i"), j.alias("j"))


@query("SELECT lat_idx, s_suppkey AS lon_idx, lat_idx * 3.0::DOUBLE - 80 AS lat, s_suppkey * 0.25::DOUBLE AS lon, CAST((lat_idx + s_suppkey) % 3 > 0 AS INTEGER) AS mask FROM (SELECT DISTINCT p_size AS lat_idx FROM part), supplier")
def structured_mesh(spark, sf_dir):
    lats = read(spark, sf_dir, "part").select(F.col("p_size").alias("lat_idx")).distinct().withColumn("lat", F.col("lat_idx") * F.lit(3.0) - 80)
    lons = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("lon_idx"), (F.col("s_suppkey") * F.lit(0.25)).alias("lon"))
    grid = tables.structured_grid(lats, lons)
    return grid.withColumn("mask", ((F.col("lat_idx") + F.col("lon_idx")) % 3 > 0).cast("int")).select("lat_idx", "lon_idx", "lat", "lon", "mask")


@query("SELECT CAST(p_partkey AS BIGINT) AS lat_idx, CAST(p_partkey AS BIGINT) AS lon_idx, CAST(p_partkey * 37 % 1800 AS DOUBLE) / 10 - 90 AS lat, CAST(p_partkey * 91 % 3600 AS DOUBLE) / 10 AS lon, CAST(p_size > 25 AS INTEGER) AS mask FROM part")
def surface_mesh(spark, sf_dir):
    lat, lon = degrees("p_partkey", 37, 91)
    return tables.domain_grid(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell_idx"), lat.alias("LATIXY"), lon.alias("LONGXY"), (F.col("p_size") - 25).alias("LANDFRAC_PFT")))


def nearest_sql(candidates: str, idx: str) -> str:
    return f"""SELECT c_custkey, d2, {idx} AS idx FROM (
  SELECT c_custkey, {idx}, (q.lat - c.lat) * (q.lat - c.lat) + (q.lon - c.lon) * (q.lon - c.lon) AS d2,
    row_number() OVER (PARTITION BY c_custkey ORDER BY (q.lat - c.lat) * (q.lat - c.lat) + (q.lon - c.lon) * (q.lon - c.lon), {idx}) AS n
  FROM cells q, {candidates} c) WHERE n = 1"""


@query(f"WITH {CELLS}, {RESTART} {nearest_sql('restart', 'restart_idx')}")
def nearest_restart(spark, sf_dir):
    return nearest.nearest_join(cells(spark, sf_dir), restart(spark, sf_dir), "c_custkey", "restart_idx")


FORCING_MESH = f"forcing AS (SELECT p_partkey AS forcing_idx, {degrees_sql('p_partkey', 53, 17)} FROM part)"


@query(f"WITH {CELLS}, {FORCING_MESH} {nearest_sql('forcing', 'forcing_idx')}")
def nearest_forcing(spark, sf_dir):
    mesh_ = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("forcing_idx"), *degrees("p_partkey", 53, 17))
    return nearest.nearest_join(cells(spark, sf_dir), mesh_, "c_custkey", "forcing_idx")


@query(f"""WITH {CELLS}, {INDEX}, {RESTART}, near AS ({nearest_sql('restart', 'restart_idx')})
SELECT __row_id, batch_id, lat AS "Latitude", lon AS "Longitude", idx AS nearest_restart_index, idx + 1 AS gridcell_id, round(s_acctbal, 2) AS s_acctbal
FROM batched JOIN near USING (c_custkey) LEFT JOIN (SELECT restart_idx, s_acctbal FROM restart) r ON r.restart_idx = idx""")
def index_master(spark, sf_dir):
    """The flagship: select cells, number them, map them to the nearest restart cell and gather a value there."""
    spine = index(spark, sf_dir)
    near = nearest.nearest_join(spine, restart(spark, sf_dir), "c_custkey", "restart_idx")
    values = restart(spark, sf_dir).select(F.col("restart_idx").alias("idx"), F.round("s_acctbal", 2).alias("s_acctbal"))
    joined = spine.join(near, "c_custkey").join(values, "idx", "left")
    return joined.select("__row_id", "batch_id", F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"), F.col("idx").alias("nearest_restart_index"), (F.col("idx") + 1).alias("gridcell_id"), "s_acctbal")


#: points of one mesh twice, the second time off by less than the tolerance
POINTS = """points AS (SELECT p_partkey AS point, CAST(p_partkey AS DOUBLE) / 8 AS lat, CAST(p_partkey * 3 AS DOUBLE) / 16 AS lon FROM part),
queries AS (SELECT point AS query, lat + 0.00000005 AS lat, lon FROM points WHERE point % 3 > 0)"""


def points(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("point"), (F.col("p_partkey").cast("double") / 8).alias("lat"), ((F.col("p_partkey") * 3).cast("double") / 16).alias("lon"))
    return p, p.where("point % 3 > 0").select(F.col("point").alias("query"), (F.col("lat") + F.lit(0.00000005)).alias("lat"), "lon")


@query(f"WITH {POINTS} SELECT query, point FROM queries q JOIN points p ON round(q.lat, 6) = round(p.lat, 6) AND round(q.lon, 6) = round(p.lon, 6)")
def same_mesh_join(spark, sf_dir):
    p, q = points(spark, sf_dir)
    return samemesh.same_mesh_join(q, p, "query", "point")


@query("SELECT round(p_retailprice, 6) AS k_lat, round(CAST(p_size % 5 AS DOUBLE), 6) AS k_lon, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def same_mesh_duplicates(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.col("p_retailprice").alias("lat"), (F.col("p_size") % 5).cast("double").alias("lon"))
    return samemesh.duplicate_keys(p)


@query(f"WITH {CELLS}, {RESTART} SELECT c_custkey FROM cells q WHERE NOT EXISTS (SELECT 1 FROM restart r WHERE round(q.lat, 6) = round(r.lat, 6) AND round(q.lon, 6) = round(r.lon, 6))")
def same_mesh_unmatched(spark, sf_dir):
    return samemesh.unmatched(cells(spark, sf_dir), restart(spark, sf_dir)).select("c_custkey")


@query(f"WITH {POINTS} SELECT query, point FROM queries q JOIN points p ON round(q.lat, 6) = round(p.lat, 6) AND round(q.lon, 6) = round(p.lon, 6) WHERE abs(q.lat - p.lat) > 0.00000001")
def same_mesh_tolerance(spark, sf_dir):
    p, q = points(spark, sf_dir)
    return samemesh.beyond(samemesh.matched(q, p, "query", "point"), 1e-8).select("query", "point")


@query(f"WITH {CELLS}, {RESTART} SELECT 'cells' AS mesh, count(*) AS n FROM cells UNION ALL SELECT 'restart', count(*) FROM restart")
def mesh_sizes(spark, sf_dir):
    return samemesh.sizes(cells=cells(spark, sf_dir), restart=restart(spark, sf_dir))


@query(f"""WITH {RESTART}, other AS (SELECT s_suppkey AS restart_idx, {degrees_sql('s_suppkey', 54, 17)} FROM supplier)
SELECT max(abs(a.lat - b.lat)) AS max_d_lat, max(abs(a.lon - b.lon)) AS max_d_lon FROM restart a JOIN other b USING (restart_idx)""")
def mesh_max_diff(spark, sf_dir):
    other = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("restart_idx"), *degrees("s_suppkey", 54, 17))
    return samemesh.max_difference(restart(spark, sf_dir), other, "restart_idx")


@query(f"""WITH {CELLS}, axis AS (SELECT CAST(p_partkey AS BIGINT) AS axis_idx, CAST(p_partkey AS DOUBLE) * 7 / 40 - 90 AS a FROM part),
near AS (SELECT c_custkey, axis_idx, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(lat - a), a) AS n FROM cells, axis)
SELECT c_custkey, axis_idx FROM near WHERE n = 1""")
def axis_nearest(spark, sf_dir):
    axis = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("axis_idx"), (F.col("p_partkey").cast("double") * 7 / 40 - 90).alias("value"))
    return nearest.nearest_on_axis(cells(spark, sf_dir).withColumnRenamed("lat", "value"), axis, "c_custkey")


@query(f"""WITH {CELLS}, q AS (SELECT c_custkey, lon - 180 AS lon FROM cells), x AS (SELECT min(lon) AS lo, max(lon) AS hi FROM q), {RESTART}, a AS (SELECT min(lon) AS lo, max(lon) AS hi FROM restart)
SELECT c_custkey, CASE WHEN a.lo >= 0 AND x.lo < 0 THEN CASE WHEN lon < 0 THEN lon + 360 ELSE lon END WHEN a.hi <= 180 AND x.hi > 180 THEN CASE WHEN lon > 180 THEN lon - 360 ELSE lon END ELSE lon END AS lon FROM q, x, a""")
def lon_normalize(spark, sf_dir):
    q = cells(spark, sf_dir).select("c_custkey", (F.col("lon") - 180).alias("lon"))
    return nearest.normalised_longitude(q, restart(spark, sf_dir)).select("c_custkey", "lon")


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]


@query("""SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 END AS pos, l_extendedprice AS value
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def ragged_gather(spark, sf_dir):
    groups = gather.ragged_gather(read(spark, sf_dir, "lineitem"), "l_orderkey", LINE_ORDER, ["l_extendedprice"])
    joined = gather.lookup_groups(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")), groups, "l_orderkey")
    return joined.select(F.col("l_orderkey").alias("o_orderkey"), F.posexplode_outer("l_extendedprice").alias("pos", "value")).select("o_orderkey", F.col("pos").cast("long").alias("pos"), "value")


@query("""WITH p AS (SELECT CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END AS grp, event_id, value FROM events)
SELECT grp, pos, value, pos = 0 AS first FROM (SELECT grp, value, row_number() OVER (PARTITION BY grp ORDER BY event_id) - 1 AS pos FROM p)""")
def ragged_parts(spark, sf_dir):
    """One group holds half of all rows; its parts, one after another, are the group."""
    rows = read(spark, sf_dir, "events").withColumn("grp", F.when(F.col("event_id") % 2 == 0, F.lit(-1).cast("long")).otherwise(F.col("user_id").cast("long")))
    parts = gather.ragged_parts(rows, "grp", "event_id", ["value"], run=512, most=1024)
    sizes = parts.select("grp", "part", F.size("value").alias("n"))
    before = sizes.select("grp", "part", F.sum("n").over(Window.partitionBy("grp").orderBy("part")).alias("upto"), "n")
    out = parts.join(before, ["grp", "part"]).select("grp", (F.col("upto") - F.col("n")).alias("from"), F.posexplode("value").alias("k", "value"))
    pos = F.col("from") + F.col("k")
    return out.select("grp", pos.alias("pos"), "value", (pos == 0).alias("first"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def ragged_semi_ids(spark, sf_dir):
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return gather.only_groups_of(read(spark, sf_dir, "lineitem"), done, "l_orderkey").select("l_orderkey", *LINE_ORDER)


@query("""WITH g AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) - 1 AS pos FROM lineitem)
SELECT l_orderkey, pos, level, CASE level WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END AS value FROM g, (SELECT unnest([0, 1, 2]) AS level)""")
def layered_gather(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumn("levels", F.array("l_quantity", "l_discount", "l_tax"))
    groups = gather.ragged_gather(rows, "l_orderkey", LINE_ORDER, ["levels"])
    outer = groups.select("l_orderkey", F.posexplode("levels").alias("pos", "v"))
    return outer.select("l_orderkey", F.col("pos").cast("long").alias("pos"), F.posexplode("v").alias("level", "value"))


@query("SELECT p_size, p_brand, pos, value FROM (SELECT p_size, p_brand, row_number() OVER (PARTITION BY p_size, p_brand ORDER BY p_partkey) - 1 AS pos, p_retailprice AS value FROM part)")
def layer_vectors(spark, sf_dir):
    out = gather.layers(read(spark, sf_dir, "part"), ["p_size", "p_brand"], "p_partkey", ["p_retailprice"])
    return out.select("p_size", "p_brand", F.posexplode("p_retailprice").alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


@query(f"WITH {CELLS}, {INDEX} SELECT __row_id, n_regionkey FROM batched LEFT JOIN nation ON n_nationkey = c_nationkey")
def positional_lookup(spark, sf_dir):
    values = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", F.lit(0).alias("time_idx"))
    return gather.lookup_scalars(index(spark, sf_dir), values, ["c_nationkey"], ["n_regionkey"]).select("__row_id", "n_regionkey")


def user_series(spark, sf_dir) -> DataFrame:
    return gather.series_from_steps(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value")


STEPS = "steps AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM events)"


@query(f"WITH {STEPS} SELECT user_id, pos, value FROM steps")
def series_extract(spark, sf_dir):
    return user_series(spark, sf_dir).select("user_id", F.posexplode("series").alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


@query(f"WITH {STEPS} SELECT c_custkey, pos, value FROM customer LEFT JOIN steps ON user_id = c_custkey % 200")
def series_lookup(spark, sf_dir):
    cells_ = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 200).alias("at"))
    got = gather.lookup_series(cells_, user_series(spark, sf_dir), "at", "series", "series", "user_id")
    return got.select("c_custkey", F.posexplode_outer("series").alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


@query("SELECT user_id, round(avg(value) FILTER (WHERE event_id % 7 <> 0), 6) AS mean FROM events GROUP BY user_id")
def time_mean_skipna(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 7 == 0, float("nan")).otherwise(F.col("value")))
    return series.time_mean(rows, ["user_id"], "value").select("user_id", F.round("mean", 6).alias("mean"))


@query("""WITH m AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS mean FROM events GROUP BY 1, 2)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY day) - 1 AS pos, round(mean, 6) AS value FROM m""")
def stack_means(spark, sf_dir):
    daily = series.time_mean(read(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date")), ["user_id", "day"], "value")
    out = series.stacked(daily, ["user_id"], "day", "mean")
    return out.select("user_id", F.posexplode("series").alias("pos", "value")).select("user_id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


def means(df: DataFrame, key: str, **settings) -> DataFrame:
    out = df.withColumn("m", series.monthly_means(F.col("series"), **settings))
    return out.select(key, F.posexplode("m").alias("pos", "value")).select(key, F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


MONTH_OF = "CASE WHEN d < 31 THEN 0 WHEN d < 59 THEN 1 WHEN d < 90 THEN 2 WHEN d < 120 THEN 3 WHEN d < 151 THEN 4 WHEN d < 181 THEN 5 WHEN d < 212 THEN 6 WHEN d < 243 THEN 7 WHEN d < 273 THEN 8 WHEN d < 304 THEN 9 WHEN d < 334 THEN 10 ELSE 11 END"


def wrapped(spark, sf_dir, length: int) -> DataFrame:
    """Each user's steps folded to a series of the length: values that meet are averaged, and a shorter series begins again."""
    folded = user_series(spark, sf_dir).select("user_id", F.posexplode("series").alias("pos", "value")).groupBy("user_id", (F.col("pos") % length).alias("pos")).agg(F.avg("value").alias("value"))
    s = gather.series_from_steps(folded, ["user_id"], "pos", "value")
    return s.withColumn("series", F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda d: F.element_at("series", (d % F.size("series") + 1).cast("int"))))


def wrapped_sql(length: int) -> str:
    return f"folded AS (SELECT user_id, pos % {length} AS pos, avg(value) AS value, least(max(n), {length}) AS n FROM steps GROUP BY 1, 2), days AS (SELECT user_id, d, d % n AS pos FROM (SELECT user_id, min(n) AS n FROM folded GROUP BY 1), (SELECT unnest(generate_series(0, {length - 1})) AS d))"


@query(f"""WITH {STEPS}, {wrapped_sql(365)} SELECT user_id, CAST({MONTH_OF} AS BIGINT) AS pos, round(avg(value), 6) AS value FROM days JOIN folded USING (user_id, pos) GROUP BY 1, 2""")
def monthly_avg(spark, sf_dir):
    return means(wrapped(spark, sf_dir, 365), "user_id", length=365, steps_per_day=1, years=1)


@query(f"WITH {STEPS} SELECT user_id, pos, round(value, 6) AS value FROM steps WHERE n % 12 = 0")
def monthly_avg_passthrough(spark, sf_dir):
    return means(user_series(spark, sf_dir), "user_id", length=365, steps_per_day=1, years=1)


@query(f"""WITH {STEPS}, {wrapped_sql(100)},
m AS (SELECT user_id, CAST({MONTH_OF} AS BIGINT) AS month, avg(value) AS value FROM days JOIN folded USING (user_id, pos) GROUP BY 1, 2)
SELECT u.user_id, u.month AS pos, round(value, 6) AS value FROM (SELECT DISTINCT user_id, unnest(generate_series(0, 11)) AS month FROM steps) u LEFT JOIN m USING (user_id, month)""")
def monthly_avg_overrun(spark, sf_dir):
    """A series that ends in April: the months after are NaN, returned as NULL."""
    out = means(wrapped(spark, sf_dir, 100), "user_id", length=100, steps_per_day=1, years=1)
    return out.withColumn("value", scalars.no_nan(F.col("value")))


BLOCK = 48


@query("SELECT event_id % 20 AS cell, event_id // 20 AS pos, value FROM events")
def series_blocks(spark, sf_dir):
    """Steps of a flat (time, cell) layout to blocks, and blocks to series: what is shuffled last is a row a block."""
    steps = read(spark, sf_dir, "events").select((F.col("event_id") % 20).alias("cell"), F.floor(F.col("event_id") / 20).alias("step"), "value")
    out = gather.series_from_blocks(gather.blocks_from_steps(steps, ["cell"], "step", "value", BLOCK), ["cell"], "first", "values")
    return out.select("cell", F.posexplode("series").alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


def wrapped_blocks(spark, sf_dir, length: int) -> DataFrame:
    days = wrapped(spark, sf_dir, length).select("user_id", F.posexplode("series").alias("step", "value"))
    return gather.blocks_from_steps(days, ["user_id"], "step", "value", BLOCK)


def block_means(blocks: DataFrame, **settings) -> DataFrame:
    out = series.block_means(blocks, ["user_id"], "first", "values", steps_per_day=1, years=1, **settings)
    return out.select("user_id", F.posexplode("series").alias("pos", "value")).select("user_id", F.col("pos").cast("long").alias("pos"), F.round(scalars.no_nan(F.col("value")), 6).alias("value"))


@query(ORACLE_SQL["monthly_avg"])
def monthly_avg_blocks(spark, sf_dir):
    """Sums and counts of the blocks' shares of months: no array is longer than a block."""
    return block_means(wrapped_blocks(spark, sf_dir, 365), length=365)


@query(ORACLE_SQL["monthly_avg_overrun"])
def monthly_avg_blocks_overrun(spark, sf_dir):
    return block_means(wrapped_blocks(spark, sf_dir, 100), length=100)


@query(ORACLE_SQL["monthly_avg_passthrough"])
def monthly_avg_blocks_passthrough(spark, sf_dir):
    steps = user_series(spark, sf_dir).select("user_id", F.posexplode("series").alias("step", "value"))
    return block_means(gather.blocks_from_steps(steps, ["user_id"], "step", "value", BLOCK), length=365)


@query("""WITH p AS (SELECT p_brand AS name, list(p_retailprice ORDER BY p_partkey)[1:17] AS vals, min(p_size) AS least FROM part GROUP BY 1)
SELECT name, generate_subscripts(vals, 1) - 1 AS pos, unnest(vals) AS value FROM p WHERE least > 0""")
def param_valid_filter(spark, sf_dir):
    return parameters(spark, sf_dir).select("name", F.posexplode("vals").alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


def parameters(spark, sf_dir) -> DataFrame:
    raw = gather.ragged_gather(read(spark, sf_dir, "part").withColumnRenamed("p_brand", "name"), "name", "p_partkey", ["p_retailprice"]).withColumnRenamed("p_retailprice", "vals")
    return gather.valid_parameters(raw)


@query("""WITH p AS (SELECT list(p_retailprice ORDER BY p_partkey)[1:17] AS vals FROM part WHERE p_brand = 'Brand#11')
SELECT c_custkey, generate_subscripts(vals, 1) - 1 AS pos, unnest(vals) AS value FROM customer, p""")
def param_broadcast(spark, sf_dir):
    out = gather.with_parameters(read(spark, sf_dir, "customer").select("c_custkey"), parameters(spark, sf_dir), ["Brand#11", "no such"])
    return out.select("c_custkey", F.posexplode("pft_Brand#11").alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


@query("""SELECT o_orderkey AS __row_id, o_totalprice, c_name, lines, quantity FROM orders LEFT JOIN (SELECT c_custkey, c_name FROM customer) ON c_custkey = o_custkey
LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def assemble_left(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    spine = orders.select(F.col("o_orderkey").alias("__row_id"), "o_totalprice")
    names = orders.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("__row_id"), "c_name")
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("__row_id")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    return assemble.left_joined(spine, [names, lines])


#: numbers and other text
TEXTS = ("concat(' ', k, ' ')", "concat(k, 'd')", "concat(k, 'e1')", "concat('[', k, ']')", "''", "concat('-', k, '.5')", "concat(k, '_0')", "'None'")


@query("WITH t AS (SELECT event_id, CAST(event_id % 50 AS VARCHAR) AS k FROM events), x AS (" + " UNION ALL ".join(f"SELECT event_id, {i} AS kind, {t} AS v FROM t" for i, t in enumerate(TEXTS)) + r") SELECT event_id, kind, CASE WHEN regexp_matches(trim(v), '^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST(trim(v) AS DOUBLE) END AS value FROM x")
def coerce_numeric(spark, sf_dir):
    t = read(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 50).cast("string").alias("k"))
    x = t.select("event_id", F.posexplode(F.array(*[F.expr(t) for t in TEXTS])).alias("kind", "GPP"))
    return assemble.coerced(x).select("event_id", "kind", F.col("GPP").alias("value"))


#: elements of an embedding
WIDTH = 64


@query("SELECT vec_id, " + ", ".join(f"coalesce(CAST(CASE WHEN vec_id % 9 > 0 AND (vec_id + {i}) % 7 > 0 THEN embedding[{i + 1}] END AS DOUBLE), 0) AS e_{i}" for i in range(WIDTH)) + " FROM embeddings")
def expand_array(spark, sf_dir):
    """Whole embeddings, with arrays and elements that are missing or NaN."""
    holed = F.transform("embedding", lambda x, i: F.when((F.col("vec_id") + i) % 14 == 0, F.lit(None)).when((F.col("vec_id") + i) % 7 == 0, float("nan")).otherwise(x))
    return assemble.expanded(read(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 9 > 0, holed).alias("e")), ["e"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS \"PSRF\" FROM lineitem")
def alias_resolve(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_extendedprice", "PBOT")
    return rows.select("l_orderkey", *LINE_ORDER, F.col(tables.resolve(rows, "PSRF")).alias("PSRF"))


@query('SELECT c_custkey, c_acctbal AS "X_b", c_nationkey AS "Y_a", c_name AS "Y_c" FROM customer')
def column_order(spark, sf_dir):
    df = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("a"), F.col("c_acctbal").alias("X_b"), F.col("c_name").alias("c"))
    return assemble.targets_last(assemble.prefixed(df, ["a", "c"], "Y_"))


FILES = """paths AS (SELECT DISTINCT concat('/f/', o_orderpriority, '/', x, 'clmforc.v1.', CASE WHEN (year(o_orderdate) * 12 + month(o_orderdate)) % 7 = 3 THEN 'Solr' ELSE 'TPQWL' END, '.', strftime(o_orderdate, '%Y-%m'), '.nc') AS path
FROM orders, (SELECT unnest(['a_', '']) AS x)),
files AS (SELECT path, CAST(substr(path, length(path) - 9, 4) AS INTEGER) AS year, CAST(substr(path, length(path) - 4, 2) AS INTEGER) AS month FROM paths WHERE contains(path, '.TPQWL.') AND CAST(substr(path, length(path) - 9, 4) AS INTEGER) BETWEEN 1995 AND 2000)"""


def files(spark, sf_dir) -> DataFrame:
    """Paths of all orders' months; some months are named with another token."""
    number = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    o = read(spark, sf_dir, "orders").select("o_orderpriority", F.when(number % 7 == 3, "Solr").otherwise("TPQWL").alias("token"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.explode(F.array(F.lit("a_"), F.lit(""))).alias("x"))
    return calendar.month_files(o.select(F.concat(F.lit("/f/"), "o_orderpriority", F.lit("/"), "x", F.lit("clmforc.v1."), "token", F.lit("."), "month", F.lit(".nc")).alias("path")).distinct(), "TPQWL", 1995, 2000)


@query(f"WITH {FILES} SELECT path, year, month FROM files")
def month_file_calendar(spark, sf_dir):
    return files(spark, sf_dir)


@query(f"WITH {FILES} SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM (SELECT unnest(generate_series(1995, 2002)) AS y), (SELECT unnest(generate_series(1, 12)) AS m) WHERE (y, m) NOT IN (SELECT (year, month) FROM files)")
def month_file_missing(spark, sf_dir):
    return calendar.missing_months(files(spark, sf_dir), 1995, 2002)


@query(f"WITH {FILES}, f AS (SELECT year, month, min(path) AS path FROM files GROUP BY 1, 2) SELECT CAST(row_number() OVER (ORDER BY year, month) - 1 AS BIGINT) AS step, year, month, path FROM f")
def month_file_first(spark, sf_dir):
    return calendar.numbered_months(files(spark, sf_dir))


@query("""SELECT o_orderkey AS __row_id, o_orderstatus, v AS "PSRF", o_custkey, n AS extra FROM orders LEFT JOIN (SELECT user_id, round(avg(value), 6) AS v, count(*) AS n FROM events GROUP BY 1) ON user_id = o_orderkey""")
def forcing_replace(spark, sf_dir):
    old = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("__row_id"), "o_orderstatus", F.col("o_totalprice").alias("PSRF"), "o_custkey")
    new = read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("__row_id")).agg(F.round(F.avg("value"), 6).alias("PBOT"), F.count("*").alias("n"))
    return assemble.replaced(old, new, {"PSRF": "PBOT", "extra": "n"})


@query(f"WITH {CELLS}, {INDEX} SELECT batch_id, count(*) AS expected, count(*) FILTER (WHERE __row_id % 3 > 0 OR batch_id > 3) AS found FROM batched GROUP BY 1 HAVING expected <> found")
def validate_rowcount(spark, sf_dir):
    i = index(spark, sf_dir)
    return validate.row_counts(i, i.where("__row_id % 3 > 0 OR batch_id > 3"))


@query(f"""WITH {CELLS}, {INDEX}, x AS (SELECT batch_id, CASE WHEN __row_id % 10 = 0 THEN NULL ELSE lat END AS a, CASE WHEN __row_id % 4 = 0 THEN 'inf'::DOUBLE ELSE lon END AS b FROM batched)
SELECT batch_id, 'a' AS "column", round(avg(CAST(a IS NULL AS INTEGER)), 6) AS nan_ratio, CAST(0 AS BIGINT) AS infinite FROM x GROUP BY 1
UNION ALL SELECT batch_id, 'b', 0, count(*) FILTER (WHERE isinf(b)) FROM x GROUP BY 1""")
def validate_nan_ratio(spark, sf_dir):
    i = index(spark, sf_dir)
    x = i.select("batch_id", F.when(F.col("__row_id") % 10 == 0, float("nan")).otherwise(F.col("lat")).alias("a"), F.when(F.col("__row_id") % 4 == 0, float("inf")).otherwise(F.col("lon")).alias("b"))
    return validate.nan_ratios(x, ["a", "b"]).withColumn("nan_ratio", F.round("nan_ratio", 6))


@query(f"WITH {STEPS} SELECT CAST(user_id % 5 AS INTEGER) AS batch_id, 'series' AS \"column\", count(DISTINCT user_id) FILTER (WHERE n <> 60) AS wrong_length, count(DISTINCT user_id) FILTER (WHERE user_id % 2 = 0) AS not_finite FROM steps GROUP BY 1")
def validate_series(spark, sf_dir):
    s = user_series(spark, sf_dir).select(F.col("user_id").alias("__row_id"), (F.col("user_id") % 5).cast("int").alias("batch_id"), F.transform("series", lambda x: F.when(F.col("user_id") % 2 == 0, float("nan")).otherwise(x)).alias("series"))
    return validate.bad_series(s, ["series"], 60, None)


@query(f"WITH {CELLS}, {INDEX} SELECT batch_id, count(*) FILTER (WHERE __row_id % 17 = 0) AS missing, count(*) FILTER (WHERE __row_id % 17 > 0 AND NOT (lat BETWEEN -50.000001 AND 60.000001 AND lon BETWEEN 29.999999 AND 300.000001)) AS outside FROM batched GROUP BY 1")
def validate_coords(spark, sf_dir):
    i = index(spark, sf_dir).select("batch_id", F.when(F.col("__row_id") % 17 > 0, F.col("lat")).alias("Latitude"), F.col("lon").alias("Longitude"))
    return validate.coordinates(i, (-50, 60), (30, 300))


@query(f"WITH {CELLS} SELECT min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon FROM cells")
def coord_range(spark, sf_dir):
    c = mesh.coordinate_range(cells(spark, sf_dir))
    return c.select("min_lat", "max_lat", "min_lon", "max_lon")


@query("SELECT CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS BIGINT) AS __row_id, CAST((row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 2000 + 1 AS INTEGER) AS batch_id, l_orderkey, l_linenumber FROM lineitem")
def dense_numbering(spark, sf_dir):
    df = dense_row_id(read(spark, sf_dir, "lineitem"), ["l_shipdate", "l_orderkey", *LINE_ORDER])
    return df.select("__row_id", batch_id("__row_id", 2000).alias("batch_id"), "l_orderkey", "l_linenumber")


def scratch(spark: SparkSession) -> str:
    """A new folder for what a query writes and reads back."""
    return f"{shared_dir(spark).rstrip('/')}/query-{uuid.uuid4().hex}"


@query("SELECT (p_size - 1) * (SELECT count(*) FROM supplier) + s_suppkey - 1 AS forcing_idx, p_size * 3.0::DOUBLE - 80 AS lat, s_suppkey * 0.25::DOUBLE AS lon FROM (SELECT DISTINCT p_size FROM part), supplier")
def forcing_mesh(spark, sf_dir):
    """Axes of unequal sizes, of which the first step counts, are crossed in the order of the file."""
    steps = F.explode(F.array(F.lit(0), F.lit(1))).alias("time_idx")
    lats = read(spark, sf_dir, "part").select((F.col("p_size") - 1).alias("i")).distinct().select("i", steps).withColumn("lat", (F.col("i") + 1) * F.lit(3.0) - 80 + F.col("time_idx"))
    lons = read(spark, sf_dir, "supplier").select((F.col("s_suppkey") - 1).alias("i"), (F.col("s_suppkey") * F.lit(0.25)).alias("lon"))
    return tables.forcing_coordinates(lats, lons)


@query(f"SELECT p_partkey AS cell, {degrees_sql('p_partkey', 37, 91)} FROM part")
def forcing_points(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("cell"), *degrees("p_partkey", 37, 91), F.explode(F.array(F.lit(0), F.lit(1))).alias("time_idx"))
    return tables.flat_coordinates(rows.withColumn("lat", F.col("lat") + F.col("time_idx")))


@query(f"WITH {CELLS}, {INDEX} SELECT __row_id, batch_id FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY __row_id) AS n FROM batched) WHERE n <= 7")
def first_rows_of_batches(spark, sf_dir):
    return validate.first_rows(index(spark, sf_dir).select("__row_id", "batch_id"), 7)


@query(f"WITH {CELLS} SELECT c_custkey AS cell_idx, c_custkey AS restart_idx, c_custkey AS forcing_idx FROM cells")
def same_index_map(spark, sf_dir):
    c = cells(spark, sf_dir).select(F.col("c_custkey").alias("cell_idx"), "lat", "lon")
    out, _ = samemesh.same_index(c, c.withColumnRenamed("cell_idx", "restart_idx"), c.withColumnRenamed("cell_idx", "forcing_idx").withColumn("lat", F.col("lat") + 1))
    return out.select("cell_idx", "restart_idx", "forcing_idx")


@query(f"WITH {RESTART}, other AS (SELECT s_suppkey AS restart_idx, {degrees_sql('s_suppkey', 54, 17)} FROM supplier) SELECT restart_idx, s_acctbal, other.lat, other.lon FROM restart JOIN other USING (restart_idx)")
def reference_coordinates(spark, sf_dir):
    other = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("restart_idx"), *degrees("s_suppkey", 54, 17))
    return samemesh.with_reference_coordinates(restart(spark, sf_dir), other, "restart_idx")[0]


FROM_AXES = f"""WITH {CELLS}, {INDEX}, lats AS (SELECT DISTINCT p_size AS i, p_size * 3.5::DOUBLE - 90 AS a FROM part), lons AS (SELECT s_suppkey AS j, s_suppkey * 360.0::DOUBLE / (SELECT count(*) FROM supplier) AS a FROM supplier),
i AS (SELECT __row_id, i FROM (SELECT __row_id, i, row_number() OVER (PARTITION BY __row_id ORDER BY abs(lat - a), a) AS n FROM batched, lats) WHERE n = 1),
j AS (SELECT __row_id, j FROM (SELECT __row_id, j, row_number() OVER (PARTITION BY __row_id ORDER BY abs(lon - a), a) AS n FROM batched, lons) WHERE n = 1)
SELECT __row_id, c_acctbal, k AS pos, (i * 1000 + j) * 1.0::DOUBLE + k AS value FROM batched JOIN i USING (__row_id) JOIN j USING (__row_id), (SELECT unnest([0, 1]) AS k)"""


@query(FROM_AXES)
def forcing_from_axes(spark, sf_dir):
    """Forcing columns of a dataset taken from the nearest cell of a rectilinear cube, as the replacement of a final dataset does."""
    final = index(spark, sf_dir).select("__row_id", F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"), "c_acctbal", F.array(F.lit(0.0)).alias("PSRF"))
    suppliers = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("lon_idx"))
    lats = read(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("lat_idx")).distinct()
    cube = lats.crossJoin(suppliers).select("lat_idx", "lon_idx", F.transform(F.array(F.lit(0.0), F.lit(1.0)), lambda k: F.col("lat_idx") * 1000 + F.col("lon_idx") + k).alias("PBOT"))
    axes = lats.withColumn("lat", F.col("lat_idx") * F.lit(3.5) - 90), suppliers.withColumn("lon", F.col("lon_idx") * F.lit(360.0) / F.lit(suppliers.count()))
    out = runs.replace_forcing(final, *axes, cube, {"PSRF": "PBOT"})
    return out.select("__row_id", "c_acctbal", F.posexplode("PSRF").alias("pos", "value"))


@query(FROM_AXES)
def forcing_from_blocks(spark, sf_dir):
    """The same replacement from blocks of one step along time, as a NetCDF file is read, of which only those of nearest cells are put together."""
    final = index(spark, sf_dir).select("__row_id", F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"), "c_acctbal", F.array(F.lit(0.0)).alias("PSRF"))
    suppliers = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("lon_idx"))
    lats = read(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("lat_idx")).distinct()
    steps = F.explode(F.array(F.lit(1), F.lit(0))).alias("first")
    blocks = lats.crossJoin(suppliers).select("lat_idx", "lon_idx", steps).withColumn("PBOT", F.array((F.col("lat_idx") * 1000 + F.col("lon_idx") + F.col("first")).cast("float")))
    axes = lats.withColumn("lat", F.col("lat_idx") * F.lit(3.5) - 90), suppliers.withColumn("lon", F.col("lon_idx") * F.lit(360.0) / F.lit(suppliers.count()))
    out = runs.replace_forcing_blocks(final, *axes, {"PSRF": blocks})
    return out.select("__row_id", "c_acctbal", F.posexplode("PSRF").alias("pos", "value"))


def given_sources(spark, sf_dir) -> tuple[modules.Sources, DataFrame]:
    """Sources made from customers, orders, parts and events, and an index whose cells are the selected customers."""
    customers, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    at = [F.col("c_custkey").alias("lat_idx"), F.col("c_custkey").alias("lon_idx")]
    steps = F.explode(F.array(F.lit(0), F.lit(1))).alias("time_idx")
    history = customers.select(*at, "c_nationkey", "c_acctbal", steps).select("lat_idx", "lon_idx", "time_idx", (F.col("c_nationkey") / F.lit(25.0)).alias("LANDFRAC_PFT"), (F.col("c_acctbal") + F.col("time_idx")).alias("GPP"))
    groups = orders.select(F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("gridcell_id"), F.col("o_totalprice").alias("tlai"))
    events = user_series(spark, sf_dir).select((F.col("user_id") % 1000).alias("forcing_idx"), F.col("series").alias("PBOT"))
    parts = gather.ragged_gather(read(spark, sf_dir, "part").withColumnRenamed("p_brand", "name"), "name", "p_partkey", ["p_retailprice"]).withColumnRenamed("p_retailprice", "vals")
    given = {
        "ds1": customers.select(*at, F.col("c_acctbal").alias("AREA")),
        "ds1_layers": orders.select(F.col("o_custkey").alias("lat_idx"), F.col("o_custkey").alias("lon_idx"), F.col("o_orderkey").alias("level"), F.col("o_totalprice").alias("PCT_SAND")),
        "ds2_history": history, "h0_list": history.withColumn("GPP", -F.col("GPP")),
        "ds10_pfts": groups, "ds10_columns": groups.select("pos", "gridcell_id", F.array("tlai", -F.col("tlai")).alias("soil1c_vr")),
        "r_pfts": groups.select("pos", (F.col("tlai") * 2).alias("tlai")), "r_columns": groups.select("pos", F.array("tlai").alias("soil1c_vr")),
        "ds5": events.groupBy("forcing_idx").agg(F.min("PBOT").alias("PBOT")), "clm_params": parts,
    }
    config = Config(mode="legacy", surface=("AREA", "PCT_SAND"), history=("GPP", "NPP"), pft=("tlai",), columns=("soil1c_vr",), parameters=("Brand#11", "absent"))
    spine = index(spark, sf_dir).select("__row_id", "batch_id", F.col("c_custkey").alias("lat_idx"), F.col("c_custkey").alias("lon_idx"), (F.col("c_custkey") % 300).alias("nearest_forcing_index"), F.col("c_custkey").alias("gridcell_id"))
    return modules.Sources(spark, config, given), spine


def longer(df: DataFrame, array: str, *keep: str) -> DataFrame:
    return df.select("__row_id", *keep, F.posexplode_outer(array).alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


#: orders of each selected cell in order of their keys; one row with NULLs for a cell without any
ORDERED = "ordered AS (SELECT __row_id, batch_id, c_acctbal, c_nationkey, CASE WHEN o_orderkey IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) - 1 END AS pos, o_totalprice FROM batched LEFT JOIN orders ON o_custkey = c_custkey)"


@query(f'WITH {CELLS}, {INDEX}, {ORDERED} SELECT __row_id, batch_id, c_acctbal AS "AREA", pos, o_totalprice AS value FROM ordered')
def module_surface(spark, sf_dir):
    s, spine = given_sources(spark, sf_dir)
    return longer(modules.build(s, "A_ds1_surface", spine), "PCT_SAND", "batch_id", "AREA")


@query(f'WITH {CELLS}, {INDEX} SELECT __row_id, batch_id, c_nationkey / 25.0::DOUBLE AS landfrac, c_acctbal AS "GPP" FROM batched')
def module_history_x(spark, sf_dir):
    """The first step; landfrac under its other name; a variable that is not there is left out."""
    s, spine = given_sources(spark, sf_dir)
    return modules.build(s, "A_ds2_history_x", spine)


@query(f'WITH {CELLS}, {INDEX} SELECT __row_id, batch_id, -c_acctbal AS "Y_GPP" FROM batched')
def module_history_y(spark, sf_dir):
    s, spine = given_sources(spark, sf_dir)
    s.config = replace(s.config, history=("GPP",))
    return modules.build(s, "A_h0_list_y", spine)


@query(f"WITH {CELLS}, {INDEX}, {ORDERED} SELECT __row_id, pos, o_totalprice AS value, -o_totalprice AS lower FROM ordered")
def module_restart_x(spark, sf_dir):
    """Groups of places, flat and layered, side by side."""
    s, spine = given_sources(spark, sf_dir)
    both = modules.build(s, "A_ds10_restart_x", spine).select("__row_id", F.arrays_zip("tlai", "soil1c_vr").alias("x"))
    return both.select("__row_id", F.posexplode_outer("x").alias("pos", "x")).select("__row_id", F.col("pos").cast("long").alias("pos"), F.col("x.tlai").alias("value"), F.get(F.col("x.soil1c_vr"), F.lit(1)).alias("lower"))


@query(f"WITH {CELLS}, {INDEX}, {ORDERED} SELECT __row_id, pos, o_totalprice * 2 AS value FROM ordered")
def module_restart_y(spark, sf_dir):
    """Values of the target, places of the initial file."""
    s, spine = given_sources(spark, sf_dir)
    return longer(modules.build(s, "A_r_list_y", spine), "Y_tlai")


@query(f"""WITH {CELLS}, {INDEX}, p AS (SELECT list(p_retailprice ORDER BY p_partkey)[1:17] AS vals FROM part WHERE p_brand = 'Brand#11')
SELECT __row_id, generate_subscripts(vals, 1) - 1 AS pos, unnest(vals) AS value FROM batched, p""")
def module_parameters(spark, sf_dir):
    s, spine = given_sources(spark, sf_dir)
    return longer(modules.build(s, "A_clm_params_pft", spine), "pft_Brand#11")


@query(f"WITH {CELLS}, {INDEX}, {STEPS}, found AS (SELECT user_id, list(value ORDER BY pos) AS vals FROM steps GROUP BY 1), least AS (SELECT user_id % 1000 AS place, min(vals) AS vals FROM found GROUP BY 1), spread AS (SELECT place, generate_subscripts(vals, 1) - 1 AS pos, unnest(vals) AS value FROM least) SELECT __row_id, pos, value FROM batched LEFT JOIN spread ON place = c_custkey % 300")
def module_forcing(spark, sf_dir):
    """A variable that the source holds under its other name."""
    s, spine = given_sources(spark, sf_dir)
    return longer(modules.build(s, "A_forcing_ds5_psrf", spine), "PSRF")


@query(f"WITH {CELLS}, {INDEX} SELECT __row_id, c_custkey FROM batched WHERE batch_id = 1")
def artifact_batch(spark, sf_dir):
    """An artifact in files of many batches, of which the row groups of one are read."""
    root = scratch(spark)
    sinks.write_artifact(index(spark, sf_dir).select("__row_id", "batch_id", "c_custkey"), root, "A")
    return tables.artifact(spark, root, "A", 1).select("__row_id", "c_custkey")


@query(f"WITH {CELLS}, {INDEX} SELECT 'A' AS module, count(*) AS rows, CAST(max(batch_id) AS BIGINT) AS batches, TRUE AS current FROM batched")
def manifest_facts(spark, sf_dir):
    """A manifest of an artifact's sources and counts, written and read back, and whether it is up to date."""
    root, df, sources = scratch(spark), index(spark, sf_dir), [sinks.source_entry(spark, f"{sf_dir}/customer.parquet")]
    row = mesh.index_summary(df).first()
    sinks.write_manifest(spark, root, "A", sources, rows=row["rows"], batches=row["batches"])
    held = sinks.read_manifest(spark, root, "A")
    return spark.createDataFrame([(held["module"], held["rows"], held["batches"], sinks.is_current(spark, root, "A", sources))], "module string, rows long, batches long, current boolean")


@query("""WITH s AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events WHERE user_id % 2 = 0)
SELECT CAST(user_id AS INT) AS gridcell, pos, CAST(value AS FLOAT)::DOUBLE AS value, 2002 AS start_year FROM s""")
def forcing_versions(spark, sf_dir):
    """A consolidated table that was replaced: the newest complete version is read, not an unfinished one."""
    path = f"{scratch(spark)}/FLDS"
    s = user_series(spark, sf_dir).select(F.col("user_id").alias("gridcell"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), "series")
    sinks.write_forcing(s, path, 2000, 2001)
    sinks.write_forcing(s.where("gridcell % 2 = 0"), path, 2002, 2003)
    s.limit(1).write.parquet(f"{path}/v99999999-00000000")  # no mark: a job that was killed
    out = tables.artifact(spark, *path.rsplit("/", 1)).select("gridcell", F.posexplode("series").alias("pos", "value"), "start_year")
    return out.select("gridcell", F.col("pos").cast("long").alias("pos"), F.col("value").cast("double").alias("value"), "start_year")


@query(f"WITH {CELLS}, {INDEX} SELECT __row_id, batch_id, CASE WHEN batch_id = 2 THEN c_custkey + 1 ELSE c_custkey END AS c_custkey FROM batched")
def artifact_rebuilt_batch(spark, sf_dir):
    """An artifact of which one batch was built anew, over the old one alone."""
    root, df = scratch(spark), index(spark, sf_dir).select("__row_id", "batch_id", "c_custkey")
    sinks.write_artifact(df, root, "A")
    sinks.write_artifact(df.withColumn("c_custkey", F.col("c_custkey") + 1), root, "A", [2])
    return tables.artifact(spark, root, "A").select("__row_id", F.col("batch_id").cast("long").alias("batch_id"), "c_custkey")


@query(f"WITH {CELLS}, {INDEX} SELECT __row_id, batch_id, c_acctbal FROM batched WHERE __row_id % 3 > 0")
def final_dataset_written(spark, sf_dir):
    """A final dataset written over an older, larger one, and read by pattern."""
    root, df = scratch(spark), index(spark, sf_dir).select("__row_id", "batch_id", "c_acctbal")
    sinks.write_final(df, root)
    sinks.write_final(df.where("__row_id % 3 > 0"), root, overwrite=True)
    return tables.final_dataset(spark, root, "*.parquet").select("__row_id", "batch_id", "c_acctbal")


@query(f"WITH {STEPS} SELECT CAST(user_id AS INTEGER) AS gridcell, pos, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value, 2000 AS start_year FROM steps")
def forcing_written(spark, sf_dir):
    """A consolidated forcing table, with 4-byte floats at rest."""
    s = user_series(spark, sf_dir).select(F.col("user_id").alias("gridcell"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), "series")
    path = sinks.write_forcing(s, scratch(spark), 2000, 2001)
    out = spark.read.parquet(path).select("gridcell", F.posexplode("series").alias("pos", "value"), "start_year")
    return out.select("gridcell", F.col("pos").cast("long").alias("pos"), F.col("value").cast("double").alias("value"), "start_year")


#: a file for each day, as if days were months
RAW = "raw AS (SELECT user_id AS cell, extract(day FROM ts) AS d, value, event_id FROM events)"


def raw_steps(spark, sf_dir) -> DataFrame:
    """(path, time_idx, cell, value) of files named by year and month: a day is a month, twelve of them a year."""
    day = F.dayofmonth("ts") - 1
    path = F.format_string("/f/clmforc.v.T.%d-%02d.nc", F.floor(day / 12) + 2000, day % 12 + 1)
    return read(spark, sf_dir, "events").select(path.alias("path"), F.lit(0).alias("time_idx"), F.col("user_id").alias("cell"), F.when(F.col("event_id") % 9 == 0, float("nan")).otherwise(F.col("value")).alias("value"))


@query(f"""WITH {RAW}, m AS (SELECT cell, d, avg(value) FILTER (WHERE event_id % 9 <> 0) AS value FROM raw GROUP BY 1, 2)
SELECT cell AS gridcell, CAST(cell AS DOUBLE) AS lat, row_number() OVER (PARTITION BY cell ORDER BY d) - 1 AS pos, round(value, 6) AS value FROM m""")
def prepared_forcing(spark, sf_dir):
    """Monthly files in calendar order, averaged over their steps, with the coordinates of a reference mesh."""
    steps = raw_steps(spark, sf_dir)
    points = steps.select("cell").distinct().select("cell", F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    reference = points.select("cell", F.col("cell").cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    made, _ = runs.monthly_forcing(steps, points, calendar.month_files(steps.select("path").distinct(), "T", 2000, 2002), reference)
    return made.select("gridcell", "lat", F.posexplode("series").alias("pos", "value")).select("gridcell", "lat", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


@query(f"""WITH {RAW}, m AS (SELECT cell, d, avg(value) FILTER (WHERE event_id % 9 <> 0) AS value FROM raw GROUP BY 1, 2)
SELECT cell, row_number() OVER (PARTITION BY cell ORDER BY d) - 1 AS pos, round(value, 6) AS value FROM m""")
def streamed_forcing(spark, sf_dir):
    """The same means, taken up as a stream of new files."""
    root = scratch(spark)
    # a file of steps holds whole months
    steps = raw_steps(spark, sf_dir).select("path", F.col("time_idx").cast("int").alias("time_idx"), F.col("cell").cast("long").alias("cell"), "value")
    steps.repartition(8, "path").write.parquet(f"{root}/steps")
    monthly.ingest(spark, f"{root}/steps", f"{root}/means", f"{root}/checkpoint", "T", 2000, 2002, files_at_once=3).awaitTermination()
    out = monthly.months(spark, f"{root}/means")
    return out.select("cell", F.posexplode("series").alias("pos", "value")).select("cell", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value"))


@query(f"WITH {CELLS}, {INDEX} SELECT 'output' AS \"check\", batch_id, 'fail' AS severity, 'no output' AS detail FROM batched GROUP BY batch_id HAVING batch_id % 3 = 0")
def validate_missing_batches(spark, sf_dir):
    i = index(spark, sf_dir).select("__row_id", "batch_id")
    return validate.missing_batches(i, i.where("batch_id % 3 > 0"))


@query(f"""WITH {CELLS}, {INDEX}, b AS (SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE __row_id % 5 > 0) AS found, count(*) FILTER (WHERE __row_id % 5 > 0 AND lat > 60) AS far FROM batched GROUP BY 1)
SELECT 'output' AS "check", batch_id, 'fail' AS severity FROM b WHERE batch_id % 3 = 0
UNION ALL SELECT 'rows', batch_id, 'fail' FROM b
UNION ALL SELECT 'coordinates', batch_id, 'warn' FROM b WHERE batch_id % 3 > 0 AND far > 0
UNION ALL SELECT 'series', batch_id, 'fail' FROM b WHERE batch_id % 3 > 0
UNION ALL SELECT 'series', batch_id, 'fail' FROM b WHERE batch_id % 3 = 1
UNION ALL SELECT 'numbers', batch_id, 'fail' FROM b WHERE batch_id % 3 = 2
UNION ALL SELECT 'prefix', batch_id, 'warn' FROM b WHERE batch_id % 3 > 0""")
def validate_report(spark, sf_dir):
    """All checks of a dataset of which a third of the batches and a fifth of the rows are missing."""
    i = index(spark, sf_dir)
    final = i.where("batch_id % 3 > 0 AND __row_id % 5 > 0").select(
        "__row_id", "batch_id", F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"), F.lit(1).alias("Y_a"),
        F.when(F.col("batch_id") % 3 == 1, F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(2.0))).alias("FLDS"),
        F.when(F.col("batch_id") % 3 == 2, float("nan")).otherwise(F.col("c_acctbal")).alias("GPP"),
    )
    return validate.report(i, final, lat=(-60, 60), lon=(20, 340), series=["FLDS", "TBOT"], series_length=2, numbers=["GPP", "absent"]).select("check", "batch_id", "severity")


@query(f"""WITH {CELLS}, {INDEX} SELECT __row_id, batch_id, lat AS "Latitude", lon AS "Longitude", c_acctbal AS "AREA", c_nationkey / 25.0::DOUBLE AS landfrac, c_acctbal AS "GPP", -c_acctbal AS "Y_GPP",
coalesce((SELECT min(o_totalprice) FROM (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1 AND o_custkey = c_custkey), 0) AS "PCT_SAND_0" FROM batched""")
def assembled_dataset(spark, sf_dir):
    """Modules built to artifacts, joined, coerced and expanded, written as the final dataset and read back."""
    s, spine = given_sources(spark, sf_dir)
    c = replace(s.config, output=scratch(spark), history=("GPP",))
    s.config = c
    places = index(spark, sf_dir).select("__row_id", F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"))
    sinks.write_artifact(spine.join(places, "__row_id"), runs.artifacts(c), modules.INDEX)
    for name in ("A_ds1_surface", "A_ds2_history_x", "A_h0_list_y"):
        sinks.write_artifact(modules.build(s, name, tables.artifact(spark, runs.artifacts(c), modules.INDEX)), runs.artifacts(c), name)
    runs.write_dataset(spark, c)
    out = tables.final_dataset(spark, f"{c.output}/final_dataset")
    return out.select("__row_id", "batch_id", "Latitude", "Longitude", "AREA", "landfrac", "GPP", "Y_GPP", "PCT_SAND_0")
