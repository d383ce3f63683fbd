"""Small fixtures with exact expectations, and properties."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshloom.functions import scalars
from meshloom.operators import assemble, calendar, gather, mesh, nearest, numbering, samemesh, series, validate
from meshloom.sources import sinks, tables
from meshloom.sources.shared import shared_dir


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def grid(spark):
    """4 x 5 cells with two of ocean; bounds below lie exactly on grid lines."""
    return spark.createDataFrame([(i, j, 10.0 * i, 20.0 * j, int((i, j) not in {(1, 1), (2, 3)})) for i in range(4) for j in range(5)], "lat_idx int, lon_idx int, lat double, lon double, mask int")


def test_box_is_inclusive_and_land_only(grid):
    got = mesh.select_cells(grid, 10, 20, 20, 60)
    assert {(r.lat_idx, r.lon_idx) for r in got.collect()} == {(1, 2), (1, 3), (2, 1), (2, 2)}


def test_index_is_dense_in_mesh_order(grid):
    got = mesh.index_cells(mesh.select_cells(grid, 0, 30, 0, 80), 4).orderBy("__row_id").collect()
    assert [r["__row_id"] for r in got] == list(range(18))
    assert [(r.lat_idx, r.lon_idx) for r in got] == sorted((r.lat_idx, r.lon_idx) for r in got)
    assert [r.batch_id for r in got] == [i // 4 + 1 for i in range(18)]


def test_dense_numbering_of_ties_and_nothing(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"))
    assert [r["__row_id"] for r in numbering.dense_row_id(df, ["k"], partitions=7).orderBy("__row_id").collect()] == list(range(1000))
    assert numbering.dense_row_id(df.limit(0), ["k"]).collect() == []


def brute_nearest(queries, candidates):
    return sorted((k, min(((a - x) ** 2 + (b - y) ** 2, i) for i, x, y in candidates)[1]) for k, a, b in queries)


@pytest.mark.parametrize(("crowd", "step"), [(1, 1), (4, 2), (64, 3)])
def test_nearest_join(spark, monkeypatch, crowd, step):
    monkeypatch.setattr(nearest, "CROWD", crowd)
    monkeypatch.setattr(nearest, "STEP", step)
    r = random.Random(2)
    point = lambda: (r.randint(-180, 180) / 2, r.randint(0, 720) / 2)
    queries = [(k, *point()) for k in range(200)] + [(900, 0.0, 359.9), (901, -90.0, 1e4)]
    candidates = [(i, *point()) for i in range(40)] + [(40, 0.0, 0.1), (41, 3.0, 3.0), (42, 3.0, 3.0)]
    q = spark.createDataFrame(queries, "k long, lat double, lon double")
    c = spark.createDataFrame(candidates, "i long, lat double, lon double")
    want = brute_nearest(queries, candidates)
    assert sorted((x.k, x.idx) for x in nearest.nearest_join(q, c, "k", "i").collect()) == want
    assert nearest.nearest_join(q, c.limit(0), "k", "i").collect() == []
    odd = spark.createDataFrame([(1, float("nan"), 0.0), (2, None, 0.0), (3, float("inf"), 1.0), (4, 1.0, 1.0)], "k long, lat double, lon double")
    assert sorted((x.k, x.idx) for x in nearest.nearest_join(odd, c, "k", "i").collect() if x.k != 4) == [(1, 0), (3, 0)]


def test_nearest_join_of_clusters(spark):
    """Dense clusters far from most queries, places that repeat, and points in a row, against all pairs."""
    r = np.random.default_rng(5)
    c = np.concatenate([r.normal(0, 1e-4, (1500, 2)), r.normal(50, 1e-7, (700, 2)), r.uniform(-90, 90, (800, 2)), np.stack([np.arange(200) / 7, np.full(200, 8.0)], 1)])
    c = np.concatenate([c, c[:300]])
    q = np.concatenate([r.uniform(-90, 90, (300, 2)), r.normal(0, 2e-4, (200, 2)), c[1500:1600] + 1e-8, [[1e6, -1e6]]])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(c)], "i long, lat double, lon double")
    asked = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(q)], "k long, lat double, lon double")
    want = [((q[k] - c) ** 2).sum(1).argmin() for k in range(len(q))]
    got = nearest.nearest_join(asked, points, "k", "i").collect()
    assert [x.idx for x in sorted(got)] == want


def test_nearest_join_spreads(spark, monkeypatch):
    """Queries at one place go down once, more rows make more tasks, and no task sorts its pairs before the shuffle."""
    made, write = [], nearest.materialise

    def kept(df, name, *by):
        plan, out = df._jdf.queryExecution().toString(), write(df, name, *by)
        made.append((name, plan, [r[0] for r in out.groupBy(F.input_file_name()).count().select("count").collect()] if name == "nearest-open" else None))
        return out

    monkeypatch.setattr(nearest, "materialise", kept)
    monkeypatch.setattr(nearest, "CROWD", 4)
    monkeypatch.setattr(nearest, "SORTED", 200)
    r = random.Random(8)
    places = [(r.randint(-180, 180) / 2, r.randint(0, 720) / 2) for _ in range(100)] + [(-0.0, 0.0), (0.0, -0.0)]
    queries = [(4 * k + i, *p) for k, p in enumerate(places) for i in range(4)]
    candidates = [(i, r.randint(-180, 180) / 2, r.randint(0, 720) / 2) for i in range(300)] + [(300, 0.5, 0.0), (301, -0.5, 0.0)]
    q = spark.createDataFrame(queries, "k long, lat double, lon double").repartition(3)
    c = spark.createDataFrame(candidates, "i long, lat double, lon double")
    got = sorted((x.k, x.idx) for x in nearest.nearest_join(q, c, "k", "i").collect())
    assert got == brute_nearest(queries, candidates)
    opened = [sizes for name, _, sizes in made if name == "nearest-open"]
    assert len(opened) > 2 and sum(opened[0]) == 101
    assert max(map(len, opened)) > 4 and all(max(sizes) < 200 for sizes in opened)
    assert not any("SortAggregate" in plan for name, plan, _ in made if name.startswith("nearest"))


def test_box_tree(spark):
    """Boxes of a level add up to all points, a crowded box's boxes add up to it, and few boxes lie below those of few points."""
    r = random.Random(9)
    places = sorted({(r.gauss(0, 1), r.gauss(0, 1)) for _ in range(4000)})
    df = spark.createDataFrame(places, "c_lat double, c_lon double")
    placed = df.withColumn("code", nearest.morton("c_lat", "c_lon", (-9.0, -9.0), 18.0)).repartitionByRange(3, "code").sortWithinPartitions("code")
    tree = nearest.box_tree(placed.withColumn("seq", F.monotonically_increasing_id())).collect()
    below = {}
    for x in tree:
        below[x.level, x.parent] = below.get((x.level, x.parent), 0) + x.n
    assert below[0, -1] == len(places) and len(tree) < len(places) / 4
    crowded = [x for x in tree if x.n > nearest.CROWD and x.level < nearest.DEPTH]
    assert len(crowded) > 10 and all(below[x.level + nearest.STEP, x.box] == x.n for x in crowded)
    boxes = {(x.level, x.box): (x.a, x.b, x.c, x.d) for x in tree}
    assert boxes[0, 0] == (min(a for a, _ in places), max(a for a, _ in places), min(b for _, b in places), max(b for _, b in places))


@pytest.mark.parametrize("n", [1, 7, 2500])
def test_nearest_on_axis(spark, n):
    r = random.Random(n)
    axis = [(i, 80.0 - i * 0.5) for i in range(n)]  # descending
    queries = [(k, r.choice([r.uniform(-100, 100), r.randint(-400, 400) / 4])) for k in range(300)]
    got = nearest.nearest_on_axis(spark.createDataFrame(queries, "k long, value double"), spark.createDataFrame(axis, "axis_idx long, value double"), "k")
    want = sorted((k, min((abs(v - a), a, i) for i, a in axis)[2]) for k, v in queries)
    assert sorted((x.k, x.axis_idx) for x in got.collect()) == want


def test_nearest_on_axis_spreads(spark, monkeypatch):
    """Queries of one bucket, of one value even, are sorted in several tasks, each with the whole bucket's axis."""
    monkeypatch.setattr(nearest, "SORTED", 20, raising=False)
    axis = [(i, 0.5 * i) for i in range(40)]
    queries = [(k, 7.1 if k % 2 else k % 60 * 0.37 - 1) for k in range(2000)]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = nearest.nearest_on_axis(spark.createDataFrame(queries, "k long, value double"), spark.createDataFrame(axis, "axis_idx long, value double"), "k").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sorted((x.k, x.axis_idx) for x in got) == sorted((k, min((abs(v - a), a, i) for i, a in axis)[2]) for k, v in queries)
    assert len({x.task for x in got if x.k % 2}) > 1


@pytest.mark.parametrize(("axis", "queries", "want"), [((0.0, 360.0), (-75.0, 10.0), (285.0, 10.0)), ((-180.0, 180.0), (200.0, 10.0), (-160.0, 10.0)), ((0.0, 180.0), (20.0, 10.0), (20.0, 10.0)), ((0.0, 180.0), (-20.0, 200.0), (340.0, 200.0))])
def test_longitude(spark, axis, queries, want):
    a = spark.createDataFrame([(x,) for x in axis], "lon double")
    q = spark.createDataFrame(list(enumerate(queries)), "k int, lon double")
    assert tuple(r.lon for r in nearest.normalised_longitude(q, a).orderBy("k").collect()) == want


def test_same_mesh_guards(spark):
    points = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 4.0)], "p long, lat double, lon double")
    query = lambda *at: spark.createDataFrame([(7, *at)], "q long, lat double, lon double")
    assert rows(samemesh.same_mesh_join(query(3.0000001, 4.0), points, "q", "p")) == [(7, 1)]
    with pytest.raises(samemesh.MeshError, match="without"):
        samemesh.same_mesh_join(query(3.1, 4.0), points, "q", "p")
    with pytest.raises(samemesh.MeshError, match="repeat"):
        samemesh.same_mesh_join(query(3.0, 4.0), points.union(points), "q", "p")
    with pytest.raises(samemesh.MeshError, match="differ"):
        samemesh.same_mesh_join(query(3.0000001, 4.0), points, "q", "p", tolerance=1e-9)


def test_same_index(spark):
    cells = spark.createDataFrame([(i, float(i), 0.0) for i in range(7)], "cell_idx long, lat double, lon double")
    named = lambda n, off: cells.select(F.col("cell_idx").alias(n), (F.col("lat") + off).alias("lat"), "lon")
    out, warnings = samemesh.same_index(cells, named("restart_idx", 0), named("forcing_idx", 0.5))
    assert len(warnings) == 1 and all(r.cell_idx == r.restart_idx == r.forcing_idx for r in out.collect())
    with pytest.raises(samemesh.MeshError, match="off"):
        samemesh.same_index(cells, named("restart_idx", 0.5), named("forcing_idx", 0))
    with pytest.raises(samemesh.MeshError, match="sizes"):
        samemesh.same_index(cells, named("restart_idx", 0).limit(3), named("forcing_idx", 0))
    kept, warned = samemesh.with_reference_coordinates(cells, cells.limit(2), "cell_idx")
    assert warned and kept is cells
    moved, _ = samemesh.with_reference_coordinates(cells, named("cell_idx", 5.0), "cell_idx")
    assert moved.agg(F.min("lat")).first()[0] == 5.0


def test_ragged_groups(spark):
    pfts = spark.createDataFrame([(p, g, float(p)) for p, g in enumerate([1, 1, 3, 3, 3])], "pos long, gridcell_id long, v double")
    columns = spark.createDataFrame([(0, 1, [1.0, 2.0]), (1, 9, [3.0])], "pos long, gridcell_id long, w array<double>")
    index = spark.createDataFrame([(1,), (2,), (3,)], "gridcell_id long")
    got = gather.lookup_groups(index, gather.ragged_gather(pfts, "gridcell_id", "pos", ["v"]), "gridcell_id").orderBy("gridcell_id").collect()
    assert [r.v for r in got] == [[0.0, 1.0], None, [2.0, 3.0, 4.0]]
    assert [r.gridcell_id for r in gather.only_groups_of(columns, pfts, "gridcell_id").collect()] == [1]
    assert gather.ragged_gather(columns, "gridcell_id", "pos", ["w"]).where("gridcell_id = 1").first().w == [[1.0, 2.0]]


def test_parameters(spark):
    nan = float("nan")
    params = spark.createDataFrame([("a", [1.0] * 20), ("b", [1.0, nan]), ("c", [1.0] * 17 + [nan]), ("d", [None, 1.0])], "name string, vals array<double>")
    good = gather.valid_parameters(params)
    assert {r.name: len(r.vals) for r in good.collect()} == {"a": 17, "c": 17}
    out = gather.with_parameters(spark.range(3), good, ["c", "a", "zz"])
    assert out.columns == ["id", "pft_c", "pft_a"] and out.count() == 3


@pytest.mark.parametrize(("n", "want"), [(0, 0), (730, 24), (24, 24), (25, 0), (None, 0)])
def test_monthly_means(spark, n, want):
    values = None if n is None else [float(i) for i in range(n)]
    got = spark.createDataFrame([(values,)], "s array<double>").select(series.monthly_means(F.col("s"), 730, 1, 2).alias("m")).first().m
    assert len(got) == want
    if n == 730:
        assert got[0] == 15.0 and got[12] == 380.0
        assert sum(m * d for m, d in zip(got, series.DAYS_PER_MONTH * 2, strict=True)) == pytest.approx(sum(values))
    if n == 24:
        assert got == values


def test_monthly_means_over_the_end(spark):
    df = spark.createDataFrame([([1.0] * 240,)], "s array<double>")
    got = df.select(series.monthly_means(F.col("s"), 240, 1, 20).alias("m")).first().m
    assert len(got) == 240 and sum(not math.isnan(x) for x in got) == 8
    with pytest.raises(Exception, match="beyond the end"):
        df.select(series.monthly_means(F.col("s"), 240, 1, 20, strict=True)).collect()


def test_time_mean_skips_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 1.0), (1, nan), (1, 3.0), (2, nan)], "c int, v double")
    assert rows(series.time_mean(df, ["c"], "v")) == [(1, 2.0), (2, None)]


def test_expanded(spark):
    df = spark.createDataFrame([(1, [1.0, float("nan")]), (2, None), (3, [1.0, 2.0, 3.0])], "k int, e array<double>")
    assert rows(assemble.expanded(df, ["e", "absent"])) == [(1, 1.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0), (3, 1.0, 2.0, 3.0)]


def test_numeric(spark):
    given = {" 5 ": 5.0, "inf": math.inf, "1e3": 1000.0, "": None, "None": None, "[1.0]": None, "1d": None, "1f": None, "1_000": None, "-.5": -0.5, "5.": 5.0}
    df = spark.createDataFrame([(k,) for k in given], "t string")
    assert {r.t: r.v for r in df.select("t", scalars.numeric(F.col("t")).alias("v")).collect()} == given


def test_left_join_keeps_rows_and_names(spark):
    spine = spark.createDataFrame([(0,), (1,)], "__row_id long")
    one = spark.createDataFrame([(1, "x")], "__row_id long, a string")
    assert rows(assemble.left_joined(spine, [one])) == [(0, None), (1, "x")]
    with pytest.raises(ValueError, match="two modules"):
        assemble.left_joined(spine, [one, one])


def test_replaced_keeps_places(spark):
    df = spark.createDataFrame([(1, 2, 3)], "__row_id int, a int, b int")
    new = spark.createDataFrame([(1, 9, 8)], "__row_id int, x int, y int")
    out = assemble.replaced(df, new, {"a": "x", "c": "y"})
    assert out.columns == ["__row_id", "a", "b", "c"] and tuple(out.first()) == (1, 9, 3, 8)


def test_month_files(spark):
    names = ["/r/clmforc.v.TPQWL.2000-01.nc", "/r/b/a_clmforc.v.TPQWL.2000-01.nc", "/r/climforc.v.TPQWL.2000-03.nc", "/r/clmforc.v.Solr.2000-02.nc", "/r/clmforc.v.TPQWL.1999-01.nc", "/r/clmforc.vTPQWL.2000-04.nc", "/r/clmforc.v.TPQWL.2000-13.nc"]
    found = calendar.month_files(spark.createDataFrame([(n,) for n in names], "path string"), "TPQWL", 2000, 2000)
    assert rows(calendar.first_of_month(found)) == [(2000, 1, names[1], 2), (2000, 3, names[2], 1)]
    assert len(rows(calendar.missing_months(found, 2000, 2000))) == 10
    assert [(r.step, r.month) for r in calendar.numbered_months(found).orderBy("step").collect()] == [(0, 1), (1, 3)]
    with pytest.raises(ValueError, match="missing"):
        calendar.numbered_months(found, True, 2000, 2000)
    with pytest.raises(ValueError, match="token"):
        calendar.month_files(found, " ", 1, 2)


def test_meshes(spark):
    axis = lambda n, name: spark.createDataFrame([(i, float(i)) for i in range(n)], f"i long, {name} double")
    assert tables.forcing_coordinates(axis(2, "lat"), axis(3, "lon")).count() == 6
    assert tables.forcing_coordinates(axis(3, "lat"), axis(3, "lon")).count() == 3
    flat = spark.createDataFrame([(0, 5, 1.0, 2.0), (1, 5, 8.0, 8.0)], "time_idx int, cell int, lat double, lon double")
    assert rows(tables.flat_coordinates(flat)) == [(5, 1.0, 2.0)]
    with pytest.raises(KeyError):
        tables.domain_grid(flat)
    assert tables.resolve(spark.createDataFrame([(1,)], "PBOT int"), "PSRF") == "PBOT"
    with pytest.raises(KeyError):
        tables.resolve(flat, "TBOT")


def test_report(spark):
    nan = float("nan")
    index = spark.createDataFrame([(i, i // 100 + 1) for i in range(300)], "__row_id long, batch_id int")
    final = index.where("batch_id < 3 AND __row_id <> 150").select(
        "*", F.lit(1.0).alias("Latitude"), F.when(F.col("batch_id") == 2, 500.0).otherwise(5.0).alias("Longitude"),
        F.transform(F.sequence(F.lit(1), F.lit(24)), lambda x: x.cast("double")).alias("FLDS"), F.lit(1.0).alias("TBOT"),
        F.when(F.col("__row_id").isin(3, 5), nan).otherwise(1.0).alias("GPP"), F.when(F.col("__row_id") == 3, nan).otherwise(1.0).alias("HR"), F.lit(0).alias("Y_GPP"),
    )
    found = validate.report(index, final, lat=(0, 10), lon=(0, 10), series=["FLDS", "TBOT"], series_length=24, numbers=["GPP", "HR", "absent"])
    got = {(r.check, r.batch_id, r.severity) for r in found.collect()}
    assert got == {("output", 3, "fail"), ("rows", 3, "fail"), ("rows", 2, "fail"), ("coordinates", 2, "warn"), ("series", 1, "fail"), ("series", 2, "fail"), ("numbers", 1, "fail"), ("prefix", 1, "warn"), ("prefix", 2, "warn")}
    assert validate.exit_code(found) == 1 and validate.exit_code(found.where("severity = 'warn'")) == 0


def test_manifests(spark):
    root = f"{shared_dir(spark)}/manifests-test"
    assert sinks.read_manifest(spark, root, "m") is None
    sources = [{"path": "p", "mtime": 1.0, "size": 2}]
    sinks.write_manifest(spark, root, "m", sources, rows=3)
    assert sinks.read_manifest(spark, root, "m")["rows"] == 3
    assert sinks.is_current(spark, root, "m", sources) and not sinks.is_current(spark, root, "m", [])


def test_ragged_parts(spark):
    """Parts follow one another, none is much longer than the bound, and groups below it are one part."""
    r = random.Random(6)
    rows = [("big", k, float(k)) for k in range(2000)] + [("small", k, -float(k)) for k in range(90)] + [(None, 7, 1.0), (None, 3, 2.0), ("none", None, 5.0)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "grp string, pos long, value double")
    got = sorted(gather.ragged_parts(df, "grp", "pos", ["value", "pos"], run=50, most=300).collect(), key=str)
    by = {}
    for x in sorted(got, key=lambda x: x.part):
        by.setdefault(x.grp, []).append(x)
    assert [v for x in by["big"] for v in x.value] == [float(k) for k in range(2000)] and [x.part for x in by["big"]] == list(range(7))
    assert all(300 <= len(x.value) < 350 for x in by["big"][:-1])
    assert [(x.part, x.value, x.pos) for x in by["small"]] == [(0, [-float(k) for k in range(90)], list(range(90)))]
    assert by[None][0].value == [2.0, 1.0] and by["none"][0].pos == [None]
    whole = {x.grp: (x.value, x.pos) for x in gather.ragged_gather(df, "grp", "pos", ["value", "pos"]).collect()}
    assert {x.grp: (x.value, x.pos) for x in gather.ragged_parts(df, "grp", "pos", ["value", "pos"]).collect()} == whole
    assert gather.ragged_parts(df.limit(0), "grp", "pos", ["value"]).collect() == []


def test_land_is_one_exactly(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0, 1.0), (1, 1.0, 1.0, 1.4), (2, 1.0, 1.0, 0.0), (3, 1.0, 1.0, None)], "cell_idx long, lat double, lon double, landmask double")
    assert sorted((r.lat_idx, r.mask) for r in tables.domain_grid(df).collect()) == [(0, 1), (1, 0), (2, 0), (3, None)]
