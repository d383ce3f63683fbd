"""A small run from source tables to a validated dataset, through the command line."""

import pytest
from pyspark.sql import functions as F

from meshloom import cli, config
from meshloom.plans import modules, runs
from meshloom.sources import sinks, tables, versions

N = 6
CONFIG = """
BASE_OUTPUT_ROOT: {out}
DS2_PATH: {src}/ds2
FORCING_MODE: legacy
BATCH_SIZE: 4
TIME_SERIES_LENGTH: 365
STEPS_PER_DAY: 1
YEARS_IN_DATA: 1
SURFACE PROPERTIES:
AREA, PCT_SAND, PCT_CLAY
SCALAR VARIABLES:
GPP, NPP
1D PFT VARIABLES:
tlai
2D VARIABLES:
soil1c_vr
PFT PARAMETERS:
pft_leafcn
"""


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("run"))
    text = CONFIG.format(out=f"{d}/out", src=f"{d}/src")
    (tmp_path_factory.getbasetemp() / "run.txt").write_text(text)
    make = spark.createDataFrame
    make([(i, float(i), 10.0 * i, int(i != 2)) for i in range(N)], "cell_idx int, lat double, lon double, landmask int").write.parquet(f"{d}/src/ds2")
    cells = [(i, i) for i in range(N)]
    days = [float(k) for k in range(365)]
    forcing = {f"ds{k}": make([(i, [x + i for x in days]) for i in range(N)], f"forcing_idx long, {v} array<double>") for k, v in zip(range(4, 10), ("FLDS", "PBOT", "FSDS", "QBOT", "PRECmms", "TBOT"), strict=True)}
    given = {
        "ds1": make([(*c, f" {c[0]}.5 ") for c in cells], "lat_idx int, lon_idx int, AREA string"),
        "ds1_layers": make([(*c, k, float(k), None if k else 1.0) for c in cells for k in range(3)], "lat_idx int, lon_idx int, level int, PCT_SAND double, PCT_CLAY double"),
        "ds2_history": make([(t, *c, 0.5, 10.0 * t) for c in cells for t in range(2)], "time_idx int, lat_idx int, lon_idx int, LANDFRAC_PFT double, GPP double"),
        "h0_list": make([(0, *c, 1.0, 2.0) for c in cells], "time_idx int, lat_idx int, lon_idx int, GPP double, NPP double"),
        "ds10_mesh": make([(i, float(i), 10.0 * i) for i in range(N)], "restart_idx long, lat double, lon double"),
        "ds4_mesh": make([(i, float(i), 10.0 * i) for i in range(N)], "forcing_idx long, lat double, lon double"),
        "ds10_pfts": make([(p, p // 2 + 1, float(p)) for p in range(8)], "pos long, gridcell_id long, tlai double"),
        "ds10_columns": make([(p, p + 1, [1.0, 2.0]) for p in range(N)], "pos long, gridcell_id long, soil1c_vr array<double>"),
        "r_pfts": make([(0, 1, 5.0)], "pos long, gridcell_id long, tlai double"),
        "r_columns": make([(0, [7.0, 8.0])], "pos long, soil1c_vr array<double>"),
        "clm_params": make([("leafcn", [1.0] * 20), ("bad", [None])], "name string, vals array<double>"),
    } | forcing
    s = modules.Sources(spark, config.from_text(text), given)
    return s, str(tmp_path_factory.getbasetemp() / "run.txt")


def test_whole_run(spark, run):
    s, path = run
    with pytest.raises(ValueError, match="no modules"):
        runs.extract(s, ["A_nothing"])
    assert len(runs.extract(s)) == 12
    assert s.warnings == ["history: no NPP"]
    assert runs.extract(s, "all", force=False) == []
    assert cli.main(["--config", path, "assemble"], spark) == 0
    with pytest.raises(Exception, match="(?i)exists"):
        cli.main(["--config", path, "assemble"], spark)
    assert cli.main(["--config", path, "assemble", "--overwrite"], spark) == 0
    df = spark.read.parquet(f"{s.config.output}/final_dataset").orderBy("__row_id")
    got = df.collect()
    assert len(got) == N - 1 and [r.batch_id for r in got] == [1, 1, 1, 1, 2]
    last = got[-1]
    assert (last.AREA, last.landfrac, last.GPP, last.Y_NPP) == (5.5, 0.5, 0.0, 2.0)
    assert (last.PCT_SAND_0, last.PCT_SAND_2, last.PCT_CLAY_0, last.PCT_CLAY_1) == (0.0, 2.0, 1.0, 0.0)
    assert last.tlai is None and last.soil1c_vr is None and got[0].tlai == [0.0, 1.0] and got[0].soil1c_vr == [[1.0, 2.0]]
    assert got[0].Y_tlai == [5.0] and got[1].Y_tlai is None and got[0].Y_soil1c_vr == [[7.0, 8.0]] and len(last.pft_leafcn) == 17
    assert len(last.PSRF) == 12 and last.PSRF[0] == 20.0 and len(last.PRECTmms) == 12
    names = [c for c in df.columns if c != "batch_id"]
    assert names == sorted(names, key=lambda c: c.startswith("Y_"))
    assert cli.main(["--config", path, "validate"], spark) == 0
    assert cli.main(["--config", path, "validate", "--max-batches", "1", "--sample-rows", "2"], spark) == 0


def test_modules_read_what_they_declare(run):
    s, _ = run
    index = tables.artifact(s.spark, runs.artifacts(s.config), modules.INDEX)
    s.read.clear()
    modules.build_index(s)
    assert s.read <= set(modules.needs(s.config, modules.INDEX)[0])
    for name in modules.registry(s.config):
        s.read.clear()
        modules.build(s, name, index)
        assert s.read and s.read <= set(modules.needs(s.config, name)[0]), name


@pytest.fixture
def from_files(spark, run, tmp_path):
    """A function that gives sources anew from folders of Parquet tables under tmp_path; text is added to the run file."""
    s, _ = run
    d = str(tmp_path)
    names = {"ds2": ("ds2", "mesh"), "ds1": ("ds1", "cells"), "ds1_layers": ("ds1", "layers"), "ds2_history": ("ds2", "history"), "ds10_mesh": ("ds10", "mesh"), "ds4_mesh": ("ds4", "mesh"), "ds10_pfts": ("ds10", "pfts"), "ds10_columns": ("ds10", "columns"), "clm_params": ("clm", "parameters"), **{f"ds{k}": (f"ds{k}", "series") for k in range(4, 10)}}
    for key, (folder, kind) in names.items():
        s[key].coalesce(1).write.parquet(f"{d}/src/{folder}/{kind}")
    paths = "".join(f"DS{k}_PATH: {d}/src/ds{k}\n" for k in (1, 4, 5, 6, 7, 8, 9, 10)) + f"CLM_PARAMS_PATH: {d}/src/clm\n"

    def make(text=lambda t: t):
        whole = text(paths + CONFIG.format(out=f"{d}/out", src=f"{d}/src"))
        return modules.Sources(spark, config.from_text(whole))

    return make


def test_only_what_changed_is_built(spark, from_files, tmp_path):
    """One forcing file touches one module; a setting the modules that depend on it; the index all that build on it."""
    s = from_files()
    every = [m for m in config.MODULES if m != modules.INDEX and not m.endswith("_y")]
    assert runs.extract(s, "all", force=False) == every
    assert runs.extract(from_files(), "all", force=False) == []
    kept = sinks.read_manifest(spark, runs.manifests(s.config), "A_forcing_ds6_fsds")
    assert [x["path"] for x in kept["sources"]] == [f"{tmp_path}/src/ds6"]
    s["ds7"].limit(0).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src/ds7/series")
    assert runs.extract(from_files(), "all", force=False) == ["A_forcing_ds7_qbot"]
    fewer = lambda t: t.replace("AREA, PCT_SAND", "PCT_SAND")
    assert runs.extract(from_files(fewer), "all", force=False) == ["A_ds1_surface"]
    assert runs.extract(from_files(), "all", force=False) == ["A_ds1_surface"]
    # of 5 cells in batches of 4
    smaller = lambda t: t.replace("BATCH_SIZE: 4", "BATCH_SIZE: 3")
    assert runs.extract(from_files(smaller), ["A_ds1_surface", modules.INDEX], force=False) == ["A_ds1_surface"]
    assert {r.batch_id: r["count"] for r in tables.artifact(spark, runs.artifacts(s.config), "A_ds1_surface").groupBy("batch_id").count().collect()} == {1: 3, 2: 2}
    # the index has changed under the others
    assert runs.extract(from_files(smaller), "all", force=False) == [m for m in every if m != "A_ds1_surface"]


def test_batches_alone_are_built(spark, from_files, tmp_path):
    from pathlib import Path

    with pytest.raises(FileNotFoundError, match="A_index_core"):
        runs.extract(from_files(), ["A_ds1_surface"], batches=[2])
    runs.extract(from_files(), ["A_ds1_surface"])
    root = Path(tmp_path) / "out/artifacts/A_ds1_surface"
    files = lambda: {p for p in root.rglob("*.parquet")}
    before, rows = files(), tables.artifact(spark, str(root.parent), root.name).orderBy("__row_id").collect()
    assert runs.extract(from_files(), ["A_ds1_surface"], batches=[2]) == ["A_ds1_surface"]
    assert before < files()
    [(part, held), (_, whole)] = versions.layers(spark, str(root))
    assert held == [2] and whole is None and [r.batch_id for r in spark.read.parquet(part).collect()] == [2]
    assert tables.artifact(spark, str(root.parent), root.name).orderBy("__row_id").collect() == rows


def numbered(spark, n, size, shift=0):
    return spark.range(n).select(F.col("id").alias("__row_id"), (F.col("id") / size + 1).cast("int").alias("batch_id"), (F.col("id") + shift).alias("v"))


def test_files_hold_ranges_of_batches(spark, tmp_path):
    """Files follow bytes; each holds a run of batches that no other holds, and one batch reads one file."""
    root = str(tmp_path)
    df = numbered(spark, 20_000, 10).withColumn("text", F.sha2(F.col("v").cast("string"), 512)).repartition(7)
    folder = sinks.write_artifact(df, root, "A", size=200_000)
    held = spark.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("batch_id").alias("a"), F.max("batch_id").alias("b"), F.count("*").alias("n")).orderBy("a").collect()
    assert 4 < len(held) < 20 and sum(r.n for r in held) == 20_000 and held[0].a == 1 and held[-1].b == 2000
    assert all(x.b + 1 == y.a for x, y in zip(held, held[1:], strict=False)) and max(r.n for r in held) <= 2 * min(r.n for r in held[:-1])
    one = tables.artifact(spark, root, "A", 1234)
    assert one.agg(F.count("*"), F.min("__row_id"), F.max("__row_id")).first() == (10, 12330, 12339)
    assert "PushedFilters: [IsNotNull(batch_id), EqualTo(batch_id,1234)]" in one._jdf.queryExecution().toString()
    in_order = [r[0] for r in spark.read.parquet(f"{folder}/{held[2].f}").select("__row_id").collect()]
    assert in_order == sorted(in_order)


def test_parts_over_a_version(spark, tmp_path):
    """The newest writing of a batch counts; parts are put together in the end; an unfinished part doesn't count; a batch may lose its rows."""
    root, path = str(tmp_path), f"{tmp_path}/A"
    with pytest.raises(FileNotFoundError, match="no whole version"):
        sinks.write_artifact(numbered(spark, 8, 2), root, "A", [1])
    sinks.write_artifact(numbered(spark, 8, 2), root, "A")
    total = lambda: {r.batch_id: r.v for r in tables.artifact(spark, root, "A").groupBy("batch_id").agg(F.sum("v").alias("v")).collect()}
    assert total() == {1: 1, 2: 5, 3: 9, 4: 13}
    sinks.write_artifact(numbered(spark, 8, 2, 10), root, "A", [2, 3])
    sinks.write_artifact(numbered(spark, 8, 2, 100), root, "A", [3, 4])
    assert total() == {1: 1, 2: 25, 3: 209, 4: 213}
    assert tables.artifact(spark, root, "A", 2).agg(F.sum("v")).first()[0] == 25 and tables.artifact(spark, root, "A", 1).count() == 2
    numbered(spark, 8, 2, 1000).where("batch_id = 1").write.parquet(f"{path}/v00000099-00000000")
    assert total() == {1: 1, 2: 25, 3: 209, 4: 213}
    sinks.write_artifact(numbered(spark, 8, 2).where("batch_id <> 4").withColumn("more", F.lit(1)), root, "A", [2, 4])
    assert total() == {1: 1, 2: 5, 3: 209} and tables.artifact(spark, root, "A").where("more = 1").count() == 2
    with pytest.raises(FileNotFoundError, match="no batch 4"):
        tables.artifact(spark, root, "A", 4)
    for k in range(versions.PARTS - 2):
        sinks.write_artifact(numbered(spark, 8, 2, k), root, "A", [1])
    assert [b for _, b in versions.layers(spark, path)] == [None] and total() == {1: 2 * k + 1, 2: 5, 3: 209}
    sinks.write_artifact(numbered(spark, 0, 2), root, "A")
    assert total() == {} and tables.artifact(spark, root, "A").columns == ["__row_id", "batch_id", "v"]


def test_forcing_is_replaced_whole(spark, tmp_path):
    """A write that fails half-way changes nothing; plans made on the version before still run."""
    import os

    path = f"{tmp_path}/forcing/FLDS"
    series = spark.range(100).select(F.col("id").alias("gridcell"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.array(F.lit(1.5)).alias("series"))
    total = lambda df: df.agg(F.sum(F.col("series")[0])).first()[0]
    assert tables.artifact_or_none(spark, f"{tmp_path}/forcing", "FLDS") is None and versions.current(spark, path) is None
    first = sinks.write_forcing(series, path, 2000, 2001)
    assert versions.current(spark, path) == first and os.path.exists(f"{first}/_complete")
    planned = tables.artifact(spark, f"{tmp_path}/forcing", "FLDS")
    broken = series.repartition(4, "gridcell").withColumn("series", F.when(F.col("gridcell") == 99, F.array(F.raise_error(F.lit("killed")).cast("double"))).otherwise(F.array(F.lit(9.0))))
    with pytest.raises(Exception, match="killed"):
        sinks.write_forcing(broken, path, 2000, 2001)
    assert versions.current(spark, path) == first and total(tables.artifact(spark, f"{tmp_path}/forcing", "FLDS")) == 150.0
    # killed after all files were there, before the mark
    half = f"{path}/v00000007-0123abcd"
    series.write.parquet(half)
    assert versions.current(spark, path) == first
    second = sinks.write_forcing(series.withColumn("series", F.array(F.lit(2.5))), path, 2000, 2001)
    assert second > half and total(tables.artifact(spark, f"{tmp_path}/forcing", "FLDS")) == 250.0 and total(planned) == 150.0
    third = sinks.write_forcing(series, path, 2000, 2001)
    assert [f"{path}/{n}" for n, _ in versions.listed(spark, path)] == [second, third]


def test_one_batch_reaches_the_scan(spark, run):
    s, _ = run
    one = tables.artifact(spark, runs.artifacts(s.config), modules.INDEX, 2)
    assert one.count() == 1 and "PushedFilters: [IsNotNull(batch_id), EqualTo(batch_id,2)]" in one._jdf.queryExecution().toString()
    with pytest.raises(FileNotFoundError):
        tables.artifact(spark, runs.artifacts(s.config), modules.INDEX, 99)
    assert tables.artifact_or_none(spark, runs.artifacts(s.config), "A_none") is None


def test_missing_modules_are_named(spark, run, tmp_path):
    s, _ = run
    c = config.from_text(CONFIG.format(out=tmp_path / "part", src="none"))
    sinks.write_artifact(tables.artifact(spark, runs.artifacts(s.config), modules.INDEX), runs.artifacts(c), modules.INDEX)
    _, missing = runs.assemble_final(spark, c)
    assert len(missing) == 12


def test_replace_forcing(spark, run, tmp_path):
    s, path = run
    d = str(tmp_path)
    spark.createDataFrame([(i, float(5 - i)) for i in range(6)], "lat_idx long, lat double").write.parquet(f"{d}/f/lat")
    spark.createDataFrame([(i, 10.0 * i) for i in range(6)], "lon_idx long, lon double").write.parquet(f"{d}/f/lon")
    cube = [(i, j, *[[float(10 * i + j)]] * 6) for i in range(6) for j in range(6)]
    spark.createDataFrame(cube, "lat_idx long, lon_idx long, " + ", ".join(f"{v} array<double>" for v in ("FLDS", "PBOT", "FSDS", "QBOT", "PRECmms", "TBOT"))).write.parquet(f"{d}/f/cube")
    assert cli.main(["--config", path, "replace", "--old", f"{s.config.output}/final_dataset", "--forcing", f"{d}/f", "--out", f"{d}/new"], spark) == 0
    old, new = (spark.read.parquet(p) for p in (f"{s.config.output}/final_dataset", f"{d}/new"))
    assert new.columns == old.columns
    assert {r.Latitude: r.PSRF for r in new.collect()} == {float(i): [float(10 * (5 - i) + i)] for i in (0, 1, 3, 4, 5)}


def test_prepare_forcing(spark, tmp_path):
    c = config.from_text(f"BASE_OUTPUT_ROOT: {tmp_path}\nDATM_START_YEAR: 2000\nDATM_END_YEAR: 2000\nDATM_FLDS_TOKEN: T")
    paths = spark.createDataFrame([(f"/r/clmforc.v.T.2000-{m:02}.nc",) for m in range(1, 13)], "path string")
    steps = paths.crossJoin(spark.range(3).selectExpr("id AS time_idx")).crossJoin(spark.range(2).selectExpr("id AS cell")).withColumn("value", F.when(F.col("time_idx") == 2, float("nan")).otherwise(F.col("time_idx") + F.substring("path", -5, 2).cast("double")))
    points = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 4.0)], "cell long, lat double, lon double")
    made = runs.prepare_forcing(spark, c, {"FLDS": (steps, points, paths)}, points)
    got = spark.read.parquet(made["FLDS"]).orderBy("gridcell").first()
    assert got.series == [m + 0.5 for m in range(1, 13)] and got.lat == 1.0
    assert runs.prepare_forcing(spark, c, {"FLDS": (None, None, None)}) == made


def test_union_of_batches(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(1, 2)], "x int, y int")
    assert runs.union_of([a, b]).columns == ["x", "y"]


def test_datm_run(spark, tmp_path):
    """Monthly files to consolidated tables to artifacts, by index, through the command line."""
    text = f"""BASE_OUTPUT_ROOT: {tmp_path}/out
DS2_PATH: {tmp_path}/ds2
FORCING_MODE: datm
DATM_ROOT: {tmp_path}/raw
DATM_START_YEAR: 2000
DATM_END_YEAR: 2000
DATM_QBOT_TOKEN: T
"""
    (tmp_path / "run.txt").write_text(text)
    mesh = [(i, float(i), 10.0 * i, 1) for i in range(3)]
    spark.createDataFrame(mesh, "cell_idx int, lat double, lon double, landmask int").write.parquet(f"{tmp_path}/ds2")
    steps = [(f"/r/clmforc.v.T.2000-{m:02}.nc", t, c, float(m + t + c)) for m in range(1, 13) for t in range(2) for c in range(3)]
    spark.createDataFrame(steps, "path string, time_idx int, cell long, value double").write.parquet(f"{tmp_path}/raw/QBOT/steps")
    spark.createDataFrame([(i, 0.0, 0.0) for i in range(3)], "cell long, lat double, lon double").write.parquet(f"{tmp_path}/raw/QBOT/cells")
    s = modules.Sources(spark, config.from_text(text), {"ds10_mesh": spark.createDataFrame([(i, float(i), 10.0 * i) for i in range(3)], "restart_idx long, lat double, lon double")})
    ready = runs.with_prepared_forcing(s, ["A_forcing_ds7_qbot"])
    assert runs.extract(ready, ["A_forcing_ds7_qbot"]) == ["A_forcing_ds7_qbot"]
    got = tables.artifact(spark, runs.artifacts(s.config), "A_forcing_ds7_qbot").orderBy("__row_id").collect()
    assert [r.QBOT[0] for r in got] == [1.5, 2.5, 3.5] and len(got[0].QBOT) == 12
    index = tables.artifact(spark, runs.artifacts(s.config), modules.INDEX).collect()
    assert all(r.nearest_forcing_index == r.nearest_restart_index == r.lat_idx == r.gridcell_id - 1 for r in index)
    with pytest.raises(FileNotFoundError):
        cli.main(["--config", str(tmp_path / "run.txt"), "prepare"], spark)
