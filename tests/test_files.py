"""Whole runs from a configuration alone: NetCDF files (read through a stand-in), folders of tables, and monthly forcing."""

import netCDF4
import numpy as np
import pytest

from meshloom import cli, config
from meshloom.plans import modules
from meshloom.sources import files, netcdf

if not hasattr(netCDF4, "write"):
    pytest.skip("the real netCDF4 is first on the path", allow_module_level=True)

FORCING = {"ds4": "FLDS", "ds5": "PBOT", "ds6": "FSDS", "ds7": "QBOT", "ds8": "PRECmms", "ds9": "TBOT"}
TEXT = """
BASE_OUTPUT_ROOT: {out}
DS1_PATH: {src}/ds1{ext}
DS2_PATH: {src}/ds2{ext}
DS4_PATH: {src}/ds4{ext}
DS5_PATH: {src}/ds5{ext}
DS6_PATH: {src}/ds6{ext}
DS7_PATH: {src}/ds7{ext}
DS8_PATH: {src}/ds8{ext}
DS9_PATH: {src}/ds9{ext}
DS10_PATH: {src}/ds10{ext}
H0_LIST_PATHS: {src}/h0{ext}
R_LIST_PATHS: {src}/r{ext}
CLM_PARAMS_PATH: {src}/params{ext}
{mode}
BATCH_SIZE: 4
TIME_SERIES_LENGTH: 365
STEPS_PER_DAY: 1
YEARS_IN_DATA: 1
SURFACE PROPERTIES:
• AREA, PCT_SAND, PCT_CLAY
SCALAR VARIABLES:
• GPP, NPP
1D PFT VARIABLES:
• tlai
2D VARIABLES:
• soil1c_vr
PFT PARAMETERS:
• pft_leafcn, pft_bad, pft_absent
"""
LAT, LON = np.array([0.0, 10.0, 20.0]), np.array([0.0, 30.0, 60.0, 90.0])


def write_sources(d, flat):
    """The same land either as a grid of 3 x 4 cells or as a list of 12; cell 5 is ocean."""
    grid = lambda x: (["cell"], x.ravel()) if flat else (["lat", "lon"], x.reshape(3, 4))
    after = lambda dim, x: ([dim, "cell"], x.reshape(-1, 12)) if flat else ([dim, "lat", "lon"], x.reshape(-1, 3, 4))
    n = np.arange(12.0)
    lats, lons = np.repeat(LAT, 4), np.tile(LON, 3)
    mesh = {"lat": (["cell"], lats), "lon": (["cell"], lons)} if flat else {"lat": (["lat"], LAT), "lon": (["lon"], LON)}
    sand = np.stack([n + 100 * k for k in range(3)])
    sand[0, 1] = netCDF4.FILL
    netCDF4.write(f"{d}/ds1.nc", AREA=grid(n * 2), PCT_SAND=after("level", sand), PCT_CLAY=after("level", sand + 1))
    netCDF4.write(f"{d}/ds2.nc", **mesh, landmask=grid((n != 5).astype(np.int64)), landfrac=grid(n / 12), GPP=after("time", np.stack([n, n * 0 - 1])))
    netCDF4.write(f"{d}/h0.nc", GPP=after("time", np.stack([n * 3, n])), NPP=after("time", np.stack([n * 4, n])))
    days = np.arange(365.0)
    for k, (ds, v) in enumerate(FORCING.items()):
        x = days[:, None] + n + 1000 * k
        netCDF4.write(f"{d}/{ds}.nc", LATIXY=grid(lats), LONGXY=grid(lons), **{v: (["cell", "time"], x.T) if flat and k == 1 else after("time", x)})
    pft, column = np.repeat(np.arange(1, 13), 2)[:-2], np.arange(1, 13)  # cell 12 has no PFTs
    netCDF4.write(f"{d}/ds10.nc", grid1d_lat=(["g"], lats), grid1d_lon=(["g"], lons), pfts1d_gridcell_index=(["p"], pft), cols1d_gridcell_index=(["c"], column), tlai=(["p"], np.arange(22.0)), soil1c_vr=(["c", "lev"], np.arange(24.0).reshape(12, 2)))
    netCDF4.write(f"{d}/r.nc", tlai=(["p"], np.arange(22.0) + 0.5), soil1c_vr=(["c", "lev"], np.arange(24.0).reshape(12, 2) + 0.5))
    netCDF4.write(f"{d}/params.nc", leafcn=(["pft"], np.arange(20.0)), bad=(["pft"], np.where(np.arange(20) == 3, np.nan, 1.0)))


def read(spark, path):
    return spark.read.parquet(f"{path}/final_dataset").orderBy("__row_id").collect()


def check(got):
    assert len(got) == 11 and [r.batch_id for r in got] == [1] * 4 + [2] * 4 + [3] * 3
    cells = [i for i in range(12) if i != 5]
    for r, i in zip(got, cells, strict=True):
        assert (r.Latitude, r.Longitude) == (LAT[i // 4], LON[i % 4])
        assert (r.AREA, r.landfrac, r.GPP, r.Y_GPP, r.Y_NPP) == (2.0 * i, i / 12, float(i), 3.0 * i, 4.0 * i)
        assert (r.PCT_SAND_0, r.PCT_SAND_2, r.PCT_CLAY_1) == (0.0 if i == 1 else float(i), 200.0 + i, 101.0 + i)
        assert r.tlai == ([2.0 * i, 2.0 * i + 1] if i < 11 else None) and r.Y_tlai == ([2 * i + 0.5, 2 * i + 1.5] if i < 11 else None)
        assert r.soil1c_vr == ([[2.0 * i, 2.0 * i + 1]] if i < 11 else None) and r.Y_soil1c_vr == ([[2 * i + 0.5, 2 * i + 1.5]] if i < 11 else None)
        assert (r.FLDS[0], r.PSRF[0], r.TBOT[11]) == (15.0 + i, 1015.0 + i, 5349.0 + i) and len(r.PSRF) == 12
        assert r.pft_leafcn == [float(k) for k in range(17)]
    assert "pft_bad" not in got[0] and "pft_absent" not in got[0]


def run(spark, tmp_path, text, *more):
    path = tmp_path / "run.txt"
    path.write_text(text)
    assert cli.main(["--config", str(path), "extract", "--build", "all", *more], spark) == 0
    assert cli.main(["--config", str(path), "assemble"], spark) == 0
    assert cli.main(["--config", str(path), "validate"], spark) == 0
    return config.from_text(text)


@pytest.mark.parametrize("flat", [True, False])
def test_from_netcdf_and_from_tables(spark, tmp_path, flat):
    write_sources(tmp_path, flat)
    c = run(spark, tmp_path, TEXT.format(out=f"{tmp_path}/out", src=tmp_path, ext=".nc", mode="FORCING_MODE: legacy"))
    first = read(spark, c.output)
    check(first)
    records = [r.value for r in spark.read.text(f"{c.output}/records/*").collect()]
    assert sum(r.startswith("source ") for r in records) == 12 and "built A_ds1_surface" in records
    # the same files converted to folders of tables
    s = modules.Sources(spark, c)
    for key, (source, kind) in modules.TABLES.items():
        name = {"h0_list": "h0", "r_list": "r", "clm_params": "params"}.get(source, source)
        s[key].write.parquet(f"{tmp_path}/tables/{name}/{kind}" if key != "ds4_mesh" else f"{tmp_path}/tables/ds4/mesh")
    text = TEXT.format(out=f"{tmp_path}/again", src=f"{tmp_path}/tables", ext="", mode="FORCING_MODE: legacy")
    assert read(spark, run(spark, tmp_path, text).output) == first


def test_monthly_netcdf(spark, tmp_path):
    """The default mode: monthly files are found by token, averaged and mapped by index."""
    assert config.from_text("").mode == "datm"
    write_sources(tmp_path, True)
    tokens = {"FLDS": "TPQWL", "PSRF": "TPQWL", "FSDS": "Solr", "QBOT": "TPQWL", "PRECTmms": "Prec", "TBOT": "TPQWL"}
    (tmp_path / "forcing" / "deep").mkdir(parents=True)
    n, steps = np.arange(12.0), np.arange(4.0)
    lats, lons = (["time", "cell"], np.tile(np.repeat(LAT, 4), (4, 1))), (["time", "cell"], np.tile(np.tile(LON, 3), (4, 1)))
    for m in range(1, 13):
        for token in set(tokens.values()):
            values = {}
            for k, (v, t) in enumerate(tokens.items()):
                if t == token:
                    x = 100 * k + 10 * m + steps[:, None] + n
                    x[3, 2] = netCDF4.FILL
                    values[v] = (["time", "cell"], x)
            netCDF4.write(f"{tmp_path}/forcing/deep/clmforc.x.{token}.2000-{m:02}.nc", LATIXY=lats, LONGXY=lons, **values)
    mode = "\n".join([f"DATM_ROOT: {tmp_path}/forcing", "DATM_START_YEAR: 2000", "DATM_END_YEAR: 2000", *(f"DATM_{v.upper()}_TOKEN: {t}" for v, t in tokens.items())])
    c = run(spark, tmp_path, TEXT.format(out=f"{tmp_path}/out", src=tmp_path, ext=".nc", mode=mode))
    got = read(spark, c.output)
    assert [r.FLDS[0] for r in got[:4]] == [11.5, 12.5, 13.0, 14.5]
    assert [r.TBOT[11] for r in got[:2]] == [621.5, 622.5] and len(got[0].TBOT) == 12


def test_reader_in_batches(tmp_path, monkeypatch):
    path = f"{tmp_path}/x.nc"
    values = np.arange(60.0).reshape(5, 3, 4)
    values[1, 2, 3] = netCDF4.FILL
    netCDF4.write(path, a=(["time", "lat", "lon"], values), b=(["time", "lat", "lon"], values + 1), g=(["time", "cell"], np.full((2, 2), np.nan)))
    monkeypatch.setattr(netcdf, "BATCH", 24)
    reader = netcdf.NetCDFReader({"path": path, "variables": "a, b", "dims": "time,lat,lon", "blocks": "2"})
    parts = reader.partitions()
    batches = [b for p in parts for b in reader.read(p)]
    assert len(parts) == 2 and all(b.num_rows <= 24 for b in batches)
    rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
    assert len(rows) == 60 and rows[13] == (1, 0, 1, 13.0, 14.0) and rows[23][3] is None
    first = netcdf.NetCDFReader({"path": path, "variables": "a", "dims": "time,lat,lon", "first": "true"})
    rows = [tuple(r.values()) for p in first.partitions() for b in first.read(p) for r in b.to_pylist()]
    assert rows == [(i, j, 4.0 * i + j) for i in range(3) for j in range(4)]
    nan = next(netcdf.NetCDFReader({"path": path, "variables": "g", "dims": "time,cell"}).read(netcdf.Block(path)))
    assert nan.column(2).null_count == 0
    with pytest.raises(ValueError, match="dimensions"):
        netcdf.NetCDFReader({"path": path, "variables": "a", "dims": "time"}).partitions()


def reader_of(path, **options):
    return netcdf.NetCDFReader({"path": path, "variables": "a", "dims": "time,lat,lon", **options})


def elements(slabs):
    return sum(np.prod([b - a for a, b in p.value[1]]) for p in slabs)


def test_reader_in_blocks(tmp_path, monkeypatch):
    """Blocks along any dimension hold what lies there, in order; hyperslabs are cut until they are small."""
    path, values = f"{tmp_path}/x.nc", np.arange(7 * 3 * 4.0).reshape(7, 3, 4)
    values[5, 2, 3] = netCDF4.FILL
    netCDF4.write(path, a=(["time", "lat", "lon"], values))
    for slab in (1 << 20, 30):
        monkeypatch.setattr(netcdf, "SLAB", slab)
        for along, length in (("time", 3), ("lat", 2), ("lon", 4), ("time", 100)):
            reader = reader_of(path, along=along, length=str(length), blocks="1")
            slabs = reader.partitions()
            assert elements(slabs) == 84 and (slab > 84 or len(slabs) > 1 or length == 100)
            k = ["time", "lat", "lon"].index(along)
            turned, got = np.moveaxis(values, k, -1), 0
            for row in (r for p in slabs for b in reader.read(p) for r in b.to_pylist()):
                *at, first, found = row.values()
                want = [None if x == netCDF4.FILL else x for x in turned[tuple(at)][first : first + length]]
                assert found == want and first % length == 0
                got += len(found)
            assert got == 84
    with pytest.raises(ValueError, match="level"):
        reader_of(path, along="level")


def test_conditions_reach_the_reader(spark, tmp_path):
    """A box or a range of steps plans and reads only its hyperslabs, with the result of a filter behind the scan."""
    path, values = f"{tmp_path}/x.nc", np.arange(40 * 6 * 5.0).reshape(40, 6, 5)
    netCDF4.write(path, a=(["time", "lat", "lon"], values))
    netcdf.register(spark)

    def both(where, **options):
        source = lambda **o: spark.read.format("netcdf").options(path=path, variables="a", dims="time,lat,lon", **options, **o).load()
        df = source().where(where)
        plain = spark.createDataFrame(source().collect(), source().schema).where(where)
        assert sorted(map(str, df.collect())) == sorted(map(str, plain.collect()))
        return df._jdf.queryExecution().executedPlan().toString()

    plan = both("lat_idx BETWEEN 2 AND 3 AND lon_idx > 3 AND time_idx = 7")
    assert "Filter (" not in plan
    assert "Filter (" in both("lat_idx IN (1, 4) AND a > 10")  # the ends are taken up, the rest is tested again
    assert both("lat_idx > 100") and both("lat_idx > 4 AND lat_idx < 2")
    assert both("time_first >= 12 AND time_first < 33 AND lon_idx = 0", along="time", length="8")
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    reader = reader_of(path)
    conditions = [GreaterThanOrEqual(("lat_idx",), 2), LessThan(("lat_idx",), 4), EqualTo(("lon_idx",), 1), EqualTo(("a",), 3.0)]
    assert list(reader.pushFilters(conditions)) == conditions[3:]
    assert elements(reader.partitions()) == 40 * 2 * 1
    reader = reader_of(path, along="time", length="8")
    assert list(reader.pushFilters([GreaterThanOrEqual(("time_first",), 9), LessThan(("time_first",), 25)])) == []
    assert {p.value[1][0] for p in reader.partitions()} <= {(16, 24), (24, 32), (16, 32)} and elements(reader.partitions()) == 16 * 30


def test_conditions_on_files(spark, tmp_path):
    paths = [f"{tmp_path}/{k}.nc" for k in range(3)]
    for k, p in enumerate(paths):
        netCDF4.write(p, a=(["time", "cell"], np.arange((k + 2) * 4.0).reshape(k + 2, 4)))
    df = files.monthly_steps(spark, paths, "a")
    assert df.count() == 4 * (2 + 3 + 4)
    some = df.where(f"path = '{paths[2]}' AND cell = 1")
    assert sorted((r.time_idx, r.value) for r in some.collect()) == [(0, 1.0), (1, 5.0), (2, 9.0), (3, 13.0)]
    assert df.where("path = 'none'").count() == 0


def test_missing_sources_are_named(spark, tmp_path):
    s = modules.Sources(spark, config.from_text(f"DS1_PATH: {tmp_path}/none"))
    assert "ds1" not in s and "ds2" not in s
    with pytest.raises(KeyError, match="none"):
        s["ds1"]
    with pytest.raises(KeyError, match="no path"):
        s["ds2"]
    netCDF4.write(f"{tmp_path}/a.nc", x=(["a", "b", "c", "d"], np.zeros((1, 1, 1, 1))))
    f = files.NetCDFFile(spark, f"{tmp_path}/a.nc")
    with pytest.raises(ValueError, match="dimensions"):
        f.of_cells(["x"], [])
    with pytest.raises(KeyError, match="y"):
        f.of_cells(["y"], [])


def test_replace_from_netcdf(spark, tmp_path):
    """Forcing columns of a written dataset from the nearest cells of a NetCDF file, with a manifest, a log and a record of the run."""
    lat, lon = np.array([20.0, 10.0, 0.0]), np.array([0.0, 90.0, 180.0, 270.0])
    values = {v: 1000.0 * k + 100 * np.arange(3.0)[:, None] + 10 * np.arange(4.0) + np.arange(5.0)[:, None, None] for k, v in enumerate(FORCING.values())}
    values["TBOT"][2, 0, 3] = netCDF4.FILL
    netCDF4.write(f"{tmp_path}/f.nc", lat=(["lat"], lat), lon=(["lon"], lon), **{v: (["time", "lat", "lon"], x) for v, x in values.items()})
    rows = [(0, 1, 19.0, -80.0, [7.0], "a"), (1, 1, 2.0, 46.0, None, "b"), (2, 2, 15.0, 44.0, [1.0], None), (3, 2, 15.0, 44.0, [], "d")]
    spark.createDataFrame(rows, "__row_id long, batch_id int, Latitude double, Longitude double, FLDS array<double>, other string").write.parquet(f"{tmp_path}/old")
    (tmp_path / "run.txt").write_text(f"BASE_OUTPUT_ROOT: {tmp_path}/out\nFORCING_MODE: legacy\n")
    call = ["--config", f"{tmp_path}/run.txt", "replace", "--old", f"{tmp_path}/old", "--forcing", f"{tmp_path}/f.nc", "--out", f"{tmp_path}/new"]
    assert cli.main(call, spark) == 0
    new = spark.read.parquet(f"{tmp_path}/new").orderBy("__row_id")
    assert new.columns == ["__row_id", "batch_id", "Latitude", "Longitude", "FLDS", "other", "PSRF", "FSDS", "QBOT", "PRECTmms", "TBOT"]
    got = new.collect()
    # -80 is 280 east; of two latitudes equally near the lower one counts
    for r, (i, j) in zip(got, [(0, 3), (2, 1), (1, 0), (1, 0)], strict=True):
        assert r.FLDS == [float(x) for x in values["FLDS"][:, i, j]] and r.PRECTmms == [float(x) for x in values["PRECmms"][:, i, j]]
    assert got[0].TBOT == [5030.0, 5031.0, None, 5033.0, 5034.0] and [r.other for r in got] == ["a", "b", None, "d"]
    record = [r.value for r in spark.read.text(f"{tmp_path}/out/records/*").collect()]
    assert "header forcing: dimension lat: 3" in record and any(x.startswith("header forcing: variable PBOT: dimensions ('time', 'lat', 'lon'), sizes (5, 3, 4)") for x in record)
    assert "config FORCING_MODE: legacy" in record and "replaced PSRF by PBOT" in [r.value for r in spark.read.text(f"{tmp_path}/out/log").collect()]
    with pytest.raises(FileExistsError):
        cli.main(call, spark)
    assert cli.main([*call, "--overwrite", "--column", "X=TBOT", "--records", f"{tmp_path}/kept"], spark) == 0
    again = spark.read.parquet(f"{tmp_path}/new").orderBy("__row_id").collect()
    assert again[0].X == got[0].TBOT and again[0].FLDS == [7.0] and "wrote 4 rows" in spark.read.text(f"{tmp_path}/kept/log").first().value + spark.read.text(f"{tmp_path}/kept/log").tail(1)[0].value
    source = files.NetCDFFile(spark, f"{tmp_path}/f.nc")
    with pytest.raises(ValueError, match="not time, lat and lon"):
        source.grid_blocks("lat")
    with pytest.raises(KeyError, match="NONE"):
        source.grid_blocks("NONE")
    assert [len(r.TBOT) for r in source.grid_blocks("TBOT", 2).where("lat_idx = 0 and lon_idx = 3").orderBy("first").collect()] == [2, 2, 1]
