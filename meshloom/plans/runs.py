"""Whole runs: extraction to artifacts, forcing preparation, assembly, replacement and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FORCING, LAYERED, MODULES, Config
from ..operators import assemble, calendar, gather, nearest, samemesh, series, validate
from ..operators.numbering import dense_row_id
from ..sources import files, sinks, tables, versions
from ..sources.shared import materialise
from . import modules


def artifacts(config: Config) -> str:
    return f"{config.output}/artifacts"


def manifests(config: Config) -> str:
    return f"{config.output}/manifests"


def source_paths(config: Config) -> dict[str, str]:
    """All configured sources by name."""
    lists = {f"{name}_{i}": p for name, paths in (("h0_list", config.targets_history), ("r_list", config.targets_restart)) for i, p in enumerate(paths)}
    return config.paths | lists


def forcing_path(config: Config, variable: str) -> str:
    """Where a variable's consolidated table is."""
    return f"{config.output}/forcing_{config.datm_start}_{config.datm_end}/{variable}"


class Lineage:
    """What modules are made from: their own sources as they are now, the settings that they depend on, and the index that they build on.

    A module is rebuilt when one of these changed, and no other one is. Each source is looked at once.
    """

    def __init__(self, s: modules.Sources):
        self.s, self.entries = s, {}

    def paths(self, module: str) -> list[str]:
        c, keys = self.s.config, modules.needs(self.s.config, module)[0]
        out = {p for k in keys if (p := self.s.path(k))}
        if c.mode == "datm":  # made from consolidated tables, where they were prepared
            made = [c.forcing_modules[module]] if module in c.forcing_modules else list(c.forcing_modules.values()) if module == modules.INDEX else []
            held = [p for v in made if (p := versions.current(self.s.spark, forcing_path(c, v)))]
            out |= set(held[:1] if module == modules.INDEX else held)
        return sorted(out)

    def facts(self, module: str) -> dict:
        """sources, settings and index, as they stand in the manifest."""
        c, spark = self.s.config, self.s.spark
        for p in self.paths(module):
            if p not in self.entries:
                self.entries[p] = sinks.source_entry(spark, p)
        out = {"sources": [self.entries[p] for p in self.paths(module)], "settings": {k: getattr(c, k) for k in modules.needs(c, module)[1]}}
        return out if module == modules.INDEX else out | {"index": {k: v for k, v in (sinks.read_manifest(spark, manifests(c), modules.INDEX) or {}).items() if k in ("sources", "settings")}}

    def is_current(self, module: str) -> bool:
        c, spark = self.s.config, self.s.spark
        return tables.artifact_or_none(spark, artifacts(c), module) is not None and sinks.is_current(spark, manifests(c), module, **self.facts(module))


def extract(s: modules.Sources, wanted: list[str] | str = "all", force: bool = True, batches: list[int] | None = None) -> list[str]:
    """Build the wanted modules, the index first where it is missing or out of date. Without force, modules of which nothing changed are kept.

    With batches only these are built anew, of modules that are there; the index is kept then.
    """
    c, spark = s.config, s.spark
    names = list(MODULES) if wanted == "all" else list(wanted)
    unknown = [n for n in names if n != modules.INDEX and n not in modules.registry(c)]
    if unknown:
        raise ValueError(f"no modules {unknown}")
    lineage = Lineage(s)
    there = tables.artifact_or_none(spark, artifacts(c), modules.INDEX) is not None
    if batches is not None:
        lost = [n for n in [modules.INDEX, *names] if tables.artifact_or_none(spark, artifacts(c), n) is None]
        if lost:
            raise FileNotFoundError(f"no artifacts of {lost} to build batches of")
    elif not there or (modules.INDEX in names and (force or not lineage.is_current(modules.INDEX))):
        facts = lineage.facts(modules.INDEX)
        sinks.write_artifact(modules.build_index(s), artifacts(c), modules.INDEX)
        index = tables.artifact(spark, artifacts(c), modules.INDEX)
        row = index.agg(F.count("*").alias("rows"), F.max("batch_id").alias("batches")).first()
        sinks.write_manifest(spark, manifests(c), modules.INDEX, **facts, rows=row.rows, batches=row.batches, mode=c.mode)
    index, built = tables.artifact(spark, artifacts(c), modules.INDEX), []
    for name in names:
        if name == modules.INDEX:
            continue
        if name == "A_h0_list_y" and "h0_list" not in s:
            s.warnings.append("no history targets are configured: A_h0_list_y is left out")
            continue
        if name == "A_r_list_y" and "r_pfts" not in s and "r_columns" not in s:
            s.warnings.append("no restart targets are configured: A_r_list_y is left out")
            continue
        # looked at before it is read: what changes meanwhile is built again next time
        facts = lineage.facts(name)
        if not force and lineage.is_current(name):
            continue
        part = index if batches is None else index.where(F.col("batch_id").isin(batches))
        sinks.write_artifact(modules.build(s, name, part), artifacts(c), name, batches)
        if batches is None:  # the other batches are as old as before
            sinks.write_manifest(spark, manifests(c), name, **facts, mode=c.mode)
        built.append(name)
    return built


def assemble_final(spark: SparkSession, config: Config, strict: bool = False) -> tuple[DataFrame, list[str]]:
    """One plan over all batches, with __row_id and batch_id kept in front, and the modules that were missing.

    Series are reduced to months before they are joined; numbers are coerced, layers expanded, targets put last.
    """
    index = tables.artifact(spark, artifacts(config), modules.INDEX)
    spine, held, missing = index.select("__row_id", "batch_id", "Latitude", "Longitude"), [], []
    for name in modules.registry(config):
        df = tables.artifact_or_none(spark, artifacts(config), name)
        if df is None:
            missing.append(name)
            continue
        df = df.drop("batch_id")
        if name in config.forcing_modules and (v := next((v for v in FORCING if v in df.columns), None)):
            calendar_ = config.series_length, config.steps_per_day, config.years, strict
            df = series.block_means(df, ["__row_id"], "first", v, *calendar_, v) if "first" in df.columns else df.withColumn(v, series.monthly_means(F.col(v), *calendar_))
        held.append(df)
    out = assemble.coerced(assemble.left_joined(spine, held))
    layers = [v for v in ("PCT_NAT_PFT", "PCT_SAND", "PCT_CLAY") if v in LAYERED]
    return assemble.targets_last(assemble.expanded(out, layers)), missing


def write_dataset(spark: SparkSession, config: Config, overwrite: bool = False) -> list[str]:
    df, missing = assemble_final(spark, config)
    sinks.write_final(df, f"{config.output}/final_dataset", overwrite)
    return missing


def monthly_forcing(steps: DataFrame, coordinates: DataFrame, files: DataFrame, reference: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Raw steps (path, time_idx, cell, value) of the files chosen for each month to (gridcell, lat, lon, series of monthly means)."""
    # a file that is named directly may have any name
    months = calendar.numbered_months(files) if "month" in files.columns else dense_row_id(files.select("path"), ["path"], "step", 1)
    means = series.time_mean(steps.join(months.select("path", "step"), "path"), ["cell", "step"], "value")
    stacked = series.stacked(means, ["cell"], "step", "mean")
    points, warnings = coordinates, []
    if reference is not None:
        points, warnings = samemesh.with_reference_coordinates(coordinates, reference, "cell")
    return stacked.join(points, "cell").select(F.col("cell").alias("gridcell"), "lat", "lon", "series"), warnings


def prepare_forcing(spark: SparkSession, config: Config, raw: dict[str, tuple[DataFrame, DataFrame, DataFrame]], reference: DataFrame | None = None, force: bool = False) -> dict[str, str]:
    """Consolidated tables of the given variables: (steps, coordinates, paths) each. One that exists is kept unless force is set.

    A new one takes the place of the old one only when it is complete.
    """
    out = {}
    for variable, (steps, coordinates, paths) in raw.items():
        path = forcing_path(config, variable)
        if force or tables.artifact_or_none(spark, *path.rsplit("/", 1)) is None:
            files = paths if variable in config.datm_paths else calendar.month_files(paths, config.datm_tokens.get(variable, ""), config.datm_start, config.datm_end)
            made, _ = monthly_forcing(steps, coordinates, files, reference)
            sinks.write_forcing(made, path, config.datm_start, config.datm_end)
        out[variable] = versions.current(spark, path) or path
    return out


def raw_forcing(spark: SparkSession, config: Config, variables: list[str]) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """Steps, coordinates and paths of each variable: tables of its own path or of its folder in the forcing root, or monthly NetCDF files."""
    out = {}
    for v in variables:
        root = config.datm_paths.get(v) or f"{config.datm_root}/{v}"
        if root == f"/{v}":
            raise ValueError(f"neither a forcing root nor a path is set for {v}")
        steps = tables.artifact_or_none(spark, root, "steps")
        if steps is not None:
            out[v] = steps, tables.artifact(spark, root, "cells"), steps.select("path").distinct()
        else:
            out[v] = monthly_files(spark, config, v)
    return out


def monthly_files(spark: SparkSession, config: Config, variable: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps, coordinates and paths of a variable's monthly NetCDF files, one file a month."""
    if path := config.datm_paths.get(variable):
        paths = spark.createDataFrame([(path,)], "path string")
    elif not config.datm_tokens.get(variable, "").strip():
        raise FileNotFoundError(f"{variable}: neither tables in {config.datm_root}/{variable} nor a token for monthly files")
    else:
        listed = calendar.month_files(calendar.listed_files(spark, config.datm_root), config.datm_tokens.get(variable, ""), config.datm_start, config.datm_end)
        paths = calendar.first_of_month(listed).select(F.regexp_replace("path", "^file:", "").alias("path"))
    # at most one path a month
    names = sorted(r.path for r in paths.collect())
    if not names:
        raise FileNotFoundError(f"no monthly files of {variable} in {config.datm_root}")
    return files.monthly_steps(spark, names, variable), files.NetCDFFile(spark, names[0]).flat_cells(), paths


def with_prepared_forcing(s: modules.Sources, wanted: list[str] | str = "all", force: bool = False) -> modules.Sources:
    """s with the consolidated tables of the variables that the wanted modules need, prepared where they are not there yet."""
    by_module = s.config.forcing_modules
    names = list(by_module.values()) if wanted == "all" else [v for m, v in by_module.items() if m in wanted]
    reference = s["ds2"].select(F.col("cell_idx").alias("cell"), "lat", "lon") if "ds2" in s and {"cell_idx", "lat", "lon"} <= set(s["ds2"].columns) else None
    there = {v: tables.artifact_or_none(s.spark, *forcing_path(s.config, v).rsplit("/", 1)) is not None for v in names}
    raw = raw_forcing(s.spark, s.config, [v for v in names if force or not there[v]])
    prepare_forcing(s.spark, s.config, raw, reference, force)
    made = {}
    for m, v in by_module.items():
        if v in names:
            df = tables.artifact(s.spark, *forcing_path(s.config, v).rsplit("/", 1))
            made[m.split("_")[2]] = df.select(F.col("gridcell").cast("long").alias("forcing_idx"), F.col("series").alias(v))
            made["ds4_mesh"] = df.select(F.col("gridcell").cast("long").alias("forcing_idx"), "lat", "lon")
    return modules.Sources(s.spark, s.config, s.tables | made)


def nearest_on_grid(final: DataFrame, lats: DataFrame, lons: DataFrame) -> DataFrame:
    """(__row_id, lat_idx, lon_idx): the nearest cell of a rectilinear grid, longitudes in the range of its axis."""
    cells = final.select("__row_id", F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    cells = nearest.normalised_longitude(cells, lons)
    i = nearest.nearest_on_axis(cells.withColumnRenamed("lat", "value"), lats.withColumnRenamed("lat", "value"), "__row_id", "value", "lat_idx")
    j = nearest.nearest_on_axis(cells.withColumnRenamed("lon", "value"), lons.withColumnRenamed("lon", "value"), "__row_id", "value", "lon_idx")
    return i.join(j, "__row_id")


def replace_forcing(final: DataFrame, lats: DataFrame, lons: DataFrame, cube: DataFrame, columns: dict[str, str]) -> DataFrame:
    """final with forcing columns taken from the nearest cell of a rectilinear cube (lat_idx, lon_idx, series columns); no averaging."""
    found = nearest_on_grid(final, lats, lons).join(cube, ["lat_idx", "lon_idx"]).drop("lat_idx", "lon_idx")
    return assemble.replaced(final, found, columns)


def replace_forcing_blocks(final: DataFrame, lats: DataFrame, lons: DataFrame, blocks: dict[str, DataFrame]) -> DataFrame:
    """The same from blocks (lat_idx, lon_idx, first, values) of each new column, by its name; values is the last column.

    Blocks of cells that are nearest to no row are left out before anything is shuffled by cell; the others become one series a cell, once
    for all rows that share it.
    """
    places = materialise(nearest_on_grid(final, lats, lons), "places")
    wanted, found = places.select("lat_idx", "lon_idx").distinct(), places
    for column, df in blocks.items():
        some = df.join(wanted, ["lat_idx", "lon_idx"], "left_semi")
        whole = gather.series_from_blocks(some, ["lat_idx", "lon_idx"], "first", df.columns[-1], column)
        found = found.join(whole.withColumn(column, F.col(column).cast("array<double>")), ["lat_idx", "lon_idx"], "left")
    return assemble.replaced(final, found, {c: c for c in blocks})


def replace_from(spark: SparkSession, final: DataFrame, forcing: str, columns: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """final with its forcing replaced from a NetCDF file, or a folder of lat, lon and cube tables, and the names (new: there) that were used."""
    if forcing.endswith(".nc"):
        source = files.NetCDFFile(spark, forcing)
        columns = columns or {v: tables.resolve(source.shapes, v) for v in FORCING}
        return replace_forcing_blocks(final, *source.axes(), {new: source.grid_blocks(old) for new, old in columns.items()}), columns
    lats, lons, cube = (spark.read.parquet(f"{forcing}/{n}") for n in ("lat", "lon", "cube"))
    columns = columns or {v: tables.resolve(cube, v) for v in FORCING}
    return replace_forcing(final, lats, lons, cube, columns), columns


def validate_dataset(spark: SparkSession, config: Config, max_batches: int | None = None, sample_rows: int = 20) -> DataFrame:
    index = tables.artifact(spark, artifacts(config), modules.INDEX)
    final = spark.read.parquet(f"{config.output}/final_dataset")
    if max_batches:
        index, final = (df.where(F.col("batch_id") <= max_batches) for df in (index, final))
    return validate.report(
        index, final, lat=(config.lat_min, config.lat_max), lon=(config.lon_min, config.lon_max),
        series=list(config.forcing_modules.values()), series_length=12 * config.years, numbers=list(assemble.SINGLE_VALUES), sample_rows=sample_rows,
    )


def union_of(frames: list[DataFrame]) -> DataFrame:
    """Batch tables as one, columns by name; a column that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
