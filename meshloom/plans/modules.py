"""The thirteen modules: each is a lazy plan from source tables and the cell index to rows keyed by __row_id."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import assemble, gather, mesh, nearest, samemesh
from ..sources import files
from ..sources.tables import domain_grid, present, resolve

INDEX = "A_index_core"


#: table: where its path is configured, and its kind in that source
TABLES = {
    "ds1": ("ds1", "cells"), "ds1_layers": ("ds1", "layers"), "ds2": ("ds2", "mesh"), "ds2_history": ("ds2", "history"), "ds4_mesh": ("ds4", "mesh"),
    "ds10_mesh": ("ds10", "mesh"), "ds10_pfts": ("ds10", "pfts"), "ds10_columns": ("ds10", "columns"),
    "h0_list": ("h0_list", "history"), "r_pfts": ("r_list", "pfts"), "r_columns": ("r_list", "columns"), "clm_params": ("clm_params", "parameters"),
    **{f"ds{n}": (f"ds{n}", "series") for n in range(4, 10)},
}


class Sources:
    """Source tables by key: given as they are, or from the files that a configuration names (NetCDF, or folders of Parquet tables)."""

    def __init__(self, spark: SparkSession, config: Config, tables: dict[str, DataFrame] | None = None):
        self.spark, self.config, self.tables = spark, config, tables or {}
        self.warnings: list[str] = []
        self.files: dict[str, files.NetCDFFile] = {}
        #: keys of the tables that were asked for
        self.read: set[str] = set()

    def path(self, key: str) -> str | None:
        c, source = self.config, TABLES[key][0]
        lists = {"h0_list": c.targets_history, "r_list": c.targets_restart}
        return next(iter(lists[source]), None) if source in lists else c.paths.get(source)

    def __contains__(self, key: str) -> bool:
        return self.found(key) is not None

    def __getitem__(self, key: str) -> DataFrame:
        if (df := self.found(key)) is None:
            raise KeyError(f"no table {key}: {self.path(key) or 'no path is configured'}")
        return df

    def found(self, key: str) -> DataFrame | None:
        self.read.add(key)
        if key not in self.tables and (path := self.path(key)):
            df = self.from_netcdf(key, path) if path.endswith(".nc") else files.parquet_table(self.spark, path, TABLES[key][1])
            if df is None:
                return None
            self.tables = self.tables | {key: df}
        return self.tables.get(key)

    def from_netcdf(self, key: str, path: str) -> DataFrame | None:
        c, kind = self.config, TABLES[key][1]
        if path not in self.files:
            self.files[path] = files.NetCDFFile(self.spark, path)
        f = self.files[path]
        if kind == "mesh":
            return f.forcing_mesh() if key == "ds4_mesh" else f.mesh()
        if kind == "cells":
            return f.of_cells(list(c.surface_scalars), [])
        if kind == "layers":
            return f.of_cells(list(c.surface_layers), ["level"]).withColumnRenamed("level_idx", "level") if c.surface_layers else None
        if kind == "history":
            land = [v for v in ("landfrac", "LANDFRAC_PFT") if f.has(v)][:1]
            names = [v for v in c.history if f.has(v)]
            parts = [f.of_cells(vs, [], first) for vs, first in ((land, False), (names, True)) if vs]
            return reduce(lambda a, b: a.join(b, ["lat_idx", "lon_idx"], "full"), parts) if parts else None
        if kind == "series":
            v = resolve(f.shapes, dict(zip((f"ds{n}" for n in range(4, 10)), c.forcing_modules.values(), strict=True))[key])
            return f.series_blocks(v)
        if kind == "parameters":
            return f.parameters(list(c.parameters))
        # the targets' groups are those of the initial restart file, place by place
        of = {"pfts": "pfts1d_gridcell_index", "columns": "cols1d_gridcell_index"}[kind] if key.startswith("ds10") else None
        flat, layered = (c.pft, ()) if kind == "pfts" else (c.columns_flat, c.columns)
        return f.groups(of, list(flat), list(layered)) if of or flat or layered else None


def build_index(s: Sources) -> DataFrame:
    """ds2: the mesh; ds10_mesh (restart_idx, lat, lon); ds4_mesh (forcing_idx, lat, lon)."""
    c, grid = s.config, domain_grid(s["ds2"])
    cells = mesh.select_cells(grid, c.lat_min, c.lat_max, c.lon_min, c.lon_max)
    one_dimensional = "cell_idx" in s["ds2"].columns
    order = ("lat_idx",) if one_dimensional else ("lat_idx", "lon_idx")
    spine = mesh.index_cells(cells, c.batch_size, order)
    restart, forcing = s["ds10_mesh"], s["ds4_mesh"]
    if c.mode == "datm" and one_dimensional:
        checked, warnings = samemesh.same_index(grid.select(F.col("lat_idx").alias("cell_idx"), "lat", "lon"), restart, forcing, chosen=cells.select(F.col("lat_idx").alias("cell_idx"), "lat", "lon"))
        s.warnings += warnings
        pairs = spine.select("__row_id", F.col("lat_idx").alias("restart_idx"), F.col("lat_idx").alias("forcing_idx"))
    elif c.mode == "datm":
        pairs = samemesh.same_mesh_join(spine, restart, "__row_id", "restart_idx").join(samemesh.same_mesh_join(spine, forcing, "__row_id", "forcing_idx"), "__row_id")
    else:
        near = lambda m, i: nearest.nearest_join(spine, m, "__row_id", i).select("__row_id", F.col("idx").alias(i))
        pairs = near(restart, "restart_idx").join(near(forcing, "forcing_idx"), "__row_id")
    return spine.join(pairs, "__row_id").select(
        "__row_id", "batch_id", "lat_idx", "lon_idx", F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"),
        F.col("restart_idx").cast("long").alias("nearest_restart_index"), F.col("forcing_idx").cast("long").alias("nearest_forcing_index"), (F.col("restart_idx") + 1).cast("long").alias("gridcell_id"),
    )


def keyed(index: DataFrame) -> DataFrame:
    return index.select("__row_id", "batch_id", "lat_idx", "lon_idx", "nearest_forcing_index", "gridcell_id")


def slim(df: DataFrame) -> DataFrame:
    return df.drop("lat_idx", "lon_idx", "nearest_forcing_index", "gridcell_id")


def surface(s: Sources, index: DataFrame) -> DataFrame:
    """ds1: scalars by cell; ds1_layers (lat_idx, lon_idx, level, variables): arrays over levels."""
    c, cell = s.config, ["lat_idx", "lon_idx"]
    out = gather.lookup_scalars(keyed(index), s["ds1"], cell, list(c.surface_scalars))
    if c.surface_layers:
        out = out.join(gather.layers(s["ds1_layers"], cell, "level", list(c.surface_layers)), cell, "left")
    return slim(out)


def history_x(s: Sources, index: DataFrame) -> DataFrame:
    """First step of the mesh source's history; absent variables are left out, with a warning."""
    there = present(s["ds2_history"], list(s.config.history), strict=False)
    s.warnings += [f"history: no {v}" for v in s.config.history if v not in there]
    land = [resolve(s["ds2_history"], "landfrac", {"landfrac": ("landfrac", "LANDFRAC_PFT")})] if {"landfrac", "LANDFRAC_PFT"} & set(s["ds2_history"].columns) else []
    out = gather.lookup_scalars(keyed(index), s["ds2_history"], ["lat_idx", "lon_idx"], land + there)
    return slim(out.withColumnsRenamed({v: "landfrac" for v in land}))


def history_y(s: Sources, index: DataFrame) -> DataFrame:
    """Targets: all variables must be there."""
    names = present(s["h0_list"], list(s.config.history), strict=True)
    return slim(assemble.prefixed(gather.lookup_scalars(keyed(index), s["h0_list"], ["lat_idx", "lon_idx"], names), names, "Y_"))


def restart_values(s: Sources, index: DataFrame, source: str, prefix: str) -> DataFrame:
    """Ragged groups by gridcell_id in file order; columns count only for gridcells that have PFTs. All variables must be there.

    Which places belong to a gridcell is told by the initial restart file, for targets too.
    """
    c, out = s.config, keyed(index)
    pfts, columns = s["ds10_pfts"], s["ds10_columns"] if "ds10_columns" in s else None
    for kind, names, places in (("pfts", list(c.pft), pfts), ("columns", [*c.columns_flat, *c.columns], columns)):
        if not names:
            continue
        rows = s[f"{source}_{kind}"]
        present(rows, names, strict=True)
        if source != "ds10":
            rows = rows.select("pos", *names).join(places.select("pos", "gridcell_id"), "pos")
        if kind == "columns":
            rows = gather.only_groups_of(rows, pfts, "gridcell_id")
        out = gather.lookup_groups(out, assemble.prefixed(gather.ragged_gather(rows, "gridcell_id", "pos", names), names, prefix), "gridcell_id")
    return slim(out)


def restart_x(s: Sources, index: DataFrame) -> DataFrame:
    return restart_values(s, index, "ds10", "")


def restart_y(s: Sources, index: DataFrame) -> DataFrame:
    return restart_values(s, index, "r", "Y_")


def forcing(key: str, variable: str) -> Callable[[Sources, DataFrame], DataFrame]:
    def build(s: Sources, index: DataFrame) -> DataFrame:
        table = s[key]
        name = resolve(table, variable) if s.config.mode != "datm" else variable
        if "first" in table.columns:  # blocks of steps stay blocks; assembly reduces them to months
            return slim(gather.lookup_blocks(keyed(index), table, "nearest_forcing_index", name, variable))
        return slim(gather.lookup_series(keyed(index), table, "nearest_forcing_index", name, variable))

    return build


def parameters(s: Sources, index: DataFrame) -> DataFrame:
    given = s["clm_params"] if s.config.parameters else None
    return slim(gather.with_parameters(keyed(index), gather.valid_parameters(given), list(s.config.parameters)) if given is not None else keyed(index))


#: module: the tables that it reads and the settings that it depends on; all but the index build on the index
NEEDS = {
    INDEX: (("ds2", "ds10_mesh", "ds4_mesh"), ("mode", "batch_size", "lat_min", "lat_max", "lon_min", "lon_max")),
    "A_ds1_surface": (("ds1", "ds1_layers"), ("surface_scalars", "surface_layers")),
    "A_ds2_history_x": (("ds2_history",), ("history",)),
    "A_ds10_restart_x": (("ds10_pfts", "ds10_columns"), ("pft", "columns_flat", "columns")),
    "A_h0_list_y": (("h0_list",), ("history",)),
    "A_r_list_y": (("r_pfts", "r_columns", "ds10_pfts", "ds10_columns"), ("pft", "columns_flat", "columns")),
    "A_clm_params_pft": (("clm_params",), ("parameters",)),
}


def needs(config: Config, module: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Keys of the tables that a module reads, and names of the settings that it depends on."""
    return NEEDS[module] if module in NEEDS else ((module.split("_")[2],), ("mode",))


def registry(config: Config) -> dict[str, Callable[[Sources, DataFrame], DataFrame]]:
    """Module name to builder, in the order of assembly; forcing last."""
    out = {"A_ds1_surface": surface, "A_ds2_history_x": history_x, "A_ds10_restart_x": restart_x, "A_h0_list_y": history_y, "A_r_list_y": restart_y, "A_clm_params_pft": parameters}
    return out | {m: forcing(m.split("_")[2], v) for m, v in config.forcing_modules.items()}


def build(s: Sources, module: str, index: DataFrame) -> DataFrame:
    builders = registry(s.config)
    if module not in builders:
        raise ValueError(f"no module {module}; there are {[INDEX, *builders]}")
    return builders[module](s, index)
