"""A Spark data source for NetCDF variables, for sessions whose workers have netCDF4 (it is imported where the files are read).

netcdf.register(spark)
spark.read.format("netcdf").option("path", p).option("variables", "T,Q").option("dims", "time,cell").load()

One row an element: an index column for each dimension and a double for each variable, all of the same dimensions; NULL where the
file has its fill value. With the option ``along``, a dimension, one row a block: the index of the other dimensions, ``<dim>_first`` and
each variable as an array of the next ``length`` values along that dimension, blocks beginning at multiples of the length. Partitions are
hyperslabs, cut along any dimension until they are small enough. Conditions on index columns (and on ``<dim>_first`` and ``path``) reach
the source, and only hyperslabs that meet them are planned and read. With the option ``first`` only the first step of the first dimension
is read, which then has no column. With ``files``, a JSON list of paths of files of one form, each file has hyperslabs of its own, and its
path is a column.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from math import prod

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

#: elements of one batch, and of one hyperslab
BATCH, SLAB = 1 << 18, 1 << 24
#: steps of a block
LENGTH = 4096


class Block(InputPartition):
    """A hyperslab of a file: (start, stop) of each dimension that is read, to the end for a stop of -1; without any the whole file."""

    def __init__(self, path: str, ranges: tuple[tuple[int, int], ...] = ()):
        super().__init__((path, ranges))


def names(raw: str) -> list[str]:
    return [x.strip() for x in raw.split(",") if x.strip()]


class NetCDFSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def schema(self) -> str:
        reader = NetCDFReader(self.options)
        path = ["path string"] if reader.files is not None else []
        kind = "array<double>" if reader.along else "double"
        return ", ".join([*path, *(f"{c} long" for c in reader.columns()), *(f"`{v}` {kind}" for v in reader.variables)])

    def reader(self, schema) -> DataSourceReader:
        return NetCDFReader(self.options)


class NetCDFReader(DataSourceReader):
    def __init__(self, options):
        self.files = json.loads(options["files"]) if "files" in options else None
        self.path, self.variables, self.blocks = options.get("path"), names(options["variables"]), int(options.get("blocks", 64))
        self.first = "first" in options
        self.dims = names(options["dims"])
        self.read_dims = self.dims[1:] if self.first else self.dims
        self.along, self.length = options.get("along"), int(options.get("length", LENGTH))
        if self.along and self.along not in self.read_dims:
            raise ValueError(f"{self.along} is not among {self.read_dims}")
        #: of a dimension, the least and greatest index that are wanted
        self.wanted: dict[str, tuple[float, float]] = {}

    def columns(self) -> list[str]:
        """Index columns, that of blocks last."""
        others = [f"{d}_idx" for d in self.read_dims if d != self.along]
        return [*others, f"{self.along}_first"] if self.along else others

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self.narrow(f):
                yield f

    def narrow(self, f: Filter) -> bool:
        """Take a condition into account; False if it must be tested again."""
        column, value = ".".join(getattr(f, "attribute", ())), getattr(f, "value", None)
        if column == "path" and self.files is not None and isinstance(f, EqualTo | In):
            these = {value} if isinstance(f, EqualTo) else set(value)
            self.files = [p for p in self.files if p in these]
            return True
        if column not in self.columns():
            return False
        if isinstance(f, IsNotNull):
            return True
        inf = float("inf")
        if isinstance(f, In):
            held = [v for v in value if v is not None]
            low, high = min(held, default=inf), max(held, default=-inf)
        elif isinstance(f, EqualTo | EqualNullSafe) and value is not None:
            low, high = value, value
        elif isinstance(f, GreaterThan | GreaterThanOrEqual):
            low, high = value + isinstance(f, GreaterThan), inf
        elif isinstance(f, LessThan | LessThanOrEqual):
            low, high = -inf, value - isinstance(f, LessThan)
        else:
            return False
        dim = column.rsplit("_", 1)[0]
        a, b = self.wanted.get(dim, (-inf, inf))
        self.wanted[dim] = max(a, low), min(b, high)
        return not isinstance(f, In)

    def span(self, dim: str, size: int) -> tuple[int, int]:
        """(start, stop) of what is wanted of a dimension; of blocks, those whose first step is."""
        low, high = self.wanted.get(dim, (0, size - 1))
        low, high = max(0, low), min(size - 1, high)
        if low > high:
            return 0, 0
        if dim == self.along:
            low, high = -(-int(low) // self.length) * self.length, int(high) // self.length * self.length + self.length - 1
        return int(low), max(int(low), min(size, int(high) + 1))

    def cut(self, spans: list[tuple[int, int]]) -> list[tuple[tuple[int, int], ...]]:
        """Hyperslabs of the spans: as many as asked for, fewer where they would be less than a batch, more where they would be too large; the first dimensions are cut first."""
        total = prod(b - a for a, b in spans)
        if not total:
            return []
        wanted, out = max(min(self.blocks, -(-total // BATCH)), -(-total // SLAB)), [()]
        for dim, (a, b) in zip(self.read_dims, spans, strict=True):
            unit = self.length if dim == self.along else 1
            pieces = min(-(-(b - a) // unit), -(-wanted // len(out)))
            step = -(-(-(-(b - a) // unit)) // pieces) * unit
            out = [(*held, (x, min(b, x + step))) for held in out for x in range(a, b, step)]
        return out

    def partitions(self):
        import netCDF4

        if self.files == []:
            return [Block("", ((0, 0),))]
        with netCDF4.Dataset(self.files[0] if self.files else self.path) as ds:
            shape = ds.variables[self.variables[0]].shape
        if len(shape) != len(self.dims):
            raise ValueError(f"{self.variables[0]} has {len(shape)} dimensions, not {self.dims}")
        sizes = dict(zip(self.read_dims, shape[1:] if self.first else shape, strict=True))
        spans = [self.span(d, n) for d, n in sizes.items()]
        if not self.files:
            return [Block(self.path, slab) for slab in self.cut(spans)] or [Block("", ((0, 0),))]
        # files may have more or fewer steps than the first one
        self.blocks = 1
        whole = [d not in self.wanted and k == 0 for k, d in enumerate(self.read_dims)]
        slabs = {tuple((0, -1) if w else r for w, r in zip(whole, slab, strict=True)) for slab in self.cut(spans)}
        return [Block(p, slab) for p in self.files for slab in sorted(slabs)] or [Block("", ((0, 0),))]

    def read(self, partition) -> Iterator:
        import netCDF4
        import numpy as np

        path, ranges = partition.value
        if any(a == b for a, b in ranges):
            return
        with netCDF4.Dataset(path) as ds:
            held = [ds.variables[v] for v in self.variables]
            shape = held[0].shape[1:] if self.first else held[0].shape
            ranges = [(a, n if b < 0 else min(b, n)) for (a, b), n in zip(ranges or [(0, -1)] * len(shape), shape, strict=True)]
            # where blocks run along the first dimension, one at a time; else as many steps of it as fit
            k = self.read_dims.index(self.along) if self.along else 0
            width = prod(b - a for i, (a, b) in enumerate(ranges) if i != k)
            step = self.length if self.along else max(1, BATCH // max(1, width))
            for at in range(*ranges[k], step):
                slab = [(at, min(ranges[k][1], at + step)) if i == k else r for i, r in enumerate(ranges)]
                index = tuple(slice(a, b) for a, b in slab)
                parts = [np.ma.asarray(v[(0, *index)] if self.first else v[index]) for v in held]
                yield from self.rows(path, parts, [a for a, _ in slab], k if self.along else None)

    def rows(self, path: str, parts: list, starts: list[int], along: int | None) -> Iterator:
        import numpy as np
        import pyarrow as pa

        heads = [i for i in range(len(starts)) if i != along]
        size = 1 if along is None else parts[0].shape[along]
        parts = [np.ma.asarray(x if along is None else np.moveaxis(x, along, -1)) for x in parts]
        shape = parts[0].shape if along is None else parts[0].shape[:-1]
        flat = [x.reshape(-1, size) for x in parts]
        step = max(1, BATCH // max(1, size))
        for a in range(0, len(flat[0]), step):
            some = [x[a : a + step] for x in flat]
            n = len(some[0])
            at = np.unravel_index(np.arange(a, a + n), shape) if shape else ()
            columns = [pa.array(x.astype(np.int64) + starts[i]) for x, i in zip(at, heads, strict=True)]
            if along is not None:
                columns.append(pa.array(np.full(n, starts[along], np.int64)))
            for x in some:
                values = pa.array(np.ma.getdata(x).ravel().astype(float), mask=np.ma.getmaskarray(x).ravel())
                columns.append(values if along is None else pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), values))
            if self.files is not None:
                columns.insert(0, pa.array([path] * n))
            yield pa.RecordBatch.from_arrays(columns, names=[*(["path"] if self.files is not None else []), *self.columns(), *self.variables])


def register(spark: SparkSession) -> None:
    """Make the source known to the session, which must let Python sources take conditions."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetCDFSource)


def shapes(path: str) -> dict[str, tuple[tuple[str, ...], tuple[int, ...]]]:
    """Dimensions and sizes of each variable, from the file's header."""
    import netCDF4

    with netCDF4.Dataset(path) as ds:
        return {name: (tuple(v.dimensions), tuple(v.shape)) for name, v in ds.variables.items()}


def header(path: str, wanted: Iterable[str] = (), most: int = 10) -> list[str]:
    """Lines about a file for the run log: its first dimensions, and dimensions, sizes and units of the wanted variables that it has."""
    import netCDF4

    with netCDF4.Dataset(path) as ds:
        sizes = {d: n for v in ds.variables.values() for d, n in zip(v.dimensions, v.shape, strict=True)}
        lines = [f"dimension {d}: {n}" for d, n in list(sizes.items())[:most]]
        for name in wanted:
            if name in ds.variables:
                v = ds.variables[name]
                lines.append(f"variable {name}: dimensions {tuple(v.dimensions)}, sizes {tuple(v.shape)}, units {getattr(v, 'units', '')!r}")
        return lines
