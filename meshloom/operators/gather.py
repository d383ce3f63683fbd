"""Values of cells: lookups, layers, ragged groups, series and constants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise


def field(structs: str | Column, name: str) -> Column:
    """One field of an array of structs, as an array."""
    return F.transform(structs, lambda x: x[name])


def ragged_gather(rows: DataFrame, group: str, position: str | list[str], variables: list[str]) -> DataFrame:
    """One row a group: each variable as an array in position order. An array value gives an array of arrays."""
    keys = [position] if isinstance(position, str) else position
    packed = F.array_sort(F.collect_list(F.struct(*[F.col(k).alias(f"p{i}") for i, k in enumerate(keys)], *[F.col(v).alias(f"v{i}") for i, v in enumerate(variables)])))
    rest = rows.groupBy(group).agg(packed.alias("__g"))
    return rest.select(group, *[field("__g", f"v{i}").alias(v) for i, v in enumerate(variables)])


def ragged_parts(rows: DataFrame, group: str, position: str, variables: list[str], run: int = 4096, most: int = 1 << 16) -> DataFrame:
    """(group, part, variables): groups as ``ragged_gather`` gives them, where a group of more than ``most`` rows stays in numbered parts.

    Rows are sorted into runs first, of one group and a range of ``run`` positions, so a group of half of all rows is spread over as many
    tasks as it has ranges; then the runs of a part are merged in order. Positions are whole numbers, and different within a group (rows
    of equal position lie in one run, in the order of their values); a part holds ``most`` rows and less than a run more. Rows without a
    position come first, in a run of their own.
    """
    packed = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(variables)])))
    runs = rows.groupBy(F.col(group), F.floor(F.col(position) / run).alias("__run")).agg(packed.alias("__g")).withColumn("__n", F.size("__g"))
    # written, as the numbers of parts follow from the runs' sizes alone and the values are not to be sorted for them
    runs = materialise(runs, "ragged-runs")
    before = Window.partitionBy(group).orderBy(F.col("__run").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    numbered = runs.select(F.col(group).alias("__group"), F.col("__run").alias("__range"), F.floor(F.coalesce(F.sum("__n").over(before), F.lit(0)) / most).cast("int").alias("part"))
    merged = runs.join(numbered, [F.col(group).eqNullSafe(F.col("__group")), F.col("__run").eqNullSafe(F.col("__range"))])
    ordered = F.array_sort(F.collect_list(F.struct(F.col("__run").alias("r"), F.col("__g").alias("g"))))
    whole = merged.groupBy(group, "part").agg(F.flatten(field(ordered, "g")).alias("__g"))
    return whole.select(group, "part", *[field("__g", f"v{i}").alias(v) for i, v in enumerate(variables)])


def only_groups_of(rows: DataFrame, other: DataFrame, group: str) -> DataFrame:
    """Rows whose group id occurs in the other table."""
    return rows.join(other.select(group).distinct(), group, "left_semi")


def lookup_groups(index: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """index with its groups' arrays; NULL (not an empty array) where there is no group."""
    return index.join(groups, key, "left")


def layers(rows: DataFrame, cell: list[str], level: str, variables: list[str]) -> DataFrame:
    """One row a cell: each variable as an array over levels."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(level).alias("p"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(variables)])))
    out = rows.groupBy(*cell).agg(packed.alias("__g"))
    return out.select(*cell, *[field("__g", f"v{i}").alias(v) for i, v in enumerate(variables)])


def lookup_scalars(index: DataFrame, values: DataFrame, cell: list[str], variables: list[str], step: int | None = 0) -> DataFrame:
    """index with each cell's variables; of a table with time_idx the given step."""
    if "time_idx" in values.columns and step is not None:
        values = values.where(F.col("time_idx") == step)
    return index.join(values.select(*cell, *variables), cell, "left")


def lookup_series(index: DataFrame, series: DataFrame, at: str, value: str, out: str, cell: str = "forcing_idx") -> DataFrame:
    """index with the series (an array in one row a cell) of the cell in column ``at``."""
    return index.join(series.select(F.col(cell).alias("__cell"), F.col(value).cast("array<double>").alias(out)), F.col(at) == F.col("__cell"), "left").drop("__cell")


def series_from_steps(rows: DataFrame, cell: list[str], step: str | list[str], value: str, out: str = "series") -> DataFrame:
    """Long rows (cell, step, value) to one array a cell."""
    keys = [step] if isinstance(step, str) else step
    packed = F.array_sort(F.collect_list(F.struct(*[F.col(k).alias(f"p{i}") for i, k in enumerate(keys)], F.col(value).alias("v"))))
    return rows.groupBy(*cell).agg(field(packed, "v").alias(out))


def blocks_from_steps(rows: DataFrame, cell: list[str], step: str, value: str, length: int, out: str = "values") -> DataFrame:
    """Long rows (cell, step, value), steps counted from 0 without gaps, to one row for each cell and block of so many steps: (cell, first, values)."""
    block = rows.withColumn("first", F.floor(F.col(step) / length).cast("long") * length)
    return series_from_steps(block, [*cell, "first"], step, value, out)


def series_from_blocks(blocks: DataFrame, cell: list[str], first: str, values: str, out: str = "series") -> DataFrame:
    """Blocks to one array a cell: an ordered merge, which shuffles a row a block instead of a row a step."""
    runs = F.array_sort(F.collect_list(F.struct(F.col(first).alias("p"), F.col(values).alias("v"))))
    return blocks.groupBy(*cell).agg(F.flatten(field(runs, "v")).alias(out))


def lookup_blocks(index: DataFrame, blocks: DataFrame, at: str, value: str, out: str, cell: str = "forcing_idx", first: str = "first") -> DataFrame:
    """index with the blocks of the cell in column ``at``, a row for each; one row without a block where the cell has none."""
    blocks = blocks.select(F.col(cell).alias("__cell"), F.col(first).alias("first"), F.col(value).cast("array<double>").alias(out))
    return index.join(blocks, F.col(at) == F.col("__cell"), "left").drop("__cell")


def valid_parameters(params: DataFrame, first: int = 17, name: str = "name", values: str = "vals") -> DataFrame:
    """Parameters cut to their first values; one with a NULL or NaN among them goes whole."""
    head = F.slice(values, 1, first)
    return params.where(~F.exists(head, lambda x: x.isNull() | F.isnan(x))).select(name, head.alias(values))


def with_parameters(index: DataFrame, params: DataFrame, wanted: list[str], name: str = "name", values: str = "vals", prefix: str = "pft_") -> DataFrame:
    """index with each wanted parameter that is there as a constant array column. The parameters are one row."""
    one = params.where(F.col(name).isin(wanted)).groupBy().pivot(name, wanted).agg(F.first(values))
    there = [r[0] for r in params.where(F.col(name).isin(wanted)).select(name).distinct().collect()]
    row = one.select(*[F.col(f"`{v}`").alias(prefix + v) for v in wanted if v in there])
    return index.crossJoin(F.broadcast(row)) if there else index
