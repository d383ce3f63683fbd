"""Assembly of modules into one table: joins, coercion, expansion and column order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import no_nan, numeric

# The columns that hold one number a row.
SINGLE_VALUES = (
    "landfrac", "LANDFRAC_PFT", "PCT_NATVEG", "AREA", "SOIL_COLOR", "SOIL_ORDER", "GPP", "Y_GPP", "HR", "AR", "NPP", "Y_HR", "Y_AR", "Y_NPP",
    "OCCLUDED_P", "SECONDARY_P", "LABILE_P", "APATITE_P",
)


def left_joined(spine: DataFrame, modules: list[DataFrame], key: str = "__row_id") -> DataFrame:
    """spine with all modules' columns; a module without the row leaves NULL. Column names must not meet."""
    taken = set(spine.columns)
    for m in modules:
        if both := (set(m.columns) - {key}) & taken:
            raise ValueError(f"columns of two modules: {sorted(both)}")
        taken |= set(m.columns)
    return reduce(lambda df, m: df.join(m, key, "left"), modules, spine)


def coerced(df: DataFrame, columns: tuple[str, ...] = SINGLE_VALUES) -> DataFrame:
    return df.withColumns({c: numeric(F.col(c)) for c in columns if c in df.columns})


def expanded(df: DataFrame, columns: list[str], widths: dict[str, int] | None = None) -> DataFrame:
    """Array columns to {name}_0, {name}_1, ... at the end; missing and NaN elements are 0. Widths are the largest of the whole table."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    if widths is None:
        row = df.agg(*[F.max(F.size(c)).alias(c) for c in columns]).first()
        widths = {c: max(0, row[c] or 0) for c in columns}
    made = [F.coalesce(no_nan(F.get(F.col(c), F.lit(i)).cast("double")), F.lit(0.0)).alias(f"{c}_{i}") for c in columns for i in range(widths[c])]
    return df.select(*[c for c in df.columns if c not in columns], *made)


def targets_last(df: DataFrame, prefix: str = "Y_") -> DataFrame:
    """Columns in their order, those with the prefix at the end."""
    return df.select(*[c for c in df.columns if not c.startswith(prefix)], *[c for c in df.columns if c.startswith(prefix)])


def prefixed(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def replaced(df: DataFrame, other: DataFrame, columns: dict[str, str], key: str = "__row_id") -> DataFrame:
    """df with columns taken from other (new name: name there) by key; existing ones keep their places, new ones come last."""
    got = other.select(key, *[F.col(old).alias(f"__new_{new}") for new, old in columns.items()])
    order = [*df.columns, *[c for c in columns if c not in df.columns]]
    joined = df.drop(*columns).join(got, key, "left")
    return joined.select(*[F.col(f"__new_{c}").alias(c) if c in columns else F.col(c) for c in order])
