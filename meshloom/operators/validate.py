"""Checks of a final dataset, as a report of rows (check, batch_id, severity, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import all_finite, is_missing

REPORT = "check string, batch_id int, severity string, detail string"


def finding(check: str, severity: Column | str, detail: Column) -> list[Column]:
    return [F.lit(check).alias("check"), F.col("batch_id").cast("int").alias("batch_id"), (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"), detail.cast("string").alias("detail")]


def missing_batches(index: DataFrame, final: DataFrame) -> DataFrame:
    lost = index.select("batch_id").distinct().join(final.select("batch_id").distinct(), "batch_id", "left_anti")
    return lost.select(*finding("output", "fail", F.lit("no output")))


def row_counts(index: DataFrame, final: DataFrame) -> DataFrame:
    """(batch_id, expected, found) of batches whose counts differ."""
    a = index.groupBy("batch_id").agg(F.count("*").alias("expected"))
    b = final.groupBy("batch_id").agg(F.count("*").alias("found"))
    both = a.join(b, "batch_id", "full").select("batch_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("expected", "found")])
    return both.where("expected <> found")


def coordinates(final: DataFrame, lat: tuple[float, float], lon: tuple[float, float], tolerance: float = 1e-6) -> DataFrame:
    """(batch_id, missing, outside): missing coordinates fail, those outside the box warn."""
    missing = is_missing(F.col("Latitude")) | is_missing(F.col("Longitude"))
    inside = F.col("Latitude").between(lat[0] - tolerance, lat[1] + tolerance) & F.col("Longitude").between(lon[0] - tolerance, lon[1] + tolerance)
    return final.groupBy("batch_id").agg(F.sum(missing.cast("long")).alias("missing"), F.sum((~missing & ~inside).cast("long")).alias("outside"))


def first_rows(df: DataFrame, n: int, order: str = "__row_id") -> DataFrame:
    """The first n rows of each batch."""
    from pyspark.sql import Window

    return df.withColumn("__n", F.row_number().over(Window.partitionBy("batch_id").orderBy(order))).where(F.col("__n") <= n).drop("__n")


def bad_series(final: DataFrame, columns: list[str], length: int, sample_rows: int | None = 20) -> DataFrame:
    """(batch_id, column, wrong_length, not_finite) over the first rows of each batch (all rows for None)."""
    rows = first_rows(final, sample_rows) if sample_rows else final
    long = rows.select("batch_id", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("array<double>").alias("series")) for c in columns])).alias("x")).select("batch_id", "x.*")
    wrong = F.col("series").isNull() | (F.size("series") != length)
    return long.groupBy("batch_id", "column").agg(F.sum(wrong.cast("long")).alias("wrong_length"), F.sum((~F.coalesce(all_finite(F.col("series")), F.lit(True))).cast("long")).alias("not_finite"))


def nan_ratios(final: DataFrame, columns: list[str]) -> DataFrame:
    """(batch_id, column, nan_ratio, infinite); all columns in one pass and one row a batch, turned round afterwards."""
    wide = final.groupBy("batch_id").agg(*[c for i, n in enumerate(columns) for c in number_checks(n, f"{i}")])
    return wide.select("batch_id", F.explode(F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"nan_{i}").alias("nan_ratio"), F.col(f"inf_{i}").alias("infinite")) for i, n in enumerate(columns)])).alias("x")).select("batch_id", "x.*")


def number_checks(column: str, name: str) -> list[Column]:
    v = F.col(column).cast("double")
    return [F.avg(is_missing(v).cast("double")).alias(f"nan_{name}"), F.sum(F.coalesce((F.abs(v) == float("inf")).cast("long"), F.lit(0))).alias(f"inf_{name}")]


def report(index: DataFrame, final: DataFrame, *, lat: tuple[float, float], lon: tuple[float, float], series: list[str], series_length: int, numbers: list[str], prefixes: tuple[str, ...] = ("Y_", "pft_"), max_nan: float = 0.01, sample_rows: int = 20, tolerance: float = 1e-6) -> DataFrame:
    """All findings; an absent number column passes, an absent series column or prefix does not.

    The dataset is read once, to one row a batch; which rows are a batch's first ones is read before from its keys alone.
    """
    arrays = [s for s in series if s in final.columns and dict(final.dtypes)[s].startswith("array")]
    there = [n for n in numbers if n in final.columns]
    last = first_rows(final.select("batch_id", "__row_id"), sample_rows).groupBy("batch_id").agg(F.max("__row_id").alias("__last"))
    missing = is_missing(F.col("Latitude")) | is_missing(F.col("Longitude"))
    inside = F.col("Latitude").between(lat[0] - tolerance, lat[1] + tolerance) & F.col("Longitude").between(lon[0] - tolerance, lon[1] + tolerance)
    sampled = F.col("__row_id") <= F.col("__last")
    checks = [F.count("*").alias("found"), F.count_if(missing).alias("missing"), F.count_if(~missing & ~inside).alias("outside")]
    for i, s in enumerate(arrays):
        values = F.col(s).cast("array<double>")
        checks.append(F.count_if(sampled & (values.isNull() | (F.size(values) != series_length))).alias(f"wrong_{i}"))
        checks.append(F.count_if(sampled & ~F.coalesce(all_finite(values), F.lit(True))).alias(f"odd_{i}"))
    checks += [c for i, n in enumerate(there) for c in number_checks(n, f"{i}")]
    seen = final.join(last, "batch_id").groupBy("batch_id").agg(*checks)
    both = index.groupBy("batch_id").agg(F.count("*").alias("expected")).join(seen, "batch_id", "full")
    here, rows = F.col("found").isNotNull(), [F.coalesce(c, F.lit(0)) for c in ("found", "expected")]
    found = [
        ("output", "fail", F.col("expected").isNotNull() & ~here, F.lit("no output")),
        ("rows", "fail", rows[0] != rows[1], F.format_string("%d rows, not %d", *rows)),
        ("coordinates", "fail", F.col("missing") > 0, F.format_string("%d missing", "missing")),
        ("coordinates", "warn", F.col("outside") > 0, F.format_string("%d outside", "outside")),
        *(("series", "fail", here, F.lit(f"{s} is absent or no array")) for s in series if s not in arrays),
        *(("series", "fail", (F.col(f"wrong_{i}") > 0) | (F.col(f"odd_{i}") > 0), F.format_string(f"{s}: %d of wrong length, %d not finite", f"wrong_{i}", f"odd_{i}")) for i, s in enumerate(arrays)),
        *(("numbers", "fail", (F.col(f"nan_{i}") > max_nan) | (F.col(f"inf_{i}") > 0), F.format_string(f"{n}: NaN ratio %.4f, %d infinite", f"nan_{i}", f"inf_{i}")) for i, n in enumerate(there)),
        *(("prefix", "warn", here, F.lit(f"no column begins with {p}")) for p in prefixes if not any(n.startswith(p) for n in final.columns)),
    ]
    told = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), detail.alias("detail"))) for check, severity, when, detail in found]))
    return both.select(F.col("batch_id").cast("int").alias("batch_id"), F.explode(told).alias("x")).select("x.check", "batch_id", "x.severity", "x.detail")


def exit_code(findings: DataFrame) -> int:
    return int(not findings.where("severity = 'fail'").isEmpty())
