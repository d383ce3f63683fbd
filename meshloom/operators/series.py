"""Means of series: over fixed calendar segments of an array, and over time in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DAYS_PER_MONTH
from ..functions.scalars import no_nan

NAN = float("nan")


def bounds(steps_per_day: int, years: int, days: tuple[int, ...] = DAYS_PER_MONTH) -> list[tuple[int, int]]:
    """(first sample, samples) of each month; samples count from 1. A year has 365 days."""
    out, at = [], 1
    for _ in range(years):
        for d in days:
            out.append((at, d * steps_per_day))
            at += d * steps_per_day
    return out


def monthly_means(series: Column, length: int, steps_per_day: int, years: int, strict: bool = False) -> Column:
    """Monthly means of an array of samples on the fixed calendar.

    NULL and empty give an empty array. A length that is a multiple of 12, but not ``length``, is taken as monthly already and passes
    through; any other wrong length gives an empty array. A month beyond the end is NaN, or with strict an error.
    """
    table = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(n).alias("n")) for a, n in bounds(steps_per_day, years)])

    def mean(b: Column) -> Column:
        part = F.slice(series, b["a"], b["n"])
        total = F.aggregate(part, F.lit(0.0), lambda s, x: s + x.cast("double"))
        over = F.raise_error(F.lit("a month runs beyond the end of the series")) if strict else F.lit(NAN)
        return F.when(F.size(part) > 0, total / F.size(part)).otherwise(over.cast("double"))

    n, none = F.size(series), F.array().cast("array<double>")
    return F.when(series.isNull() | (n <= 0), none).when((n % 12 == 0) & (n != length), series.cast("array<double>")).when(n != length, none).otherwise(F.transform(table, mean))


def block_means(blocks: DataFrame, cell: list[str], first: str, values: str, length: int, steps_per_day: int, years: int, strict: bool = False, out: str = "series") -> DataFrame:
    """(cell, out): the monthly means of series that lie in blocks (cell, first, values), by the rules of ``monthly_means``.

    Each block gives (month, sum, count) of the months that it touches; these are added up, in each task first, so that no series is ever
    one value. Only series that are monthly already are put together from their blocks. Sums of a month that two blocks share are added
    in any order, so the last bits of its mean may differ from those of one array.
    """
    table = F.array(*[F.struct(F.lit(k).alias("month"), F.lit(a - 1).alias("a"), F.lit(a - 1 + n).alias("b")) for k, (a, n) in enumerate(bounds(steps_per_day, years))])
    at, to = F.col(first), F.col(first) + F.size(values)
    sized = blocks.withColumn("__size", F.greatest(F.size(values), F.lit(0)))

    def share(m: Column) -> Column:
        low = F.greatest(m["a"], at)
        part = F.slice(values, (low - at + 1).cast("int"), (F.least(m["b"], to) - low).cast("int"))
        total = F.aggregate(part, F.lit(0.0), lambda s, x: s + x.cast("double"))
        return F.struct(m["month"].alias("month"), total.alias("total"), F.size(part).alias("n"))

    touched = F.transform(F.filter(table, lambda m: (m["a"] < to) & (at < m["b"])), share)
    shares = sized.select(*cell, F.col("__size"), F.posexplode_outer(touched).alias("__k", "__m"))
    # a block's length counts once
    shares = shares.select(*cell, F.when(F.coalesce("__k", F.lit(0)) == 0, F.col("__size")).alias("size"), "__m.month", "__m.total", "__m.n")
    lost = F.max(F.when(F.col("month").isNotNull() & F.col("total").isNull(), 1))
    months = shares.groupBy(*cell, "month").agg(F.sum("size").alias("size"), F.sum("total").alias("total"), F.sum("n").alias("n"), lost.alias("lost"))
    mean = F.when(F.col("lost").isNull(), F.col("total") / F.col("n"))
    there = F.collect_list(F.when(F.col("month").isNotNull(), F.struct("month", mean.alias("mean"))))
    cells = months.groupBy(*cell).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("__n"), F.map_from_entries(there).alias("__months"))
    over = F.raise_error(F.lit("a month runs beyond the end of the series")) if strict else F.lit(NAN)
    means = F.transform(F.sequence(F.lit(0), F.lit(12 * years - 1)), lambda k: F.when(F.map_contains_key("__months", k), F.col("__months")[k]).otherwise(over.cast("double")))
    monthly = (F.col("__n") > 0) & (F.col("__n") % 12 == 0) & (F.col("__n") != length)
    own = cells.where(~monthly).select(*cell, F.when(F.col("__n") == length, means).otherwise(F.array().cast("array<double>")).alias(out))
    from .gather import series_from_blocks

    lengths = sized.groupBy(*[F.col(c).alias(f"__{c}") for c in cell]).agg(F.sum("__size").alias("__n")).where(monthly)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cell]
    whole = series_from_blocks(blocks.join(lengths, same, "left_semi"), cell, first, values, out)
    return own.unionByName(whole.withColumn(out, F.col(out).cast("array<double>")))


def time_mean(rows: DataFrame, cell: list[str], value: str, out: str = "mean") -> DataFrame:
    """Mean of each cell over time, NaN left out; NULL where all are NaN."""
    return rows.groupBy(*cell).agg(F.avg(no_nan(F.col(value))).alias(out))


def stacked(means: DataFrame, cell: list[str], step: str, value: str, out: str = "series") -> DataFrame:
    """Means (cell, step, value) to one array a cell in step order."""
    from .gather import series_from_steps

    return series_from_steps(means, cell, step, value, out)
