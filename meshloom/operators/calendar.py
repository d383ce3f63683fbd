"""Monthly files: names, the calendar they should fill, and one file for each month."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def name_pattern(token: str) -> str:
    # Fixed value: the form of the file names.
    return rf"^(?:.*_)?cl[i]?mforc\..*\.\Q{token}\E\.(\d{{4}})-(\d{{2}})\.nc$"


def month_files(paths: DataFrame, token: str, first: int, last: int) -> DataFrame:
    """paths(path) to (path, year, month) of the files of one token within the years."""
    if not token or not token.strip():
        raise ValueError("no token for this variable")
    if r"\E" in token:
        raise ValueError(f"a token can't hold {re.escape(token)}")
    name = F.element_at(F.split("path", "/"), -1)
    parts = paths.select("path", *[F.regexp_extract(name, name_pattern(token), k).alias(c) for k, c in ((1, "year"), (2, "month"))])
    return parts.where("year <> ''").select("path", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).where(F.col("year").between(first, last) & F.col("month").between(1, 12))


def first_of_month(files: DataFrame) -> DataFrame:
    """(year, month, path, candidates): the first path of each month by name."""
    return files.groupBy("year", "month").agg(F.min("path").alias("path"), F.count("*").alias("candidates"))


def calendar(spark: SparkSession, first: int, last: int) -> DataFrame:
    months = spark.range((last - first + 1) * 12)
    return months.select((F.floor(F.col("id") / 12) + first).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"))


def missing_months(files: DataFrame, first: int, last: int) -> DataFrame:
    return calendar(files.sparkSession, first, last).join(files.select("year", "month").distinct(), ["year", "month"], "left_anti")


def numbered_months(files: DataFrame, strict: bool = False, first: int | None = None, last: int | None = None) -> DataFrame:
    """(step, year, month, path): files in calendar order, numbered from 0. A missing month makes later ones move up; strict raises instead."""
    if strict and not missing_months(files, first, last).isEmpty():
        raise ValueError("months are missing")
    from .numbering import dense_row_id

    return dense_row_id(first_of_month(files), ["year", "month"], "step", 1).select("step", "year", "month", "path")


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path) of all files below root; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
