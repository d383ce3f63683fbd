"""Mixing sources to target weights, with DataFrame functions only.

Sources, in code point order with null last, weigh 3, 1, 2, 3, 1, 2, ... and share ``share`` times all words by weight; no target
exceeds ``most`` times its source's size, and what is above is shared again by weight among the others until none is above.
A source's rate is its target over its size; each document is emitted floor(rate) times, and once more where its seeded hash
falls below the fraction.

Defined cases: a null text has size 0; a null source is a source of its own; sources of size 0 have target 0 and are not taken;
documents of size 0 may be copied and take no words; repeated rows draw alike, as do rows with a null doc_id; an empty table
gives no rows; other columns are kept by ``mixed`` and ignored by ``plan``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import dense_row_id
from .common import materialise, spare

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    seed: int = 7


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, source: str, size: str, settings: Settings = Settings()) -> DataFrame:
    """(source, source_size, target), a row for each source of sized."""
    totals = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    ranked = dense_row_id(totals, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in settings.weights]), (F.col("rank") % len(settings.weights) + 1).cast("int"))
    ranked = materialise(ranked.withColumn("weight", weight), "mixing-sources")
    cap = F.col("source_size") * F.lit(settings.most)
    words, heft = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = settings.share * words / heft if words else 0.0
    while words:  # each round caps at least one source more, or ends
        above = cap <= F.col("weight") * F.lit(level)
        capped, heft = ranked.agg(F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if not heft or (raised := (settings.share * words - capped) / heft) <= level:
            break
        level = raised
    return ranked.select("source", "source_size", F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """In [0, 1), fixed for a key and a seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def copies(key: Column, rate: Column, seed: int) -> Column:
    return (F.floor(rate) + (uniform(key, seed) < rate - F.floor(rate)).cast("long")).cast("long")


def plan(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, size, source_size, target, copies, taken), one row for each row of docs."""
    sized = materialise(docs.select(F.col(key), F.col(source).alias("source"), size_of(text).alias("size")), "mixing-sizes")
    aims = materialise(targets(sized, "source", "size", settings).withColumnRenamed("source", "__source"), "mixing-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.join(aims, F.col("source").eqNullSafe(F.col("__source")))
    return joined.withColumn("copies", copies(F.col(key), rate, settings.seed)).select(key, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs with each row as often as the mix takes it."""
    sized = docs.select(F.col(source).alias("source"), size_of(text).alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    own, rate = spare(docs, "source"), spare(docs, "rate")
    aims = targets(sized, "source", "size", settings).select(F.col("source").alias(own), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias(rate))
    joined = docs.join(materialise(aims, "mixing-targets"), F.col(source).eqNullSafe(F.col(own)))
    again = F.explode(F.sequence(F.lit(1), copies(F.col(key), F.col(rate), settings.seed).cast("int")))
    times = copies(F.col(key), F.col(rate), settings.seed)
    return joined.where(times > 0).withColumn(own, again).select(*docs.columns)
