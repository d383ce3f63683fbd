"""Nearest-neighbour joins in degrees, without comparing all pairs.

Candidates are the leaves of a quadtree in Morton order: a place's number interleaves the bits of its two cell numbers, so that the boxes
of each level are what shares a beginning of it. One pass gives every box of a level that has one its number of candidates and their
extent, each level rolled up from the one below; the candidates are not read again. A query goes down from the root: of the boxes that
may hold its nearest candidate those that are further away than the farthest corner of another are left, and the others are replaced by
the boxes in them, several levels at a step, until they hold few candidates. Those are compared: first for the least distance alone, whose
partial minima need no sort, then for the index, in the boxes that reach that distance. Queries at one place are one. Tasks that sort grow
in number with their rows, not in size. Ties go to the smallest candidate index. Distances are Euclidean in degrees; longitudes don't wrap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import no_nan, square, wrap_positive, wrap_signed
from ..sources.shared import discard, materialise

#: bits of each cell number of the finest level, levels that a step goes down, and candidates of a box that are compared at once
DEPTH, STEP, CROWD = 30, 2, 64
#: rows that are sorted in one task, some, and rows below which a task isn't worth its start
SORTED, WORTH = 1_000_000, 10_000
#: where queries are, and what is told of such a place on its way down
PLACE = ["q_lat", "q_lon"]
ROW = ["place", *PLACE]


def by_place(df: DataFrame, most: int) -> DataFrame:
    """df, of so many rows at most, with the rows of a place in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(min(n, most // WORTH + 1), -(-most // SORTED)), "place")


def best_of(leaves: DataFrame, points: DataFrame) -> DataFrame:
    """(place, d2, idx) of the nearest point in the leaves' boxes.

    A minimum of structs would sort all pairs before the shuffle; minima of numbers are hashed.
    """
    d2 = square(F.col("q_lat") - F.col("c_lat")) + square(F.col("q_lon") - F.col("c_lon"))
    least = materialise(leaves.join(points, ["level", "box"]).groupBy("place").agg(F.min(d2).alias("d2")), "nearest-least")
    again = leaves.join(least, "place").where("near <= d2").join(points, ["level", "box"]).where(d2 == F.col("d2"))
    best = materialise(again.groupBy("place").agg(F.min("d2").alias("d2"), F.min("c_idx").alias("idx")), "nearest-best")
    discard(least)
    return best


def spread(x: Column) -> Column:
    """The 30 bits of x, each with a zero before it."""
    # The masks of the well-known bit spreading.
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def morton(lat: str, lon: str, low: tuple[float, float], side: float) -> Column:
    """The place's number among the 4^30 cells of the square."""
    cell = lambda c, a: F.least(F.floor((F.col(c) - F.lit(a)) / F.lit(side) * F.lit(float(1 << DEPTH))), F.lit((1 << DEPTH) - 1)).cast("long")
    return spread(cell(lat, low[0])).bitwiseOR(F.shiftleft(spread(cell(lon, low[1])), 1))


def box_tree(points: DataFrame) -> DataFrame:
    """(level, box, parent, n, a, b, c, d) of the boxes with points at every STEP-th level: number of points, their extent, and the box a
    step above that holds it. Below boxes of few points there are none, but where rows that follow on a box may lie in another batch.

    points(code, seq, c_lat, c_lon) are sorted by code wherever seq counts on, so boxes of all levels are runs of rows.
    """
    depth, step, crowd = DEPTH, STEP, CROWD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, seq, lat, lon = (c.to_numpy() for c in batch.columns)
            breaks = np.append(True, seq[1:] != seq[:-1] + 1)
            above, open_ = np.zeros(len(code), np.int64), np.ones(1, bool)
            for level in range(0, depth + 1, step):
                box = code >> (2 * (depth - level))
                starts = np.flatnonzero(breaks | np.append(True, box[1:] != box[:-1]))
                n = np.diff(np.append(starts, len(code)))
                kept = open_[above[starts]]
                ends = np.append(starts[1:], len(code))
                columns = [np.full(len(starts), level, np.int32), box[starts], n]
                columns += [f.reduceat(x, starts) for x in (lat, lon) for f in (np.minimum, np.maximum)]
                if kept.any():
                    yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in columns], names=["level", "box", "n", "a", "b", "c", "d"])
                # what is below a run is told if it has many points, or if it may go on in another batch
                open_ = kept & ((n > crowd) | breaks[starts] | np.append(breaks, True)[ends])
                above = np.repeat(np.arange(len(starts)), n)

    runs = points.select("code", "seq", "c_lat", "c_lon").mapInArrow(run, "level int, box long, n long, a double, b double, c double, d double")
    boxes = runs.groupBy("level", "box").agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"), F.min("c").alias("c"), F.max("d").alias("d"))
    return boxes.withColumn("parent", F.when(F.col("level") > 0, F.shiftright("box", 2 * STEP)).otherwise(F.lit(-1)))


def nearest_join(queries: DataFrame, candidates: DataFrame, key: str, index: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(key, d2, idx): for each query with coordinates the index of its nearest candidate. key must be unique."""
    finite = lambda *c: F.expr(" AND ".join(f"{x} IS NOT NULL AND NOT isnan({x}) AND abs({x}) < double('inf')" for x in c))
    q = queries.select(F.col(key), F.col(lat).cast("double").alias("q_lat"), F.col(lon).cast("double").alias("q_lon")).where("q_lat IS NOT NULL AND q_lon IS NOT NULL")
    # candidates at one place are one, with the smallest index
    c = candidates.select(F.col(index).alias("c_idx"), F.col(lat).cast("double").alias("c_lat"), F.col(lon).cast("double").alias("c_lon")).where(finite("c_lat", "c_lon"))
    c = c.groupBy("c_lat", "c_lon").agg(F.min("c_idx").alias("c_idx"))
    a, b, x, y, least = c.agg(F.min("c_lat"), F.max("c_lat"), F.min("c_lon"), F.max("c_lon"), F.min("c_idx")).first()
    if a is None:
        return q.select(key, F.lit(None).cast("double").alias("d2"), F.lit(None).cast("long").alias("idx")).limit(0)
    low, side = (a, x), max(b - a, y - x) or 1.0
    # one sort in Morton order, so that boxes are added up where their points lie
    placed = c.withColumn("code", morton("c_lat", "c_lon", low, side)).repartitionByRange("code").sortWithinPartitions("code")
    placed = materialise(placed.withColumn("seq", F.monotonically_increasing_id()), "nearest-points")
    tree = materialise(box_tree(placed), "nearest-tree", "level")
    # no distance is finite: the smallest index
    lost = q.where(~finite("q_lat", "q_lon")).select(key, F.lit(None).cast("double").alias("d2"), F.lit(least).alias("idx"))
    found = q.where(finite("q_lat", "q_lon"))
    return found.join(descend(found.select(*PLACE).distinct(), placed, tree), PLACE).select(key, "d2", "idx").unionByName(lost)


def descend(places: DataFrame, points: DataFrame, tree: DataFrame) -> DataFrame:
    """(q_lat, q_lon, d2, idx) by the tree; a step is one join with the boxes of its level and one bound a place."""
    gap = lambda q, a, b: F.greatest(F.col(a) - F.col(q), F.col(q) - F.col(b), F.lit(0.0))
    far = lambda q, a, b: F.greatest(F.abs(F.col(q) - F.col(a)), F.abs(F.col(q) - F.col(b)))
    # the last bits of a sum of squares may differ from one way of computing it to another
    near = (square(gap("q_lat", "a", "b")) + square(gap("q_lon", "c", "d"))) * F.lit(1 - 1e-12)
    far = (square(far("q_lat", "a", "b")) + square(far("q_lon", "c", "d"))) * F.lit(1 + 1e-12)
    # numbers, as a window over doubles would deal them anew; the root's table holds each place once
    open_, leaves, held, rows = places.withColumn("place", F.monotonically_increasing_id()).withColumn("parent", F.lit(-1).cast("long")), None, [], 0
    for level in range(0, DEPTH + 1, STEP):
        boxes = tree.where(F.col("level") == level).drop("level")
        kept = open_.join(boxes, "parent").select(*ROW, "box", "n", near.alias("near"), far.alias("far"))
        if level:  # at the root a place meets one box
            kept = by_place(kept, rows << 2 * STEP).withColumn("bound", F.min("far").over(Window.partitionBy("place"))).where("near <= bound")
        kept = materialise(kept.select(*ROW, "box", "n", "near"), "nearest-open")
        held.append(kept)
        rows = kept.count()
        last = level + STEP > DEPTH
        few = (kept if last else kept.where(F.col("n") <= CROWD)).select(*ROW, F.lit(level).alias("level"), "box", "near")
        leaves = few if leaves is None else leaves.unionByName(few)
        open_ = kept.where(F.col("n") > CROWD).select(*ROW, F.col("box").alias("parent"))
        if last or open_.isEmpty():
            break
    # each point stands once in each level that has boxes to compare; those whose box is not among them meet nothing
    levels = sorted(r.level for r in leaves.select("level").distinct().collect())
    each = points.select("code", "c_idx", "c_lat", "c_lon", F.explode(F.array(*map(F.lit, levels))).alias("level")) if levels else points.select("code", "c_idx", "c_lat", "c_lon", F.lit(0).alias("level"))
    each = each.withColumn("box", F.expr(f"shiftright(code, CAST(2 * ({DEPTH} - level) AS INT))")).drop("code")
    best = best_of(leaves, each)
    met = materialise(held[0].select(*ROW).join(best, "place").select(*PLACE, "d2", "idx"), "nearest")
    discard(points, tree, best, *held)
    return met


def nearest_on_axis(queries: DataFrame, axis: DataFrame, key: str, value: str = "value", index: str = "axis_idx") -> DataFrame:
    """(key, index) of the axis value nearest to each query; of two equally near the lower value; clamped at the ends.

    Both sides are sorted together and each query looks to the last axis value at or below and the first above: a sort, no join of
    ranges. Partitions are cut by range and, within one value, by a hash, so neither crowded nor equal values pile up in a task;
    what lies in the partitions before and after is told by one pair of axis values for each.
    """
    q = queries.select(F.col(key), F.col(value).cast("double").alias("v"), F.lit(None).cast("double").alias("a"), F.lit(None).cast("long").alias("i"))
    a = axis.select(F.lit(None).cast(queries.schema[key].dataType).alias(key), F.col(value).cast("double").alias("v"), F.col(value).cast("double").alias("a"), F.col(index).cast("long").alias("i")).where("a IS NOT NULL")
    if a.isEmpty():
        return q.select(key, F.col("i").alias(index)).limit(0)
    both = q.unionByName(a).withColumn("deal", F.when(F.col("i").isNotNull(), F.lit(None)).otherwise(F.xxhash64(key)))
    n = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), both.count() // SORTED)
    # axis values come before the queries that equal them; written once, as another run could cut other ranges
    placed = materialise(both.repartitionByRange(n, F.col("v"), F.col("deal").asc_nulls_first()).withColumn("part", F.spark_partition_id()), "nearest-axis")
    ends = placed.groupBy("part").agg(F.min(F.when(F.col("i").isNotNull(), F.struct("a", "i"))).alias("first"), F.max(F.when(F.col("i").isNotNull(), F.struct("a", F.negate("i").alias("i")))).alias("last"))
    order = Window.orderBy("part")  # one row a partition
    before, after = F.last("last", True).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.first("first", True).over(order.rowsBetween(1, Window.unboundedFollowing))
    ends = ends.select(F.col("part").alias("p"), F.struct(before["a"].alias("a"), F.negate(before["i"]).alias("i")).alias("before"), after.alias("after"))
    here = F.when(F.col("i").isNotNull(), F.struct("a", "i"))
    down = Window.partitionBy("part").orderBy("v", F.col("i").isNull(), F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("part").orderBy(F.desc("v"), F.col("i").isNull().desc(), F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    near = placed.withColumn("lo", F.last(here, True).over(down)).withColumn("hi", F.last(here, True).over(up)).where(F.col("i").isNull())
    near = near.join(F.broadcast(ends), F.col("part") == F.col("p"))
    lo, hi = F.coalesce("lo", F.when(F.col("before.a").isNotNull(), F.col("before"))), F.coalesce("hi", "after")
    near = near.select(key, "v", lo.alias("lo"), hi.alias("hi"))
    lower = F.col("hi").isNull() | (F.col("lo").isNotNull() & (F.abs(F.col("v") - F.col("lo.a")) <= F.abs(F.col("hi.a") - F.col("v"))))
    return near.select(key, F.when(lower, F.col("lo.i")).otherwise(F.col("hi.i")).alias(index))


def normalised_longitude(queries: DataFrame, axis: DataFrame, lon: str = "lon") -> DataFrame:
    """queries with lon in the axis' convention, decided on whole columns: an axis from 0 up wraps negative queries to 0..360; an axis up to 180 wraps larger ones to -180..180."""
    x = no_nan(F.col(lon))
    axis_min, axis_max = axis.agg(F.min(x), F.max(x)).first()
    q_min, q_max = queries.agg(F.min(x), F.max(x)).first()
    if None in (axis_min, axis_max, q_min, q_max):
        return queries
    if axis_min >= 0 and q_min < 0:
        return queries.withColumn(lon, wrap_positive(F.col(lon)))
    if axis_max <= 180 and q_max > 180:
        return queries.withColumn(lon, wrap_signed(F.col(lon)))
    return queries
