"""SimHash near-duplicates: exact comparison of fingerprint tiles by exclusive-or and bit counts.

A fingerprint has a bit for each bit that is set in over half of the hashes of a text's 3-word shingles. Fingerprints link at
``radius`` (2) or fewer differing bits. Equal fingerprints are one node. The 64 bits are cut into radius + 2 blocks; two linked
fingerprints agree in at least two of them, so each fingerprint goes to the bucket of every pair of its blocks and no link is
missed. A bucket is compared in tiles sorted by population count; a tile pair whose counts differ beyond the radius is skipped.
Buckets beyond ``tile`` fingerprints are split by population count, and counts of more than ``tile`` fingerprints into parts; each
pair of parts whose counts differ by the radius at most is a group of its own, so no task gets a whole large bucket, and parts that
can't link never meet. A group of tiles returns links that span its components, not all its pairs.

Defined cases: null and empty texts have the fingerprint zero and link like any other; texts of one or two words hash as a whole;
repeated rows and copies share a fingerprint and one component; rows with a null doc_id get the component of their fingerprint
(null if only they are in it); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, per_row, row_id, spare
from .components import components


@dataclass(frozen=True)
class Settings:
    shingle: int = 3
    seed: int = 42
    radius: int = 2
    tile: int = 2048


def fingerprinter(settings: Settings):
    import xxhash

    digest, seed, k = xxhash.xxh64_digest, settings.seed, settings.shingle

    def fingerprint(text: bytes | None) -> int:
        """Signed, as Spark's long."""
        words = text.lower().split() if text else []
        if not words:
            return 0
        if len(words) < k:
            hashes = digest(b" ".join(words), seed)
        elif k == 3:
            hashes = b"".join([digest(b"%b %b %b" % x, seed) for x in zip(words, words[1:], words[2:], strict=False)])
        else:
            hashes = b"".join([digest(b" ".join(words[i : i + k]), seed) for i in range(len(words) - k + 1)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts = np.zeros(64, np.int64)
        for at in range(0, len(bits), 255):  # sums of 255 bits fit a byte, which numpy adds fastest
            counts += np.add.reduce(bits[at : at + 255], axis=0, dtype=np.uint8)
        return int(np.packbits(2 * counts > len(bits)).view(">i8")[0])

    return fingerprint


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    def make():
        f, n = fingerprinter(settings), len(keep)
        return lambda *row: (*row[:n], f(row[n]))

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("fp", T.LongType())])
    return per_row(docs.select(*keep, F.col(text).cast("binary").alias("__text")), make, schema)


def blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 blocks over 64 bits."""
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def bucketed(nodes: DataFrame, radius: int) -> DataFrame:
    """Each fp once for each pair of its blocks: (fp, pair, k)."""
    cut = [F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)) for shift, width in blocks(radius)]
    pairs = [F.struct(F.lit(p).alias("pair"), F.xxhash64(cut[i], cut[j]).alias("k")) for p, (i, j) in enumerate(combinations(range(radius + 2), 2))]
    return nodes.select("fp", F.explode(F.array(*pairs)).alias("x")).select("fp", "x.pair", "x.k")


class Forest:
    """Links that join the components of numbered nodes."""

    def __init__(self, n: int):
        self.parent, self.left, self.right = list(range(n)), [], []

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        p, q = self.root(i), self.root(j)
        if p != q:
            self.parent[q] = p
            self.left.append(i)
            self.right.append(j)


def spanning(fps: np.ndarray, radius: int, tile: int, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius that join the components of fps (signed, distinct), or, with second (1 for some of fps), of those between its two parts."""
    fps = fps.view(np.uint64)
    ones = np.bitwise_count(fps)
    order = np.argsort(ones, kind="stable")
    fps, ones = fps[order], ones[order].astype(np.int16)
    side = np.zeros(len(fps), np.int8) if second is None else second[order].astype(np.int8)
    rows = np.flatnonzero(side == 0)
    columns = rows if second is None else np.flatnonzero(side == 1)
    forest = Forest(len(fps))
    for a in range(0, len(rows), tile):
        x = rows[a : a + tile]
        for b in range(a if second is None else 0, len(columns), tile):
            y = columns[b : b + tile]
            # the tiles' population counts differ beyond the radius
            if ones[y[0]] - ones[x[-1]] > radius:
                break
            if ones[x[0]] - ones[y[-1]] > radius:
                continue
            for r in range(0, len(x), 256):
                close = np.bitwise_count(fps[x[r : r + 256], None] ^ fps[None, y]) <= radius
                for i, j in zip(*np.nonzero(close), strict=True):
                    i, j = int(x[r + i]), int(y[j])
                    if i < j or (second is not None and i != j):
                        forest.join(i, j)
    return fps[forest.left].view(np.int64), fps[forest.right].view(np.int64)


def links(nodes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Distinct nodes(fp) to links (a, b) that join all fingerprints within the radius of one another."""
    radius, tile = settings.radius, settings.tile
    keyed = bucketed(nodes, radius).withColumn("ones", F.bit_count("fp"))
    classes = keyed.groupBy("pair", "k", "ones").agg(F.count("*").alias("n"))
    # at most 65 population counts a bucket
    sizes = classes.groupBy("pair", "k").agg(F.sum("n").alias("size"), F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("parts"))).alias("classes")).where("size > 1")
    sizes = materialise(sizes, "simhash-buckets")
    held = keyed.join(sizes, ["pair", "k"])
    own = F.filter("classes", lambda c: c["ones"] == F.col("ones"))[0]["parts"]
    held = held.withColumn("part", F.pmod(F.xxhash64("fp"), own).cast("int"))
    near = F.filter("classes", lambda c: F.abs(c["ones"] - F.col("ones")) <= radius)
    others = F.flatten(F.transform(near, lambda c: F.transform(F.sequence(F.lit(0), c["parts"] - 1), lambda p: F.struct(c["ones"].alias("ones"), p.alias("part")))))
    mine = F.struct("ones", "part")
    groups = F.transform(others, lambda o: F.struct(F.least(mine, o).alias("low"), F.greatest(mine, o).alias("high")))
    # a bucket of one tile or less is one group
    none = F.struct(F.lit(-1).alias("ones"), F.lit(-1).alias("part"))
    groups = F.when(F.col("size") <= tile, F.array(F.struct(none.alias("low"), none.alias("high")))).otherwise(groups)
    dealt = held.withColumn("g", F.explode(groups)).select("fp", "pair", "k", "g.low", "g.high", ((F.col("g.low") != F.col("g.high")) & (F.col("g.high") == mine)).cast("int").alias("second"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        second = group["second"].to_numpy()
        a, b = spanning(group["fp"].to_numpy(), radius, tile, second if second.any() else None)
        return pd.DataFrame({"a": a, "b": b})

    # dealt by number: groups are small in bytes but long in time, and would be put together in one task
    dealt = dealt.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "pair", "k", "low", "high")
    return dealt.groupBy("pair", "k", "low", "high").applyInPandas(compare, "a long, b long")


def with_components(prints: DataFrame, key: str, settings: Settings = Settings()) -> DataFrame:
    """prints(key, fp, ...) with component, a fingerprint that stands for it, and component_id, the smallest key that links reach."""
    nodes = materialise(prints.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    found = materialise(components(links(nodes.select("fp"), settings)), "simhash-components")
    own = nodes.join(found, nodes.fp == found.node, "left").select(nodes.fp, "least", F.coalesce("component", nodes.fp).alias("component"))
    own = materialise(own, "simhash-own")
    least = materialise(own.groupBy("component").agg(F.min("least").alias("component_id")), "simhash-least")
    ids = materialise(own.join(least, "component").select("fp", "component", "component_id"), "simhash-ids")
    return prints.join(ids.withColumnRenamed("fp", "__fp"), F.col("fp") == F.col("__fp")).drop("__fp")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, fingerprint, component_id), one row for each row of docs."""
    prints = materialise(fingerprints(docs, [key], text, settings), "simhash-prints")
    return with_components(prints, key, settings).select(key, as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of docs for each component: that of the smallest key, nulls last, and of rows with that key the first read."""
    rid = spare(docs, "rid")
    # written, so that every reading has the same row numbers
    held = materialise(docs.withColumn(rid, row_id()), "simhash-docs")
    prints = materialise(fingerprints(held, [rid, key], text, settings), "simhash-prints")
    order = F.struct(F.col(key).isNull(), F.col(key), F.col(rid))
    first = with_components(prints, key, settings).groupBy("component").agg(F.min_by(rid, order).alias(rid)).select(rid)
    return held.join(first, rid, "left_semi").select(*docs.columns)
