"""Substring dedup: suffix automata of reference shards give matching statistics, and long repeats of earlier documents go.

A window is ``window`` consecutive words. A word goes if a window that covers it also starts in a document with a smaller doc_id.
Every window is assigned to the smallest hash among its ``anchor``-word runs, so equal windows share it wherever they stand, and
consecutive windows with one anchor make a piece. Documents whose pieces are equal need no further comparison; of different pieces
with one anchor the words are gathered, and the anchor's shard is a suffix automaton of them whose states know the smallest doc_id
that holds their strings. Streaming the pieces through it gives each window's earliest holder.

Shards are dealt by anchor and not broadcast, since all documents are reference here and grow without bound. A shard of more than
``shard_words`` words is not built: its windows are grouped one by one instead, with partial sums before the shuffle, so that no
task gets a group that grows with the corpus. Both ways give the same windows.

Defined cases: null and empty texts have no words and keep none; a null doc_id is neither earlier nor later than any other, so its
row keeps all words; a doc_id that is no integer is a TypeError; rows that repeat a doc_id are the same document, and remove nothing from each other; very long texts are
cut into pieces a stretch at a time, and words of any length are hashed a block at a time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import discard
from .automaton import SuffixAutomaton
from .common import many_rows, materialise, per_row, row_id, slices
from .hashing import Powers, mixed, sums, word_hashes

@dataclass(frozen=True)
class Settings:
    window: int = 50
    anchor: int = 16
    #: windows of one piece at most
    piece: int = 256
    #: a shard of near copies this large takes 15 MB and half a second, one of unrelated texts about four times as much
    shard_words: int = 100_000
    #: windows of one text that are cut into pieces at once
    stretch: int = 1 << 19


def ranges(total: np.ndarray, a: np.ndarray, n) -> np.ndarray:
    """Hashes of the n values from a on."""
    return mixed((total[a + n] - total[a]) * Powers.down[a])


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return x if width == n else np.minimum(x[: len(x) - (n - width)], x[n - width :])


def pieces(hashes: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first word, windows and content hash of the pieces of one text; together they hold every window once."""
    w, k = settings.window, settings.anchor
    n = len(hashes) - w + 1
    if n < 1:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    total = sums(hashes)
    grams = ranges(total, np.arange(len(hashes) - k + 1), k)
    anchors = sliding_min(grams, w - k + 1)
    starts = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    sizes = np.diff(np.append(starts, n))
    if sizes.max() > settings.piece:
        starts = np.concatenate([np.arange(a, a + m, settings.piece) for a, m in zip(starts, sizes, strict=True)])
        sizes = np.diff(np.append(starts, n))
    content = ranges(total, starts, sizes + (w - 1))
    return anchors[starts].view(np.int64), starts, sizes, content.view(np.int64)


def all_pieces(hashes: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """pieces, of a long text a stretch at a time."""
    w, step = settings.window, settings.stretch
    for at in range(0, len(hashes) - w + 1, step):
        anchor, start, size, content = pieces(hashes[at : at + step + w - 1], settings)
        yield anchor, start + at, size, content


def cut_by_shard(rows: list[tuple[int, int, list[int]]], window: int) -> Iterator[tuple[int, list[int]]]:
    """rows: (content, doc, words) of one anchor. (content, ends of windows that an earlier document holds)."""
    automaton = SuffixAutomaton()
    paths = [automaton.add(words) for _, _, words in rows]
    first: list[int | None] = [None] * len(automaton.link)
    for (_, doc, _), states in zip(rows, paths, strict=True):
        for s in states:
            if first[s] is None or doc < first[s]:
                first[s] = doc
    order, link, length = automaton.shortest_first(), automaton.link, automaton.length
    for s in reversed(order):
        p = link[s]
        if p > 0 and (first[p] is None or first[s] < first[p]):
            first[p] = first[s]
    # the state on the way to the root whose strings include those of window words
    holder = [-1] * len(link)
    for s in order:
        holder[s] = -1 if length[s] < window else s if length[link[s]] < window else holder[link[s]]
    for content, doc, words in rows:
        s, n, cut = 0, 0, []
        for i, c in enumerate(words):  # the piece is in the automaton, so the longest match is all of it so far
            s, n = automaton.next[s][c], n + 1
            if n >= window and first[holder[s]] < doc:
                cut.append(i)
        if cut:
            yield content, cut


def spans_of(ends: list[int], window: int) -> tuple[list[int], list[int]]:
    """Word ranges [a, b) that windows with the given last words cover, merged."""
    a, b = [], []
    for e in ends:
        if b and e - window + 1 <= b[-1]:
            b[-1] = e + 1
        else:
            a.append(e - window + 1)
            b.append(e + 1)
    return a, b


def repeats(docs: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """(rid, a, b): word ranges of the rows of docs(rid, key, text) that an earlier document holds."""
    w = settings.window

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rid", "doc", "anchor", "start", "size", "content"]
        for rids, ids, texts in slices(batches):
            held = []
            for rid, doc, raw in zip(rids, ids, texts, strict=True):
                if doc is not None and raw:
                    for anchor, start, size, content in all_pieces(word_hashes(raw), settings):
                        held.append((np.full(len(start), rid), np.full(len(start), doc), anchor, start, size, content))
            if held:
                columns = [np.concatenate(c).astype(np.int64) for c in zip(*held, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    source = docs.select("rid", F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    found = materialise(source.mapInArrow(find, "rid long, doc long, anchor long, start long, size long, content long"), "dedup-pieces")
    holder = F.min(F.struct("doc", "rid", "start")).alias("holder")
    kinds = found.groupBy("anchor", "content").agg(holder, F.max("doc").alias("last"), F.max("size").alias("size"))
    kinds = materialise(kinds.select("anchor", "content", "size", F.col("holder.doc").alias("first"), F.col("holder.rid").alias("rid"), F.col("holder.start").alias("start"), "last"), "dedup-kinds")
    several = kinds.groupBy(F.col("anchor").alias("__anchor")).agg(F.count("*").alias("kinds"), F.sum(F.col("size") + (w - 1)).alias("words"), F.min("first").alias("least"), F.max("first").alias("most")).where("kinds > 1 AND least < most")
    several = materialise(several.select("__anchor", (F.col("words") > settings.shard_words).alias("large")), "dedup-anchors")
    wanted = kinds.join(several, F.col("anchor") == F.col("__anchor")).groupBy("rid").agg(F.collect_list(F.struct("anchor", "content", "first", "start", "size", "large")).alias("wanted"))

    def fetch():
        def run(it: Iterator[tuple]) -> Iterator[tuple]:
            for raw, wanted in it:
                hashes = word_hashes(raw)
                for x in wanted:
                    yield x["anchor"], x["content"], x["first"], x["large"], hashes[x["start"] : x["start"] + x["size"] + w - 1].view(np.int64).tolist()

        return run

    fetched = many_rows(source.join(wanted, "rid").select("text", "wanted"), fetch, "anchor long, content long, doc long, large boolean, words array<long>", flush=5_000)
    fetched = materialise(fetched, "dedup-words")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for columns in slices(batches) for row in zip(*columns, strict=True))
        for _, group in groupby(rows, key=lambda r: r[0]):
            group = list(group)  # at most shard_words words
            out = [(group[0][0], content, *spans_of(ends, w)) for content, ends in cut_by_shard([r[1:] for r in group], w)]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(cuts.fieldNames(), r, strict=True)) for r in out], pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    cuts = T.StructType.fromDDL("anchor long, content long, a array<int>, b array<int>")
    small = fetched.where("NOT large").select("anchor", "content", "doc", "words").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "anchor").sortWithinPartitions("anchor").mapInArrow(match, cuts)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches):
            for anchor, content, doc, words in zip(*columns, strict=True):
                x = sums(np.array(words, np.int64).view(np.uint64))
                n = len(words) - w + 1
                h = ranges(x, np.arange(n), w).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, v, np.int64)) for v in (anchor, content, doc)] + [pa.array(np.arange(n) + w - 1), pa.array(h)], names=["anchor", "content", "doc", "last", "h"])

    single = materialise(fetched.where("large").select("anchor", "content", "doc", "words").mapInArrow(windows, "anchor long, content long, doc long, last long, h long"), "dedup-windows")
    # equal windows share their anchor too, so two hashes tell them apart
    least = single.groupBy(F.col("anchor").alias("__anchor"), F.col("h").alias("__h")).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    least = materialise(least, "dedup-least")
    later = single.join(least, (F.col("anchor") == F.col("__anchor")) & (F.col("h") == F.col("__h"))).where("doc > least")
    large = later.groupBy("anchor", "content").agg(F.collect_list(F.col("last").cast("int")).alias("a"))
    large = large.select("anchor", "content", F.transform("a", lambda e: e - (w - 1)).alias("a"), F.transform("a", lambda e: e + 1).alias("b"))
    matched = materialise(small.unionByName(large), "dedup-cuts")
    discard(several, fetched, single, least)
    cut = matched.withColumnRenamed("anchor", "__anchor").withColumnRenamed("content", "__content")
    marks = kinds.join(cut, (F.col("anchor") == F.col("__anchor")) & (F.col("content") == F.col("__content")), "left").where("last > first OR a IS NOT NULL")
    marks = materialise(marks.select(F.col("anchor").alias("__anchor"), F.col("content").alias("__content"), "first", "a", "b"), "dedup-marks")
    discard(kinds, matched)
    marked = found.join(marks, (F.col("anchor") == F.col("__anchor")) & (F.col("content") == F.col("__content"))).where("doc > first OR a IS NOT NULL")
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("size") + (w - 1)).alias("b")))
    part = F.transform(F.arrays_zip("a", "b"), lambda x: F.struct((F.col("start") + x["a"]).alias("a"), (F.col("start") + x["b"]).alias("b")))
    return marked.select("rid", F.explode(F.when(F.col("doc") > F.col("first"), whole).otherwise(part)).alias("x")).select("rid", "x.a", "x.b")


def with_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs with rid and repeats, an array of the word ranges (a, b) that go (null: none)."""
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be an integer, not {docs.schema[key].dataType.simpleString()}")
    # written, so that every job reads the same row numbers, whatever executors there are then
    numbered = materialise(docs.withColumn("rid", row_id()), "dedup-docs")
    ranges_of = repeats(numbered, key, text, settings).groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("repeats"))
    return numbered.join(ranges_of, "rid", "left")


def kept_words(raw: bytes | None, gone: list[dict] | None) -> tuple[int, list[bytes]]:
    words = raw.split() if raw else []
    if not gone:
        return len(words), words
    out, last = [], 0
    for a, b in sorted((x["a"], x["b"]) for x in gone):
        if a > last:
            out += words[last:a]
        last = max(last, b)
    return len(words), out + words[last:]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256), one row for each row of docs."""

    def make():
        def f(doc, raw, gone):
            n, kept = kept_words(raw, gone)
            return doc, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

        return f

    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL("n_words long, n_removed long, kept_sha256 string")])
    return per_row(with_repeats(docs.select(key, text), key, text, settings).select(key, F.col(text).cast("binary").alias("__text"), "repeats"), make, schema)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, kept), the kept words joined by one space."""

    def make():
        return lambda doc, raw, gone: (doc, b" ".join(kept_words(raw, gone)[1]))

    schema = T.StructType([docs.schema[key], T.StructField("kept", T.BinaryType())])
    made = per_row(with_repeats(docs.select(key, text), key, text, settings).select(key, F.col(text).cast("binary").alias("__text"), "repeats"), make, schema)
    return made.withColumn("kept", F.col("kept").cast("string"))
