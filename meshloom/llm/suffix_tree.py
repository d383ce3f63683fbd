"""LM scoring by a probabilistic suffix tree over words.

Symbols are the tokens: words in lower case and the end of a text, which also stands before the first word. The tree's contexts hold
up to ``depth`` tokens. Candidates are contexts that training texts hold ``context_least`` times or more and continuations that follow
``least`` times or more, at every size of the corpus. A continuation is kept if it is ``ratio`` times as likely as after the context one token shorter, and a context if the
divergence of its distribution from that of the shorter one, over all its occurrences, is ``min_bits`` bits or more. Kept counts are
discounted, and what that leaves goes to the distribution of the next shorter context; at the root stands the base distribution, with
one share for all unknown words. So the chances of all continuations add up to 1, a token is scored by the longest state in the tree
that ends before it, and a text's score is its base score where no context applies.

The tree lives in tables keyed by hashes of runs of tokens, and grows with the corpus; no level is collected. Runs are first counted
in buckets, by the upper bits of their hashes, which travel as sorted lists in a byte or two each; only runs whose bucket reaches the
bar are then counted by themselves, and only they are tried for longer ones; pairs of common words whose bucket shows that they stand
together too seldom to be kept are left out, too. Buckets and filters have a fixed size at most, and where they are full more is
counted in vain, with the same results. For scoring, the ``head`` values of the largest weight are broadcast, and
all others are joined to the places where they apply; where the border lies changes no result.

Words and runs are told apart by 64-bit hashes.

Defined cases: a null text counts as empty; an empty text is its end alone; words of any length are whole tokens, and long texts go
a stretch at a time; repeated rows score alike, and count as often as they stand in the training rows; without training rows every
token is unknown; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import discard, release
from .common import materialise, once_a_worker, row_id, slices
from .hashing import Filter, Tally, mixed, streams

#: the end of a text, as a word that no text holds
END = np.uint64(0x9AE16A3B2F90404F)
TURN = 13


@dataclass(frozen=True)
class Settings:
    depth: int = 4
    context_least: int = 32
    least: int = 8
    ratio: float = 4.0
    discount: float = 0.75
    min_bits: float = 64.0
    #: values that are broadcast for scoring, at most; 16 bytes each
    head: int = 2_000_000
    #: most frequent words whose counts are broadcast for telling pairs that can't be kept
    common: int = 250_000
    #: distinct keys after which a task sends its counts on
    flush: int = 1_000_000
    #: keys that one row names at most
    named: int = 250_000


def turned(run: np.ndarray) -> np.ndarray:
    return (run << np.uint64(TURN)) | (run >> np.uint64(64 - TURN))


def signed(x: int) -> int:
    return int(x) - (1 << 64) if int(x) >> 63 else int(x)


def salt(kind: int) -> np.uint64:
    """Sets the keys of a kind apart: 0 words, 2 k contexts of k tokens, 2 k + 1 their continuations."""
    return mixed(np.array([kind + 1], np.uint64))[0]


class Runs:
    """Hashes of the runs that end at each token of a stream; the stretches of the stream come one after another.

    A run's hash is that of the run without its last token, turned, and its last token's by exclusive-or. A run of three tokens or
    more may begin or end with END, but not hold it within.
    """

    def __init__(self, depth: int):
        self.depth, self.last = depth, np.full(depth, END)

    def over(self, tokens: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """runs[m - 1] and whether they hold END only at an end, for m up to depth + 1, each with the depth tokens before in front."""
        t = np.concatenate([self.last, tokens])
        self.last = t[len(t) - self.depth :]
        ends = np.maximum.accumulate(np.where(t == END, np.arange(len(t)), -1))
        before = np.append(-1, ends[:-1])
        runs, good = [t], [np.ones(len(t), bool)]
        for m in range(2, self.depth + 2):
            run = np.zeros(len(t), np.uint64)
            run[1:] = turned(runs[-1][:-1]) ^ t[1:]
            runs.append(run)
            good.append(np.arange(len(t)) - (m - 1) >= np.maximum(before, 0))
        return runs, good


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes | None]:
    for (texts,) in slices(batches):
        yield from texts


def batch(arrays: tuple[np.ndarray, ...], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in arrays], names=names)


def count_words(docs: DataFrame, settings: Settings) -> DataFrame:
    """(run, n): the hashes of all tokens of docs(text) and how often they stand there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(settings.flush)
        for tokens, _ in streams(texts_of(batches), END):
            for x in tally.add(tokens):
                yield batch(x, ["run", "n"])
        for x in tally.rest():
            yield batch(x, ["run", "n"])

    return docs.mapInArrow(run, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))


#: bars that pairs of words are held against by their buckets
BARS = (8, 16, 32, 64, 128, 255)


class Table:
    """Sorted keys with values, found through a list of where each beginning of keys starts."""

    def __init__(self, keys: np.ndarray, value: np.ndarray):
        self.keys, self.value = np.append(keys, keys[-1:]), value
        bits = max(8, (2 * max(1, len(keys)) - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the table holds the keys, and their numbers there."""
        begin = (keys >> self.shift).astype(np.int64)
        number, end = self.starts[begin], self.starts[begin + 1]
        found = np.zeros(len(keys), bool)
        at = np.flatnonzero(number < end)
        while len(at):
            same = self.keys[number[at]] == keys[at]
            found[at[same]] = True
            at = at[~same]
            number[at] += 1
            at = at[number[at] < end[at]]
        return found, number

    @classmethod
    def sent(cls, rows: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
        """What a table of so many rows as the caller bounds is broadcast as."""
        found = rows.select(key, value).toArrow()
        keys = found[key].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        return keys[order], found[value].to_numpy()[order]


class Buckets:
    """Numbers of buckets, the upper bits of hashes, as sorted lists: deltas of two bytes, and a count up to 255 for each.

    There are some sixteen for each token and 2^32 at most, in 64 segments. A delta too large for two bytes is told in steps without a count.
    """

    STEP = (1 << 16) - 1

    def __init__(self, tokens: int):
        self.bits = min(32, max(16, (16 * tokens).bit_length()))
        self.width = 1 << (self.bits - 6)

    def of(self, runs: np.ndarray) -> np.ndarray:
        return runs >> np.uint64(64 - self.bits)

    def marks(self, runs: np.ndarray) -> np.ndarray:
        """Keys for filters."""
        return mixed(self.of(runs))

    def packed(self, buckets: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """(segment, deltas, counts) of sorted buckets."""
        cuts = np.searchsorted(buckets, np.arange(65, dtype=np.uint64) * np.uint64(self.width))
        for s in range(64):
            at = buckets[cuts[s] : cuts[s + 1]].astype(np.int64) - s * self.width
            if len(at):
                deltas = np.diff(at, prepend=0)
                steps = deltas // self.STEP
                places = np.arange(len(at)) + np.cumsum(steps)
                out, n = np.full(places[-1] + 1, self.STEP, np.uint16), np.zeros(places[-1] + 1, np.uint8)
                out[places] = deltas - steps * self.STEP
                n[places] = np.minimum(counts[cuts[s] : cuts[s + 1]], 255)
                yield s, out.tobytes(), n.tobytes()

    def added(self, total: np.ndarray, deltas: bytes, counts: bytes) -> None:
        """Add a packed list to a segment's counts."""
        at, n = np.cumsum(np.frombuffer(deltas, np.uint16), dtype=np.int64), np.frombuffer(counts, np.uint8)
        at, n = at[n > 0], n[n > 0]
        total[at] = np.minimum(total[at].astype(np.uint16) + n, 255)


def marked(runs: DataFrame, buckets: Buckets) -> DataFrame:
    """(mark, n) of runs(run, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(buckets.marks(b.column("run").to_numpy().view(np.uint64)).view(np.int64)), b.column("n")], names=["mark", "n"])

    return runs.select("run", "n").mapInArrow(run, "mark long, n long")


def may_be(found: list[np.ndarray], good: list[np.ndarray], k: int, buckets: Buckets, contexts: Filter, continued: Filter) -> np.ndarray:
    """Places where a run of k tokens that may be a context is followed by a token that may continue it; the stream's first k tokens stand before."""
    at = np.flatnonzero(good[k][len(good) - 1 :]) + len(good) - 1
    marks = buckets.marks(found[k - 1])
    at = at[contexts.has(marks[at - 1])]
    return at[continued.has(marks[at])]


def crowded(docs: DataFrame, k: int, buckets: Buckets, sent, settings: Settings) -> DataFrame:
    """(mark, n) of the buckets that ``least`` runs of k tokens and one more fall in; sent: filters of contexts and of continuations of k tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (contexts, continued), tally, runs = (Filter(x) for x in sent.value), Tally(2 * settings.flush), Runs(k)

        def out(x: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            rows = list(buckets.packed(*x))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["segment", "deltas", "counts"])

        for tokens, _ in streams(texts_of(batches), END):
            found, good = runs.over(tokens)
            for x in tally.add(buckets.of(found[k][may_be(found, good, k, buckets, contexts, continued)])):
                yield out(x)
        for x in tally.rest():
            yield out(x)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A segment after the other, one byte a bucket."""
        rows = (row for columns in slices(batches) for row in zip(*columns, strict=True))
        for segment, group in groupby(rows, key=lambda r: r[0]):
            total = np.zeros(buckets.width, np.uint8)
            for _, deltas, counts in group:
                buckets.added(total, deltas, counts)
            at = np.flatnonzero(total >= settings.least)
            for i in range(0, len(at), 1 << 18):
                some = at[i : i + (1 << 18)]
                yield batch((mixed((some + segment * buckets.width).astype(np.uint64)), total[some].astype(np.int64)), ["mark", "n"])

    n = min(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return docs.mapInArrow(run, "segment int, deltas binary, counts binary").repartition(n, "segment").sortWithinPartitions("segment").mapInArrow(sums, "mark long, n long")


def seldom(words: Table, floor: float, bars: dict[int, Filter], marks: np.ndarray, context: np.ndarray, last: np.ndarray, settings: Settings) -> np.ndarray:
    """Whether pairs of words are neither a context nor kept after the first word, as the counts of both words and of the pair's bucket tell."""
    (a, i), (b, j) = words.places(context), words.places(last)
    at = np.flatnonzero(a & b)
    bar = settings.ratio * words.value[i[at]] * ((words.value[j[at]] + 0.5) / floor)
    out = np.zeros(len(marks), bool)
    for low, high in zip(BARS, (*BARS[1:], np.inf), strict=True):
        some = at[(bar >= low) & (bar < high)]
        out[some] = ~bars[low].has(marks[some])
    some = np.flatnonzero(out)
    as_context = [x for x in BARS if x <= settings.context_least]
    out[some] = ~bars[as_context[-1]].has(marks[some]) if as_context else False
    return out


def planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first, so that zeros lie together."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def numbers(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def packed_counts(segments: int, keys: np.ndarray, counts: np.ndarray, *more: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(segment, keys, counts, further numbers) of sorted keys: their deltas, and all else as it is."""
    of = mixed(keys) >> np.uint64(64 - (segments.bit_length() - 1))
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(of[order]) > 0)) if len(order) else []
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        at = order[a:b]
        yield int(of[at[0]]), planes(np.diff(keys[at], prepend=np.uint64(0))), planes(counts[at]), b"".join(x[at].tobytes() for x in more)


def count_runs(docs: DataFrame, filters: list, common, floor: float, tokens: int, buckets: Buckets, settings: Settings) -> DataFrame:
    """(k, run, context, shorter, middle, n) of runs of k tokens and one more that stand often enough; pairs that can be neither a context nor kept may be left out.

    context: the run's first k tokens; shorter: its last k; middle: for k of 2 the word in the middle, else 0. filters[k - 1]: contexts
    and continuations of k tokens, and runs of k + 1; for pairs by bar. common: counts of frequent words. Two or three frequent words
    are counted by their numbers, all other runs by their hashes; each task's counts travel as sorted lists, a row for each segment.
    """
    depth, least = len(filters), settings.least
    segments = 1 << max(6, tokens.bit_length() - 23)
    bits = max(1, (len(common.value[0]) - 1).bit_length())
    if bits > 21:
        raise ValueError("three numbers of common words must fit 63 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [[Filter(x) for x in f.value] for f in filters], Table(*common.value)
        bars = dict(zip(BARS, held[0][3:], strict=True))
        runs, tallies = Runs(depth), {(k, named): Tally(settings.flush // 2) for k in range(1, depth + 1) for named in (True, False)}

        def out(k: int, named: bool, x: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            rows = [(i, k, named, *more) for i, *more in packed_counts(segments, *x)]
            kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["segment", "k", "named", "keys", "counts", "more"])

        for some, _ in streams(texts_of(batches), END):
            found, good = runs.over(some)
            for k, (contexts, continued, often, *_) in enumerate(held, 1):
                at = may_be(found, good, k, buckets, contexts, continued)
                marks = buckets.marks(found[k][at])
                passed = often.has(marks)
                at, marks = at[passed], marks[passed]
                if k == 1:
                    at = at[~seldom(words, floor, bars, marks, found[0][at - 1], found[0][at], settings)]
                named, number = np.full(len(at), k <= 2), np.zeros(len(at), np.uint64)
                for j in range(k, -1, -1) if k <= 2 else ():
                    there, i = words.places(found[0][at - j])
                    named &= there
                    number = (number << np.uint64(bits)) | i.astype(np.uint64)
                for x in tallies[k, True].add(number[named]):
                    yield out(k, True, x)
                at = at[~named]
                middle = found[0][at - 1] if k == 2 else np.zeros(len(at), np.uint64)
                for x in tallies[k, False].add(found[k][at], found[k - 1][at - 1], found[k - 1][at], middle):
                    yield out(k, False, x)
        for (k, named), tally in tallies.items():
            for x in tally.rest():
                yield out(k, named, x)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, mask = common.value[0], np.uint64((1 << bits) - 1)

        def part(keys: bytes, counts: bytes, more: bytes) -> tuple[np.ndarray, ...]:
            return np.cumsum(numbers(keys, np.uint64)), numbers(counts, np.int64), *(np.frombuffer(more, np.uint64).reshape(3, -1) if more else ())

        rows = (row for columns in slices(batches) for row in zip(*columns, strict=True))
        for (_, k, named), group in groupby(rows, key=lambda r: r[:3]):
            key, n, *more = Tally.merged([part(*r[3:]) for r in group])
            at = np.flatnonzero(n >= least)
            key, n, more = key[at], n[at], [x[at] for x in more]
            if named:
                first, middle, last = (hashes[(key >> np.uint64(j * bits)) & mask] for j in (2, 1, 0))
                context, shorter, middle = (middle, last, np.zeros(len(key), np.uint64)) if k == 1 else (turned(first) ^ middle, turned(middle) ^ last, middle)
                key = turned(context) ^ last
            else:
                context, shorter, middle = more
            if len(n):
                yield batch((np.full(len(n), k, np.int64), key, context, shorter, middle, n), ["k", "run", "context", "shorter", "middle", "n"])

    made = docs.mapInArrow(run, "segment int, k int, named boolean, keys binary, counts binary, more binary")
    dealt = made.repartition(min(segments, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "segment").sortWithinPartitions("segment", "k", "named")
    return dealt.mapInArrow(add_up, "k long, run long, context long, shorter long, middle long, n long")


def level(counted: DataFrame, before: DataFrame, k: int, settings: Settings, scrap: list[DataFrame], words: DataFrame | None = None, contexts: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The runs (run, n, p) of k + 1 tokens with the tree's chance of their last token, the values (key, weight, gain) of the contexts of k tokens, and these (context, left).

    before: (run, n, p) of the runs of k tokens. counted: count_runs. A place's gain is the sum of the values whose key applies there:
    each retained context gives log10 of what it leaves, and a kept continuation the rest of its advantage over the shorter context.
    For k of 2, words and contexts are those of the level before: the chance of a pair that was left out there follows from them.
    """
    total = before.where(F.col("n") >= settings.context_least).select(F.col("run").alias("context"), F.col("n").alias("total"))
    below = before.select(F.col("run").alias("shorter"), F.col("p").alias("below"))
    known = counted.join(total, "context")
    if words is None:
        known = known.join(below, "shorter")
    else:
        # the last word's hash is what the run's differs from the context's by
        turned = F.shiftleft("context", TURN).bitwiseOR(F.shiftrightunsigned("context", 64 - TURN))
        last = words.select(F.col("run").alias("__last"), F.col("p").alias("root"))
        lefts = contexts.select(F.col("context").alias("__middle"), F.col("left").alias("passed"))
        known = known.join(below, "shorter", "left").join(last, turned.bitwiseXOR(F.col("run")) == F.col("__last")).join(lefts, F.col("middle") == F.col("__middle"), "left")
        known = known.withColumn("below", F.coalesce("below", F.col("root") * F.coalesce("passed", F.lit(1.0)))).drop("__last", "root", "__middle", "passed")
    known = known.withColumn("kept", F.col("n") >= settings.ratio * F.col("total") * F.col("below"))
    known = materialise(known.withColumn("own", F.when(F.col("kept"), (F.col("n") - settings.discount) / F.col("total")).otherwise(0.0)), f"tree-known-{k}")
    left = known.where("kept").groupBy("context").agg(F.greatest(1.0 - F.sum("own"), F.lit(1e-12)).alias("left"), F.sum("n").alias("held"), F.max("total").alias("whole"))
    left = materialise(left, f"tree-left-{k}")
    gained = known.where("kept").join(left, "context").groupBy("context").agg(F.sum(F.col("n") * F.log2((F.col("own") + F.col("left") * F.col("below")) / F.col("below"))).alias("gained"))
    bits = F.col("gained") + (F.col("whole") - F.col("held")) * F.log2("left")
    retained = materialise(left.join(gained, "context").where(bits >= settings.min_bits).select("context", "left", "whole"), f"tree-contexts-{k}")
    chance = F.when(F.col("left").isNull(), F.col("below")).otherwise(F.col("own") + F.col("left") * F.col("below"))
    runs = materialise(known.join(retained.drop("whole"), "context", "left").select("run", "n", chance.alias("p"), "below", "left", "kept"), f"tree-runs-{k}")
    tell = lambda c, kind: F.col(c).bitwiseXOR(F.lit(signed(salt(kind)))).alias("key")
    contexts = retained.select(tell("context", 2 * k), F.col("whole").alias("weight"), F.log10("left").alias("gain"))
    kept = runs.where("kept AND left IS NOT NULL").select(tell("run", 2 * k + 1), F.col("n").alias("weight"), F.log10(F.col("p") / F.col("below") / F.col("left")).alias("gain"))
    scrap += [known, left, retained, runs]
    return runs.select("run", "n", "p"), contexts.unionByName(kept), retained.select("context", "left")


def grow(docs: DataFrame, words: DataFrame, tokens: int, floor: float, settings: Settings = Settings()) -> tuple[DataFrame | None, list[DataFrame]]:
    """The tree over docs(text) as values (key, weight, gain), and written tables that only these are read from. words: (run, n) of all tokens."""
    context, buckets, filters, scrap = docs.sparkSession.sparkContext, Buckets(tokens), [], []
    before = words.where(F.col("n") >= settings.least).select("run", "n")
    found = materialise(marked(before, buckets), "tree-buckets-0")
    contexts, continued = Filter.from_table(found.where(F.col("n") >= settings.context_least), "mark"), Filter.from_table(found, "mark")
    for k in range(1, settings.depth + 1):
        found = materialise(crowded(docs, k, buckets, context.broadcast((contexts.bits, continued.bits)), settings), f"tree-buckets-{k}")
        often = Filter.from_table(found, "mark")
        scrap.append(found)
        if not often.bits.any():
            break
        bars = [Filter.from_table(found.where(F.col("n") >= x), "mark").bits for x in BARS] if k == 1 else []
        filters.append(context.broadcast((contexts.bits, continued.bits, often.bits, *bars)))
        contexts, continued = Filter.from_table(found.where(F.col("n") >= settings.context_least), "mark"), often
        release(docs.sparkSession)
    if not filters:
        return None, scrap
    common = context.broadcast(Table.sent(split(before.withColumn("weight", F.col("n")), settings.common)[0], "run", "n"))
    counted = materialise(count_runs(docs, filters, common, floor, tokens, buckets, settings), "tree-counts")
    scrap.append(counted)
    release(docs.sparkSession)
    words = before = before.withColumn("p", (F.col("n") + 0.5) / F.lit(floor))
    values = retained = None
    for k in range(1, len(filters) + 1):
        before, made, retained = level(counted.where(F.col("k") == k), before, k, settings, scrap, *((words, retained) if k == 2 else ()))
        values = made if values is None else values.unionByName(made)
        release(docs.sparkSession)
    return values, scrap


def split(values: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """values with the largest weights, at most ``most``, and the others; the border lies between powers of the eighth root of two."""
    size = F.floor(F.log2(F.col("weight").cast("double")) * 8)
    border, n = 0, 0
    for r in values.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("size")).collect():  # at most 8 * 64 rows
        n += r.n
        if n > most:
            border = r["size"] + 1
            break
    return values.where(size >= border), values.where(size < border)


class Values(Table):
    """The head's keys and values, and a filter of the other keys."""

    def __init__(self, keys: np.ndarray, value: np.ndarray, others: np.ndarray):
        super().__init__(keys, value)
        self.others = Filter(others)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of keys that the head holds, their numbers there, and places whose keys may be among the others."""
        found, number = self.places(keys)
        held, rest = np.flatnonzero(found), np.flatnonzero(~found)
        return held, number[held], rest[self.others.has(keys[rest])]


def places(values: Values, runs: list[np.ndarray], good: list[np.ndarray], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, number in the head, other place, other key) of everything that applies to the tokens after the first ``depth``; the words come first."""
    n = len(runs[0])
    keys = runs[0][depth:] ^ salt(0)
    a, i, b = values.find(keys)
    yield a, i, b, keys[b]
    for k in range(1, depth + 1):
        at = np.flatnonzero(good[k][depth:])
        context = runs[k - 1][depth - 1 : n - 1][at] ^ salt(2 * k)
        a, i, b = values.find(context)
        yield at[a], i, at[b], context[b]
        # a continuation has a value only where its context has one
        at = at[np.sort(np.concatenate([a, b]))]
        run = runs[k][depth:][at] ^ salt(2 * k + 1)
        a, i, b = values.find(run)
        yield at[a], i, at[b], run[b]


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each row of docs."""
    source = docs.select(F.col(key), held_out.alias("held_out"), F.col(text).cast("binary").alias("__text"))
    training = source.where("NOT held_out").select("__text")
    words = materialise(count_words(training, settings), "tree-words")
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    floor = tokens + 0.5 * (kinds + 1)
    unknown = log10(0.5 / floor)
    base = words.select(F.col("run").bitwiseXOR(F.lit(signed(salt(0)))).alias("key"), F.col("n").alias("weight"), (F.log10((F.col("n") + 0.5) / F.lit(floor)) - F.lit(unknown)).alias("base"), F.lit(0.0).alias("gain"), F.lit(1).alias("known"))
    tree, scrap = grow(training, words, int(tokens), floor, settings)
    if tree is not None:
        base = base.unionByName(tree.select("key", "weight", F.lit(0.0).alias("base"), "gain", F.lit(0).alias("known")))
    values = materialise(base, "tree-values")
    discard(words, *scrap)
    head, others = split(values, settings.head)
    # at most settings.head rows
    sent = docs.sparkSession.sparkContext.broadcast((*Table.sent(head.withColumn("value", F.col("base") + F.col("gain")), "key", "value"), Filter.from_table(others, "key").bits))
    schema = T.StructType([T.StructField("__rid", T.LongType()), docs.schema[key], *T.StructType.fromDDL("held_out boolean, whole boolean, n_tokens long, n_known long, base double, gain double, others array<long>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, depth = once_a_worker("suffix_tree", sent.value, lambda v: Values(*v)), settings.depth
        names = [f.name for f in schema]
        for b in batches:
            step = max(1, min(b.num_rows, b.num_rows * (2 << 20) // max(1, b.nbytes)))
            for first in range(0, b.num_rows, step):
                part = b.slice(first, step)
                n, runs = part.num_rows, Runs(depth)
                sums = {c: np.zeros(n) for c in ("base", "gain", "known", "tokens")}
                named: list[tuple[np.ndarray, np.ndarray]] = []
                n_named = 0

                def rows(whole: bool, part=part, named=named, sums=sums, n=n):
                    """The texts' sums so far are given once, with the last keys."""
                    of, keys = (np.concatenate(c) for c in zip(*named, strict=True)) if named else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                    order = np.argsort(of, kind="stable")
                    ends = np.append(0, np.cumsum(np.bincount(of, minlength=n)))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[order].view(np.int64)))
                    ints = [pa.array(sums[c].astype(np.int64)) for c in ("tokens", "known")]
                    return pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.full(n, whole)), *ints, pa.array(sums["base"]), pa.array(sums["gain"]), lists], names=names)

                for tokens, of in streams((x.as_py() for x in part.column(3)), END):
                    found, good = runs.over(tokens)
                    sums["tokens"] += np.bincount(of, minlength=n)
                    for m, (at, i, other, keys) in enumerate(places(values, found, good, depth)):
                        sums["gain" if m else "base"] += np.bincount(of[at], weights=values.value[i], minlength=n)
                        if not m:
                            sums["known"] += np.bincount(of[at], minlength=n)
                        named.append((of[other], keys))
                        n_named += len(keys)
                    if n_named > settings.named:
                        yield rows(False)
                        named.clear()
                        n_named = 0
                yield rows(True)

    scored = materialise(source.select(row_id().alias("__rid"), key, "held_out", "__text").mapInArrow(run, schema), "tree-scored")
    named = scored.select("__rid", F.explode("others").alias("k"))
    more = named.join(others.withColumnRenamed("key", "k"), "k").groupBy("__rid").agg(*[F.sum(c).alias(f"more_{c}") for c in ("base", "gain", "known")])
    out = scored.where("whole").drop("others").withColumnRenamed("__rid", "__row").join(more, F.col("__row") == F.col("__rid"), "left")
    both = {c: F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0.0)) for c in ("base", "gain")}
    out = out.withColumn("base_score", F.col("n_tokens") * F.lit(unknown) + both["base"])
    known = (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known")
    return out.select(key, "held_out", "n_tokens", known, F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", (F.col("base_score") + both["gain"]).alias("score"))
