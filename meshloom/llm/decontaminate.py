"""Benchmark decontamination: a generalised suffix automaton of the normalised items, streamed over documents.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. The automaton holds every item; a document's
words move through it and the longest match ending at each word is tracked. A match of ``window`` words or more covers
those words; an item shorter than the window counts where it stands whole.

The items are broadcast in shards of at most ``shard_words`` words, each a job of its own over the documents, so what is
broadcast is bounded by that parameter however large the benchmark is; usually there is one shard. The driver holds one shard at a
time (two at the start), and a worker builds the automaton of a shard once for all its tasks.

Defined cases: null texts have no words and are never hit; items without words match nothing; repeated item_ids count once;
a null item_id is named as the empty string; repeated documents are judged alike; empty tables give no hits or no rows;
other columns are ignored by ``hits`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import SuffixAutomaton
from .common import ALNUM, many_rows, materialise, once_a_worker, per_row, row_id, spare, text_udf


@dataclass(frozen=True)
class Settings:
    window: int = 13
    #: contaminated if 100 * hit words >= percent * words
    percent: int = 5
    #: an automaton of so many words takes some 250 MB while it is built
    shard_words: int = 200_000


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM).split() if text else []


class Automaton(SuffixAutomaton):
    """Of all items' word ids; each state knows the items that hold its strings."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        super().__init__()
        self.window = window
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        held: list[tuple[int, list[int]]] = []
        #: state of a whole short item: its words and number
        self.short: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(items):
            states = self.add([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            held.append((k, states))
            if 0 < len(words) < window:
                self.short.setdefault(states[-1], []).append((len(words), k))
        holders: list[set[int]] = [set() for _ in self.link]
        for k, states in held:
            for s in states:
                holders[s].add(k)
        order = self.shortest_first()
        for s in reversed(order):
            holders[self.link[s]] |= holders[s]
        self.holders = [tuple(x) for x in holders]
        #: nearest state on the way to the root, itself included, that ends a whole short item
        self.ends = [-1] * len(self.link)
        #: the state on the way to the root whose strings include those of window words
        self.holder = [-1] * len(self.link)
        for s in order:
            if self.length[s] >= window:
                self.holder[s] = s if self.length[self.link[s]] < window else self.holder[self.link[s]]
            self.ends[s] = s if s in self.short else self.ends[self.link[s]]

    def stream(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the items with occurring windows."""
        nxt, link, length, window, known = self.next, self.link, self.length, self.window, self.vocabulary.get
        hit, items, s, n = np.zeros(len(words), bool), set(), 0, 0
        any_short = bool(self.short)
        for i, w in enumerate(words):
            c = known(w)
            if c is None:
                s = n = 0
                continue
            to = nxt[s].get(c)
            if to is None:
                while s > 0 and to is None:
                    s = link[s]
                    to = nxt[s].get(c)
                if to is None:
                    s = n = 0
                    continue
                n = length[s]
            s = to
            n += 1
            if n >= window:
                hit[i - window + 1 : i + 1] = True
                items.update(self.holders[self.holder[s]])
            if any_short and (e := self.ends[s]) > 0:
                while e > 0:
                    for m, k in self.short[e]:
                        if m <= n:
                            hit[i - m + 1 : i + 1] = True
                            items.add(k)
                    e = self.ends[link[e]] if link[e] > 0 else -1
        return hit, items


def built(sent, settings: Settings) -> Automaton:
    return once_a_worker("decontaminate", sent.value, lambda items: Automaton(items, settings.window))


def shards(benchmark: DataFrame, settings: Settings, item: str = "item_id", text: str = "text") -> Iterator[list[tuple[str, list[bytes]]]]:
    """The distinct items, in shards of at most shard_words words (or one item)."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).cast("binary").alias("text")).where("text IS NOT NULL").distinct().orderBy("item", "text")
    held, n = [], 0
    for r in rows.toLocalIterator():
        words = words_of(bytes(r.text))
        if not words:
            continue
        if held and n + len(words) > settings.shard_words:
            yield held
            held, n = [], 0
        held.append((r.item, words))
        n += len(words)
    if held:
        yield held


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_run long"


def verdict(n_words: int, hit: np.ndarray, items: set[str], settings: Settings) -> tuple:
    n_hit = int(hit.sum())
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    run = int((edges[1::2] - edges[::2]).max()) if len(edges) else 0
    return n_words, n_hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), n_hit > 0 and 100 * n_hit >= settings.percent * n_words, run


def hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The columns of ``keep`` with what the benchmark hits, one row for each row of docs."""
    session, schema = docs.sparkSession, T.StructType([*(docs.schema[c] for c in keep), *T.StructType.fromDDL(RESULT)])
    n = len(keep)
    parts = iter(shards(benchmark, settings))
    first, second = next(parts, []), next(parts, None)

    def one(sent):
        def make():
            automaton = built(sent, settings)

            def f(*row):
                words = words_of(row[n])
                hit, items = automaton.stream(words)
                return (*row[:n], *verdict(len(words), hit, {automaton.names[k] for k in items}, settings))

            return f

        return make

    source = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    if second is None:
        return per_row(source, one(session.sparkContext.broadcast(first)), schema)

    def partial(sent):
        def make():
            automaton = built(sent, settings)

            def run(it: Iterator[tuple]) -> Iterator[tuple]:
                for rid, raw in it:
                    hit, items = automaton.stream(words_of(raw))
                    if items:
                        yield rid, np.packbits(hit).tobytes(), [automaton.names[k] for k in items]

            return run

        return make

    numbered = materialise(source.withColumn("__rid", row_id()), "decontaminate-docs")
    found = None
    for shard in chain([first, second], parts):
        sent = session.sparkContext.broadcast(shard)
        # rows without a hit are not written
        out = many_rows(numbered.select("__rid", "__text"), partial(sent), "rid long, bits binary, items array<string>")
        out = materialise(out, "decontaminate-shard")
        sent.unpersist()
        found = out if found is None else found.unionByName(out)
    merged = found.groupBy("rid").agg(F.collect_list("bits").alias("bits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def finish():
        def f(*row):
            words, bits, items = words_of(row[n]), row[n + 1], row[n + 2]
            hit = np.zeros(len(words), bool)
            for b in bits or []:
                hit |= np.unpackbits(np.frombuffer(b, np.uint8), count=len(words)).astype(bool)
            return (*row[:n], *verdict(len(words), hit, set(items or []), settings))

        return f

    return per_row(numbered.join(merged, F.col("__rid") == F.col("rid"), "left").select(*keep, "__text", "bits", "items"), finish, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs without the contaminated ones."""
    parts = shards(benchmark, settings)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        sent = docs.sparkSession.sparkContext.broadcast(first)

        def make():
            automaton = built(sent, settings)

            def f(x: bytes | None) -> bool:
                words = words_of(x)
                return not verdict(len(words), automaton.stream(words)[0], set(), settings)[4]

            return f

        return docs.where(text_udf(make, T.BooleanType())(F.col(text).cast("binary")))
    key = spare(docs, "rid")
    numbered = materialise(docs.withColumn(key, row_id()), "decontaminate-docs")
    clean = hits(numbered, benchmark, [key], text, settings).where("NOT contaminated").select(key)
    return numbered.join(clean, key, "left_semi").drop(key)
