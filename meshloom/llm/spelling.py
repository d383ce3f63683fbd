"""Spelling variant grouping: words that differ by one inserted, deleted or replaced character, and the frequent form that each stems from.

Two words that differ by one edit share all that lies before and after it. So each word stands in sorted lists of those that share its
first half, and of those that share its second half; a pair meets in the one whose window, the half that may differ, holds the end of
what both words begin with. A list of more than ``crowd`` words is dealt anew, by halving its window, until its words differ in one place
only and are bounded by the alphabet; so no list is long, and no pair is lost. Within a list each word scans the others in their order with
the three entries of the edit matrix's row that lie about its diagonal: rows of what adjacent words share at their beginning are kept, and
all words that share a beginning which is already more than one edit away are skipped.

What is counted is added up by Spark, in each task first. From a word to its form occurrences grow tenfold at least, so that roots are
found by a few rounds of doubled steps, told by the largest count.

Defined cases: a null text has no words and a null doc_id counts as the empty text; texts may have any length; ties of counts go to the
smaller form in code-point order; repeated rows count as often as they stand; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from os.path import commonprefix

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import discard
from .common import many_rows, materialise

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: pairs of words of the lists that are scanned at once; words that are scanned in lists of their own
PAIRS, LONG = 1 << 20, 64


@dataclass(frozen=True)
class Settings:
    #: code points of a word, and its occurrences, at least
    length: int = 7
    count: int = 2
    #: of so many runs in a document, one loses a character
    slip: int = 31
    #: how many times as frequent a form is as its variant
    ratio: int = 10
    #: words of a list that is scanned, at most, unless they differ in one place only
    crowd: int = 512


def slipped(run: Column, doc_id: Column, every: int) -> Column:
    """The run, less one character where the hash of document and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(word, n): words that are long and frequent enough, with their occurrences."""
    runs = docs.select(F.col(doc_id).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"{RUN}{{{settings.length},}}"), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")))
    words = runs.select(slipped(F.col("run"), F.col("id"), settings.slip).alias("word")).where(F.char_length("word") >= settings.length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= settings.count)


def listed(words: DataFrame, least: int) -> DataFrame:
    """(word, n, m, a, b) once for each list: m is the length of the shorter words, [a, b) the window of them that may differ."""
    size = F.char_length("word")
    each = words.withColumn("m", F.explode(F.array(size, size - 1))).where(F.col("m") >= least)
    half = F.floor(F.col("m") / 2).cast("int")
    window = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    return each.withColumn("w", F.explode(F.array(window(F.lit(0), half), window(half, F.col("m"))))).select("word", "n", "m", "w.a", "w.b")


def keyed(lists: DataFrame) -> DataFrame:
    """lists with what the words of a list share, and mid, what may differ."""
    size = F.char_length("word")
    rest = F.col("m") - F.col("b")
    key = F.concat_ws(":", "m", "a", "b", F.substring("word", F.lit(1), F.col("a")), F.substring("word", size - rest + 1, rest))
    return lists.withColumn("key", key).withColumn("mid", F.substring("word", F.col("a") + 1, size - rest - F.col("a")))


def halved(lists: DataFrame) -> DataFrame:
    """Lists of both halves of the window."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    window = lambda a, b: F.struct(F.col(a).alias("a") if isinstance(a, str) else a.alias("a"), F.col(b).alias("b") if isinstance(b, str) else b.alias("b"))
    return lists.withColumn("w", F.explode(F.array(window("a", middle), window(middle, "b")))).select("word", "n", "m", "w.a", "w.b")


def scan(mids: list[str], group: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): mids one edit apart, i one that asks, both of one list. mids are sorted within each list, whose numbers group holds.

    A range of a list is what shares its first characters with the mid before it. Each mid that asks has the three entries of its matrix
    about the diagonal for each range that they let live; the ranges that a range splits into at the next depth take them from there.
    """
    text = np.array(mids)
    x = text.view(np.uint32).reshape(len(mids), -1)
    size = np.char.str_len(text)
    first = np.append(True, group[1:] != group[:-1])
    shared = np.append(0, (x[1:] != x[:-1]).argmax(1))
    shared[first] = 0
    # no character is 0 or 1: beyond its end a mid that asks equals nothing
    own = np.where(np.arange(x.shape[1])[None, :] < size[:, None], x, 1)
    own = np.pad(own, ((0, 0), (1, 2)), constant_values=1)
    at = np.flatnonzero(first)
    bounds = np.append(at, len(mids))
    of = np.searchsorted(at, np.arange(len(mids)), "right") - 1
    word = np.flatnonzero(asks)
    start, end = bounds[of[word]], bounds[of[word] + 1]
    low, on, high = (np.full(len(word), v, np.int8) for v in (2, 0, 1))
    left, right = [], []
    for depth in range(x.shape[1] + 1):
        # a mid that ends here is the first of its range
        ends = size[start] == depth
        off = size[word] - depth
        hit = ends & (((off == -1) & (low == 1)) | ((off == 0) & (on == 1)) | ((off == 1) & (high == 1)))
        left.append(word[hit])
        right.append(start[hit])
        if depth == x.shape[1]:
            break
        heads = np.flatnonzero((size > depth) & (first | (shared <= depth)))
        a, b = np.searchsorted(heads, start + ends), np.searchsorted(heads, end)
        n = b - a
        parent = np.repeat(np.arange(len(word)), n)
        number = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n) + a[parent]
        word, low, on, high, last = word[parent], low[parent], on[parent], high[parent], end[parent]
        start = heads[number]
        end = np.where(number + 1 < b[parent], heads[np.minimum(number + 1, len(heads) - 1)], last)
        c = x[start, depth]
        low = np.minimum(low + (own[word, depth] != c), on + 1)
        on = np.minimum(np.minimum(on + (own[word, depth + 1] != c), high + 1), low + 1)
        high = np.minimum(high + (own[word, depth + 2] != c), on + 1)
        lives = np.minimum(np.minimum(low, on), high) <= 1
        word, start, end, low, on, high = (v[lives] for v in (word, start, end, np.minimum(low, 2), np.minimum(on, 2), np.minimum(high, 2)))
    return np.concatenate(left), np.concatenate(right)


def near_in_lists(lists: list[list[tuple]]) -> Iterator[tuple]:
    """(word, n_near, n, form) of the words of lists, each in the order of mid, that have near words there: how many, and the most frequent."""
    rows = [r for some in lists for r in some]
    asks = np.array([len(r[2]) == r[4] for r in rows])
    group = np.repeat(np.arange(len(lists)), [len(some) for some in lists])
    out: dict[int, tuple[int, int, str]] = {}

    def add(i: int, j: int) -> None:
        count, n, form = out.get(i, (0, 0, ""))
        other, times = rows[j][2], rows[j][3]
        out[i] = (count + 1, *((times, other) if times > n or (times == n and other < form) else (n, form)))

    for i, j in zip(*(v.tolist() for v in scan([r[1] for r in rows], group, asks)), strict=True):
        _, mid, word, _, m, a, b = rows[i]
        # the pair belongs to the window in which the words' common beginning ends
        at = a + len(commonprefix((mid, rows[j][1])))
        if at < b or at == b == m:
            add(i, j)
            if len(rows[j][2]) > m:
                add(j, i)
    for i, found in out.items():
        yield (rows[i][2], *found)


def near_in_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    """near_in_lists of rows sorted by list, of as many lists at once as have so many pairs; long words are one list at a time."""
    held, pairs = [], 0
    for _, some in groupby(rows, key=lambda r: r[0]):
        some = list(some)
        if len(some) < 2:
            continue
        long = some[0][4] > LONG
        if held and (long or pairs + len(some) ** 2 > PAIRS):
            yield from near_in_lists(held)
            held, pairs = [], 0
        if long:
            yield from near_in_lists([some])
        else:
            held.append(some)
            pairs += len(some) ** 2
    if held:
        yield from near_in_lists(held)


def neighbours(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n_near, best_n, form) of the words(word, n) that have words one edit away: how many, and the most frequent one."""

    lists, found = keyed(listed(words, settings.length)), None
    while True:
        size = lists.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("b") - F.col("a")).alias("window"))
        crowded = materialise(size.where((F.col("size") > settings.crowd) & (F.col("window") > 1)).select("key"), "spelling-crowded")
        last = crowded.isEmpty()
        some = lists if last else lists.join(crowded, "key", "left_anti")
        dealt = some.repartition("key").sortWithinPartitions("key", "mid").select("key", "mid", "word", "n", "m", "a", "b")
        part = materialise(many_rows(dealt, lambda: near_in_rows, "word string, n_near long, n long, form string"), "spelling-near")
        found = part if found is None else found.unionByName(part)
        if last:
            break
        lists = keyed(materialise(halved(lists.join(crowded, "key", "left_semi")), "spelling-lists"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.n")).alias("best_n"), "best.form")


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) of forms(word, form): the last of the forms that follow one another. most: the largest count, which bounds how many do."""
    steps, held = 1, materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while ratio**steps <= most:
        further = held.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        held = materialise(held.join(further, F.col("root") == F.col("__word"), "left").select("word", F.coalesce("__root", "root").alias("root")), "spelling-roots")
        steps *= 2
    return held


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the documents' words."""
    words = materialise(vocabulary(docs, doc_id, text, settings), "spelling-words")
    near = materialise(neighbours(words, settings), "spelling-best")
    most = words.agg(F.max("n")).first()[0] or 0
    own = words.join(near, "word", "left")
    frequent = F.col("best_n") >= settings.ratio * F.col("n")
    own = own.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("form")).alias("form"), F.when(frequent, F.col("best_n")).alias("form_n"))
    own = materialise(own, "spelling-own")
    found = roots(own.where("form IS NOT NULL"), most, settings.ratio)
    out = own.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    discard(near)
    return out
