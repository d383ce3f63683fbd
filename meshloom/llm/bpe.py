"""Byte-pair encoding and decoding with a public word-level vocabulary: lower-cased words cut into pieces, the last one with a word end.

A text is cut at the special tokens; what lies between is normalised (NFC, lower case), cut into words by the vocabulary's pattern, and
each word is written in bytes. A short word is a contiguous array of parts, one for each boundary, and of the ranks of adjacent parts:
the smallest rank is looked for, the boundary at it deleted and the ranks to both sides looked up anew. That is quadratic, so words above
``short`` bytes are merged rank by rank instead, all places of a rank at once, with equal results. Ids of words seen before are kept in a
table of bounded size. Decoding joins the pieces by spaces, as this vocabulary names no decoder; ids that it doesn't know are left out.

Ids are packed as little-endian unsigned 32-bit integers, so a text's ids are one binary value. Defined cases: a null text counts as
empty and has no ids, null ids decode to null; bytes that are no UTF-8 become U+FFFD; texts and words may have any length and are worked
on in stretches; repeated rows are encoded alike; an empty table gives no rows; an output column replaces one of its name.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import pairwise, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import once_a_worker, spare

# Unicode as the tokenizer has it, where this Python's tables differ.
#: letters and numbers of later versions, which count as neither
LATER = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959"
    r"\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    r"\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96"
    r"\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    r"\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
#: capitals of later versions, with their small letters
SMALL = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
SMALL |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
#: marks that the tokenizer's older normal forms don't move or compose
MARKS = (
    r"\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c\U00010d24-\U00010d27\U00010eab-\U00010eac\U00010efd-\U00010eff"
    r"\U00010f46-\U00010f50\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e\U00011839-\U0001183a\U00011930\U0001193d-\U0001193e\U00011943\U000119e0\U00011a34\U00011a47"
    r"\U00011a99\U00011d42\U00011d44-\U00011d45\U00011d97\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae\U0001e2ec-\U0001e2ef"
    r"\U0001e4ec-\U0001e4ef"
)
# End of fixed values.

NEW_CAPITAL = re.compile("[" + "".join(map(chr, SMALL)) + "]")
UNMOVED = re.compile(f"([{MARKS}])")
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
#: from the first character on that any of the values above names
HIGH = re.compile("[\u0558-\U0010ffff]")
CONTROL = re.compile("[\x1c-\x1f]")
#: characters that are worked on at once, unless a word is longer
STRETCH = 1 << 18
#: ids that are decoded at once
IDS = 1 << 18
NONE = 1 << 30
#: bytes of a batch that are encoded or decoded before they go back
SLICE = 4 << 20


@dataclass(frozen=True)
class Settings:
    #: a vocabulary file of the tokenizers library, of words with ends
    file: str = "/opt/tokenizers/word_bpe_49k.json"
    #: bytes of a word that is merged in its array of ranks
    short: int = 128
    #: words, and as many runs between white space, whose ids a task keeps
    kept: int = 1 << 18


def load(file: str) -> dict:
    """The vocabulary file; an error where it isn't of the kind that this module encodes with."""
    if not Path(file).is_file():
        raise FileNotFoundError(f"no vocabulary at {file}: name one by Settings(file=...)")
    found = json.loads(Path(file).read_text())
    model, cut = found["model"], found["pre_tokenizer"]
    kinds = [n["type"] for n in found["normalizer"]["normalizers"]], [p["type"] for p in cut["pretokenizers"]], model["type"], model["end_of_word_suffix"], found["decoder"]
    if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "BPE", "</w>", None):
        raise ValueError(f"{file} is a vocabulary of another kind: {kinds}")
    return {"vocab": model["vocab"], "merges": model["merges"], "pattern": cut["pretokenizers"][0]["pattern"]["Regex"], "special": {t["content"]: t["id"] for t in found["added_tokens"]}}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabularies of this kind: itself where it is visible, else the next from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


@cache
def ranges(kind: str, top: int) -> str:
    """The characters of a class below top, as ranges in a set of Python's own patterns."""
    every = "".join(map(chr, [*range(min(top, 0xD800)), *range(0xE000, top)]))
    runs = regex.findall(f"{kind}+", every, flags=regex.V1)
    return "".join(f"\\U{ord(x[0]):08x}-\\U{ord(x[-1]):08x}" for x in runs)


class Decoder:
    def __init__(self, found: dict):
        strings = {i: s.encode() for s, i in (found["vocab"] | found["special"]).items()}
        self.strings = [strings.get(i) for i in range(max(strings) + 1)]

    def decode(self, ids: bytes | None) -> bytes | None:
        if ids is None:
            return None
        out, strings = [], self.strings
        for at in range(0, len(ids), 4 * IDS):
            found = [strings[i] for i in np.frombuffer(ids[at : at + 4 * IDS], "<u4").tolist() if i < len(strings)]
            if found := [s for s in found if s is not None] if None in found else found:
                out.append(b" ".join(found))
        return b" ".join(out)


class Encoder:
    def __init__(self, found: dict, settings: Settings):
        vocab, self.short_most = found["vocab"], settings.short
        self.inner = [vocab[c] for c in byte_letters()]
        self.last = [vocab[c + "</w>"] for c in byte_letters()]
        self.left, self.right, self.made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in found["merges"]), strict=True))
        self.ranks = {pair: r for r, pair in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True))}
        self.to = self.made.tolist()
        keys = self.left << 32 | self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        # where each merge is of parts that earlier merges make, no merge makes room for one before it
        first = dict(zip(reversed(self.to), range(len(self.to) - 1, -1, -1), strict=True))
        self.in_order = all(first.get(p, -1) < r for r, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True)) for p in (a, b))
        # its classes are written out as ranges, which Python's own matcher finds at once below U+10000, and soonest where they are few
        letters, numbers, spaces = rf"[\p{{L}}--[{LATER}]]", rf"[\p{{N}}--[{LATER}]]", r"\s"
        self.word = []
        for top in (0x80, 0x10000, 0x110000):
            x, n, s = (ranges(kind, top) for kind in (letters, numbers, spaces))
            self.word.append(re.compile(found["pattern"].replace(r"[^\s\p{L}\p{N}]", f"[^{s}{x}{n}]").replace(r"[\p{L}]", f"[{x}]").replace(r"[\p{N}]", f"[{n}]")))
        # places where no word goes on: white space, or the end of letters
        self.gap = re.compile(f"[{s}]|(?<=[{x}])(?![{x}])")
        self.special = found["special"]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.kept_words = Kept(self.pieces, settings.kept)
        self.kept = Kept(lambda run: b"".join(map(self.kept_words.__getitem__, self.words(run))), settings.kept)

    def rank_array(self, parts: list[int]) -> list[int]:
        """Pieces of a short word: an entry of parts for each boundary, and the rank of each part with the next one, of the last with none."""
        of, to = self.ranks.get, self.to
        ranks = [*map(of, pairwise(parts), repeat(NONE)), NONE]
        while (least := min(ranks)) < NONE:
            i = ranks.index(least)
            parts[i] = part = to[least]
            del parts[i + 1], ranks[i]
            if i + 1 < len(parts):
                ranks[i] = of((part, parts[i + 1]), NONE)
            if i:
                ranks[i - 1] = of((parts[i - 1], part), NONE)
        return parts

    def rank_by_rank(self, parts: np.ndarray) -> np.ndarray:
        """The same for a long word: the places of the smallest rank are merged at once, from left to right where they overlap."""
        n = len(parts)
        after, before, alive = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32), np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        due: list[int] = []

        def wait(at: np.ndarray) -> None:
            for part in np.array_split(at, len(at) // IDS + 1):
                part = part[after[part] < n]
                keys = parts[part].astype(np.int64) << 32 | parts[after[part]]
                found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                hit = self.keys[found] == keys
                part, ranks = part[hit], self.order[found[hit]]
                order = np.argsort(ranks, kind="stable")
                part, ranks = part[order], ranks[order]
                starts = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(ranks) else ranks
                for r, places in zip(ranks[starts].tolist(), np.split(part, starts[1:]), strict=False):
                    if r not in waiting:
                        heapq.heappush(due, r)
                    waiting.setdefault(r, []).append(places)

        wait(np.arange(n, dtype=np.int32))
        while due:
            r = heapq.heappop(due)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[alive[at] & (after[at] < n)]
            at = at[(parts[at] == self.left[r]) & (parts[after[at]] == self.right[r])]
            if self.left[r] == self.right[r] and len(at):
                run = np.append(True, after[at[:-1]] != at[1:])  # places that don't overlap the one before
                number = np.arange(len(at))
                at = at[(number - np.maximum.accumulate(np.where(run, number, 0))) % 2 == 0]
            gone = after[at]
            parts[at], alive[gone] = self.made[r], False
            after[at] = after[gone]
            inside = after[at] < n
            before[after[at[inside]]] = at[inside]
            to_left = before[at]
            wait(np.union1d(at, to_left[to_left >= 0]))
        return parts[alive]

    def words(self, text: str) -> list[str]:
        """The words of a normalised text."""
        if text.isascii():
            return [text] if text.isalpha() else self.word[0].findall(text)
        return self.word[2 if ASTRAL.search(text) else 1].findall(text)

    def pieces(self, word: str) -> bytes:
        raw = word.encode()
        if len(raw) > self.short_most and self.in_order:
            parts = np.array(self.inner, np.int32)[np.frombuffer(raw, np.uint8)]
            parts[-1] = self.last[raw[-1]]
            return self.rank_by_rank(parts).astype("<u4").tobytes()
        parts = [*map(self.inner.__getitem__, raw)]
        parts[-1] = self.last[raw[-1]]
        return array("I", self.rank_array(parts)).tobytes()

    def stretches(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            found = self.gap.search(text, at + STRETCH) if len(text) - at > STRETCH else None
            to = found.start() if found else len(text)
            yield text[at:to]
            at = to

    def encode(self, raw: bytes | None) -> bytes:
        text = (raw or b"").decode("utf-8", "replace")
        out = []
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            for piece in self.stretches(normal(part)):
                # no word crosses white space; four controls that split() takes for it are not
                out.append(b"".join(map(self.kept.__getitem__, [piece] if CONTROL.search(piece) else piece.split())))
        return b"".join(out)


class Kept(dict):
    """Values of strings, kept up to a bound; those of long strings are not."""

    def __init__(self, of: Callable[[str], bytes], most: int):
        self.of, self.most = of, most

    def __missing__(self, key: str) -> bytes:
        out = self.of(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = out
        return out


def normal(text: str) -> str:
    """NFC and lower case as the tokenizer has them; a final sigma is a sigma like any other."""
    if text.isascii():
        return text.lower()
    high = HIGH.search(text)
    if high and UNMOVED.search(text, high.start()):
        text = "".join(unicodedata.normalize("NFC", x) for x in UNMOVED.split(text))
    else:
        text = unicodedata.normalize("NFC", text)
    if high and NEW_CAPITAL.search(text):
        text = text.translate(SMALL)
    return text.replace("Σ", "σ").lower()


def added(df: DataFrame, column: str, out: str, make: Callable[[], Callable[[bytes | None], bytes | None]], kind: T.DataType, keep: list[str] | None) -> DataFrame:
    """df, or its columns of keep, with what make()() makes of a column, a few megabytes at once."""
    names = [c for c in (df.columns if keep is None else keep) if c != out]
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField(out, kind)])
    to = pa.string() if isinstance(kind, T.StringType) else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            step = max(1, b.num_rows * SLICE // max(1, b.nbytes))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                made = pa.array([f(x.as_py()) for x in part.column(0)], pa.binary()).cast(to)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], made], names=[*names, out])

    return df.select(F.col(column).cast("binary").alias(spare(df, "of")), *names).mapInArrow(run, schema)


def encode(df: DataFrame, text: str = "text", out: str = "ids", keep: list[str] | None = None, settings: Settings = Settings()) -> DataFrame:
    """df (or of its columns those of keep) with the packed ids of a text column. The vocabulary is a fixed public file, whose size does not follow the data."""
    found = df.sparkSession.sparkContext.broadcast(load(settings.file))
    return added(df, text, out, lambda: once_a_worker(f"bpe-{settings}", found.value, lambda v: Encoder(v, settings)).encode, T.BinaryType(), keep)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None, settings: Settings = Settings()) -> DataFrame:
    """df (or of its columns those of keep) with the text of a column of packed ids."""
    found = df.sparkSession.sparkContext.broadcast(load(settings.file))
    return added(df, ids, out, lambda: once_a_worker(f"bpe-pieces-{settings.file}", found.value, Decoder).decode, T.StringType(), keep)
