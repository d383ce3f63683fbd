"""Quality rules: compression bands over whole documents and fixed chunks.

zstandard ratios (bytes before / bytes after) of the whole text and of fixed chunks are held against limits
that depend on length: a high ratio means repetition, a low one noise. Short texts compress badly whatever they
hold, so each length band has limits of its own.

Defined cases: a null text counts as empty; an empty text has no words and fails the base rule; texts of any length
are compressed whole (a chunk at a time in memory besides); repeated rows are judged alike; an empty table gives no rows;
columns beside doc_id and text are ignored by ``measure`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_row, text_udf

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
#: Deleting these leaves one byte for each code point in words.
NOT_WORD_STARTS = SPACES + bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Band:
    """Limits for texts of fewer than ``below`` bytes; outside [low, high] the text is rejected."""

    below: float
    low: float
    high: float


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    repeat_percent: int = 50
    level: int = 3
    chunk: int = 4096
    #: share of chunks out of their band that rejects a text
    bad_chunks: float = 0.3
    bands: tuple[Band, ...] = (
        Band(128, 0.0, float("inf")),
        Band(256, 0.9, 3.5),
        Band(1024, 1.05, 3.5),
        Band(4096, 1.15, 4.0),
        Band(16384, 1.2, 4.5),
        Band(65536, 1.25, 5.0),
        Band(float("inf"), 1.25, 6.0),
    )

    def band(self, n: int) -> Band:
        return next(b for b in self.bands if n < b.below)


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, chunk_ratio_low double, chunk_ratio_high double, n_chunks long, n_bad_chunks long, base_failed boolean, kept boolean"


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window which the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    hit = np.zeros(len(words), bool)
    at = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    for k in range(3):
        hit[k : k + len(windows)] |= at
    return int(hit.sum())


def dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def measurer(limits: Limits):
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=limits.level).compress

    def measure(text: bytes | None) -> tuple:
        text = text or b""
        words = text.split()
        n_repeat = repeat_words(words)
        failed = len(words) < limits.min_words or 100 * n_repeat > limits.repeat_percent * len(words)
        whole = len(text) / len(squeeze(text)) if text else 0.0
        parts, bad = [], 0
        if len(text) > limits.chunk:
            for at in range(0, len(text), limits.chunk):
                part = text[at : at + limits.chunk]
                band, r = limits.band(len(part)), len(part) / len(squeeze(part))
                parts.append(r)
                bad += not band.low <= r <= band.high
        else:
            band = limits.band(len(text))
            parts, bad = [whole], int(not band.low <= whole <= band.high)
        band = limits.band(len(text))
        passed = band.low <= whole <= band.high and bad <= limits.bad_chunks * len(parts)
        return (len(words), len(text.translate(None, NOT_WORD_STARTS)), len(text) - len(text.translate(None, SYMBOLS)), dup_lines(text), n_repeat, whole, min(parts), max(parts), len(parts), bad, failed, passed and not failed)

    return measure


def measure(docs: DataFrame, keep: list[str], limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The columns of ``keep`` with the measures and the verdict, one row for each row of docs."""

    def make():
        f, n = measurer(limits), len(keep)
        return lambda *row: (*row[:n], *f(row[n]))

    kept = [docs.schema[c] for c in keep]
    return per_row(docs.select(*[F.col(c) for c in keep], F.col(text).cast("binary").alias("__text")), make, T.StructType([*kept, *T.StructType.fromDDL(MEASURES)]))


def keep_good(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The rows of docs that pass, with docs' own columns; only text goes to Python and only the verdict returns."""

    def make():
        f = measurer(limits)
        return lambda x: f(x)[-1]

    return docs.where(text_udf(make, T.BooleanType())(F.col(text).cast("binary")))
