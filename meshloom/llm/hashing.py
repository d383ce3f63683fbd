"""64-bit hashes of words and of runs of words with numpy, a bounded stretch at a time, and filters over such hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
#: bytes that are hashed at once; a word may be longer
BLOCK = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, as far as needed."""

    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(cls, name, np.multiply.accumulate(x))
        return cls.up, cls.down


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers: differences are hashes of ranges, up to a power."""
    up, _ = Powers.to(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def word_blocks(text: bytes, lower: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and start offsets of the words of text, in order, a block at a time; of a word that runs on, its sum so far is kept."""
    part = held = began = 0
    for at in range(0, len(text), BLOCK):
        raw = text[at : at + BLOCK]
        block = np.frombuffer(raw.lower() if lower else raw, np.uint8)
        gap = np.ones(len(block) + 2, np.int8)
        gap[1:-1] = SPACE[block]
        edges = np.flatnonzero(np.diff(gap))
        a, b = edges[::2], edges[1::2]
        total = sums(block.astype(np.uint64) + np.uint64(1))
        found, size, start = (total[b] - total[a]) * Powers.down[a], (b - a).astype(np.uint64), a + at
        if held:
            if len(a) and a[0] == 0:
                found[0] = (part + int(found[0]) * pow(BASE, held, 1 << 64)) & MASK
                size[0] += np.uint64(held)
                start[0] = began
            else:
                found, size, start = np.append(np.uint64(part), found), np.append(np.uint64(held), size), np.append(began, start)
            part = held = 0
        if len(b) and b[-1] == len(block) and at + BLOCK < len(text):
            part, held, began = int(found[-1]), int(size[-1]), int(start[-1])
            found, size, start = found[:-1], size[:-1], start[:-1]
        if len(found):
            yield mixed(found + size * np.uint64(BASE)), start
    if held:
        yield mixed(np.array([(part + held * BASE) & MASK], np.uint64)), np.array([began])


def word_hashes(text: bytes | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words of text, in order."""
    out = [h for h, _ in word_blocks(text or b"", lower)]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def streams(texts: Iterable[bytes | None], end: np.uint64, lower: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of texts one after another as hashes, ``end`` after each text, with the number of the text; in stretches of a block or so."""
    pack: list[bytes] = []
    first = size = 0

    def packed() -> tuple[np.ndarray, np.ndarray]:
        # texts in a row, a line feed between them, hashed together
        found = list(word_blocks(b"\n".join(pack), lower))
        h = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
        start = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
        borders = np.cumsum([len(x) + 1 for x in pack])
        of = np.searchsorted(borders, start, "right")
        out = np.full(len(h) + len(pack), end, np.uint64)
        out[np.arange(len(h)) + of] = h
        return out, first + np.repeat(np.arange(len(pack)), np.bincount(of, minlength=len(pack)) + 1)

    n = -1
    for n, text in enumerate(texts):
        text = text or b""
        if pack and size + len(text) > BLOCK:
            yield packed()
            pack, size = [], 0
        if len(text) > BLOCK:
            for h, _ in word_blocks(text, lower):
                yield h, np.full(len(h), n)
            yield np.array([end], np.uint64), np.array([n])
            continue
        if not pack:
            first = n
        pack.append(text)
        size += len(text)
    if pack:
        yield packed()


class Tally:
    """Counts of keys, each with further numbers that follow from it; given out whenever there are more than ``most`` distinct ones."""

    def __init__(self, most: int):
        self.most, self.held, self.n = most, [], 0

    def add(self, keys: np.ndarray, *more: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Yields (keys, counts, *more) where it is time."""
        self.held.append(self.merged([(keys, np.ones(len(keys), np.int64), *more)]))
        self.n += len(self.held[-1][0])
        if self.n > self.most:
            self.held = [self.merged(self.held)]
            self.n = len(self.held[0][0])
            if self.n > self.most // 2:
                yield from self.rest()

    def rest(self) -> Iterator[tuple[np.ndarray, ...]]:
        if self.n:
            yield self.merged(self.held)
        self.held, self.n = [], 0

    @staticmethod
    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        keys, counts, *more = parts[0] if len(parts) == 1 else (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(keys)
        ordered = keys[order]
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
        return ordered[at], np.add.reduceat(counts[order], at) if len(at) else counts[:0], *(x[order[at]] for x in more)


class Filter:
    """Which keys may belong to a set: none that do are denied. Two bits a key, both in the segment that its upper bits name.

    It has some 16 bits a key and ``most`` bits at most: what it lets through in vain costs time, and changes no result.
    """

    SEGMENTS = 64

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.width = len(bits) * 8 // self.SEGMENTS

    @classmethod
    def width_for(cls, n: int, most: int = 1 << 28) -> int:
        """Bits of a segment for n keys."""
        bits = 1 << max(12, (16 * max(1, n) - 1).bit_length())
        return min(most, bits) // cls.SEGMENTS

    @staticmethod
    def probes(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(width - 1)
        return keys & mask, (keys >> np.uint64(29)) & mask

    @classmethod
    def of(cls, keys: np.ndarray) -> Filter:
        width = cls.width_for(len(keys))
        held, base = np.zeros(width * cls.SEGMENTS, bool), (keys >> np.uint64(58)) * np.uint64(width)
        for at in cls.probes(keys, width):
            held[base + at] = True
        return cls(np.packbits(held, bitorder="little"))

    def has(self, keys: np.ndarray) -> np.ndarray:
        base = (keys >> np.uint64(58)) * np.uint64(self.width)
        out = None
        for at in self.probes(keys, self.width):
            at = base + at
            hit = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
            out = hit if out is None else out & hit
        return out.astype(bool)

    @classmethod
    def from_table(cls, keys: DataFrame, column: str) -> Filter:
        """Each segment is set in one task; what reaches the driver is the bits, 32 MB at most."""
        width = cls.width_for(keys.count())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for b in batches:
                k = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                of = k >> np.uint64(58)
                for s in np.unique(of).tolist():
                    bits = held.setdefault(s, np.zeros(width, bool))
                    for at in cls.probes(k[of == s], width):
                        bits[at] = True
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())], names=["segment", "bits"])

        n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = keys.select(F.col(column).alias("k")).repartition(min(n, cls.SEGMENTS), F.shiftrightunsigned("k", 58)).mapInArrow(run, "segment int, bits binary").collect()
        bits = np.zeros(width // 8 * cls.SEGMENTS, np.uint8)
        for r in rows:
            bits[r.segment * (width // 8) : (r.segment + 1) * (width // 8)] = np.frombuffer(r.bits, np.uint8)
        return cls(bits)
