"""Secret scans: a worklist of decoded layers, each rescanned, with spans mapped back to the text.

The text is the first layer. Its URL and Unicode escapes, base64 tokens and what these hold in compressed form each give a further
layer, until nothing new comes out; a layer whose text was seen before at the same place is not scanned again, so cycles end: of
decoded layers only compressed ones can be longer than what they come from, and these have one place throughout. A layer knows how
its places map to those of the layer it was decoded from, and so on back to the text.

Escapes that turn into escapes again give a layer for each of ``levels`` levels; what is nested deeper is then unwrapped to the end
at once, into one more layer, so that the work is in proportion to the text however deep it is nested.

The bytes of a token are read as UTF-8, bytes that are none as U+FFFD, and also as UTF-16 wherever eight or more ASCII characters stand
in it in a row. A token may run over lines: those of equal length of 14 or more, and a shorter one after them; indentation is skipped. Where that shorter one may be a word of
its own, a span can reach into it.

A layer's places are kept as segments, one for each run of characters that come from equally many, so that they take a few bytes a
character at most.

Defined cases: a null text counts as empty; bytes that are no UTF-8 count as U+FFFD; repeated rows are scanned alike; an
empty table gives no rows; other columns are ignored by ``scan`` and kept by ``redact``. A token that unpacks to more than
``max_layer`` bytes, or to more than is left of ``max_unpacked`` bytes for one text, is reported whole as a finding of kind
``oversize``.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_row, text_udf

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "jwt", "forge", "chat", "oversize")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: kind, a string without which the pattern can't match, pattern
OWN = (
    ("pem", "-----BEGIN ", re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")),
    ("jwt", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+")),
    ("forge", "gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    ("chat", "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
)

ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})++|(?:\\u[0-9A-Fa-f]{4})++|(?:\\x[0-9A-Fa-f]{2})++")
#: all that nested escapes can be made of
NESTED = re.compile(r"[%\\][0-9A-Fa-fux%\\]++")
HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
SURROGATES = re.compile("[\ud800-\udfff]")
#: ASCII in UTF-16 of either byte order; every pattern, token and compressed or escaped form of one holds as many characters
WIDE = (("utf-16-le", re.compile(rb"(?:[\x01-\x7f]\x00){8}")), ("utf-16-be", re.compile(rb"(?:\x00[\x01-\x7f]){8}")))
#: 14 characters hold the shortest compressed finding (10 bytes, a Zstandard frame of one repeated hex digit), 19 the shortest plain one
TOKEN64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{14,}={0,2}")
LINES64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{14,}+[ \t]*+\r?\n[ \t]*+)++(?:[A-Za-z0-9+/_-]++={0,2})?")
LINE_END = re.compile(r"[ \t]*(?:[\r\n]|\Z)")
LINE64 = re.compile(r"[A-Za-z0-9+/_-]+")
MAGIC = ((b"\x1f\x8b", "gzip"), (b"\x78\x01", "zlib"), (b"\x78\x5e", "zlib"), (b"\x78\x9c", "zlib"), (b"\x78\xda", "zlib"), (b"\x28\xb5\x2f\xfd", "zstd"), (b"BZh", "bz2"), (b"\xfd7zXZ\x00", "xz"))


@dataclass(frozen=True)
class Settings:
    max_layer: int = 64 << 20
    max_unpacked: int = 256 << 20
    levels: int = 4
    mark: str = "[REDACTED]"


class Layer:
    """A text, the layer that it was decoded from (None: it is the text itself), and how many levels of escapes were decoded in a row."""

    def __init__(self, text: str, parent: Layer | None = None, local=None, level: int = 0):
        self.text, self.parent, self.local, self.level = text, parent, local, level

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The place in the original text that the characters from a to b come from."""
        layer = self
        while layer.parent is not None:
            a, b = layer.local(a, b)
            layer = layer.parent
        return a, b

    def key(self) -> tuple:
        """Equal tokens at two places give two layers."""
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), *self.span(0, len(self.text))


class Stitched:
    """Places of a text in segments: each character of segment k comes from width[k] characters, the first of them from source[k] on."""

    def __init__(self):
        self.begins, self.source, self.width, self.n = array("q"), array("q"), array("q"), 0

    def add(self, length: int, source: int, width: int = 1) -> None:
        if not length:
            return
        if not self.n or self.width[-1] != width or self.source[-1] + width * (self.n - self.begins[-1]) != source:
            self.begins.append(self.n)
            self.source.append(source)
            self.width.append(width)
        self.n += length

    def __call__(self, a: int, b: int) -> tuple[int, int]:
        k, m = bisect_right(self.begins, a) - 1, bisect_right(self.begins, b - 1) - 1
        return self.source[k] + (a - self.begins[k]) * self.width[k], self.source[m] + (b - self.begins[m]) * self.width[m]


class Pieces:
    """Text in parts, joined every few thousand."""

    def __init__(self):
        self.parts, self.done = [], []

    def add(self, part: str) -> None:
        self.parts.append(part)
        if len(self.parts) == 4096:
            self.done.append("".join(self.parts))
            self.parts.clear()

    def text(self) -> str:
        return "".join([*self.done, *self.parts])


class Token:
    """Places of text that a base64 token holds: four characters of the token for three bytes.

    Lines of the token begin at starts and are width long, but for the last; offsets are the bytes before each character, where
    they are not as many as characters.
    """

    def __init__(self, starts, width: int, offsets=None):
        self.starts, self.width, self.offsets = starts, width, offsets

    def at(self, i: int) -> int:
        return self.starts[i // self.width] + i % self.width

    def __call__(self, a: int, b: int) -> tuple[int, int]:
        x, y = (a, b) if self.offsets is None else (int(self.offsets[a]), int(self.offsets[b]))
        return self.at(x * 4 // 3), self.at(-(-y * 4 // 3) - 1) + 1


class Whole:
    """Every place comes from one span."""

    def __init__(self, start: int, end: int):
        self.at = start, end

    def __call__(self, a: int, b: int) -> tuple[int, int]:
        return self.at


def holds_key(text: str, step: int = 1 << 20) -> bool:
    """Whether the text may hold an assignment; long texts are lowered a part at a time."""
    parts = (text[i : i + step + 8].lower() for i in range(0, len(text), step))
    return any(k in part for part in parts for k in ASSIGN_KEYS)


def find(text: str) -> Iterator[tuple[str, int, int]]:
    """What the patterns find in one layer; within each kind leftmost and non-overlapping."""
    if holds_key(text):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                yield "assign", *m.span()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                yield "access", *m.span()
    for m in HEX.finditer(text):
        yield "hex", *m.span()
    for kind, needs, pattern in OWN:
        if needs in text:
            for m in pattern.finditer(text):
                yield kind, *m.span()


def unescaped(run: str) -> tuple[str, np.ndarray | list[int] | int]:
    """The characters of a run of escapes of one kind, and how many characters each comes from: one number where all are alike, a list if few."""
    if run[0] == "%":
        raw = bytes.fromhex(run.replace("%", ""))
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            return raw.decode("latin-1"), 3
        if len(text) == len(raw):
            return text, 3
        if len(raw) < 100:
            return text, [3 * len(c.encode()) for c in text]
        first = np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
        return text, 3 * np.diff(first, append=len(raw))
    if run[1] == "x":
        return bytes.fromhex(run.replace("\\x", "")).decode("latin-1"), 4
    if len(run) == 6 and (run[2] not in "dD" or run[3] < "8"):
        return chr(int(run[2:], 16)), 6
    codes = np.frombuffer(bytes.fromhex(run.replace("\\u", "")), ">u2").astype("<u4")
    high, low = codes & 0xFC00 == 0xD800, codes & 0xFC00 == 0xDC00
    if not (high.any() or low.any()):
        return codes.tobytes().decode("utf-32-le"), 6
    second = np.append(False, high[:-1] & low[1:])
    paired = np.append(second[1:], False)
    codes[(high & ~paired) | (low & ~second)] = 0xFFFD
    at = np.flatnonzero(paired)
    codes[at] = 0x10000 + ((codes[at] - 0xD800) << 10) + codes[at + 1] - 0xDC00
    return codes[~second].tobytes().decode("utf-32-le"), np.where(paired, 12, 6)[~second]


def one_level(layer: Layer) -> Layer | None:
    """layer with its escapes decoded once; None if it has none."""
    text, out, places, last = layer.text, Pieces(), Stitched(), 0
    for m in ESCAPES.finditer(text):
        out.add(text[last : m.start()])
        places.add(m.start() - last, last)
        chars, widths = unescaped(m[0])
        out.add(chars)
        if isinstance(widths, int):
            places.add(len(chars), m.start(), widths)
        elif isinstance(widths, list):
            at = m.start()
            for w in widths:
                places.add(1, at, w)
                at += w
        else:
            ends = np.cumsum(widths)
            cuts = np.append(0, np.flatnonzero(np.diff(widths)) + 1)
            for k, n in zip(cuts, np.diff(cuts, append=len(widths)), strict=True):
                places.add(int(n), m.start() + int(ends[k] - widths[k]), int(widths[k]))
        last = m.end()
    if not last:
        return None
    out.add(text[last:])
    places.add(len(text) - last, last)
    return Layer(out.text(), layer, places, layer.level + 1)


def all_levels(layer: Layer) -> Layer | None:
    """layer with its escapes decoded until none is left. Only runs of characters that nested escapes can be made of are walked."""
    text, out, places, last = layer.text, Pieces(), Stitched(), 0
    for m in NESTED.finditer(text):
        if ESCAPES.search(text, m.start(), m.end()):
            out.add(text[last : m.start()])
            places.add(m.start() - last, last)
            unnested(text, m.start(), m.end(), out, places)
            last = m.end()
    if not last:
        return None
    out.add(text[last:])
    places.add(len(text) - last, last)
    return Layer(out.text(), layer, places, layer.level + 1)


def unnested(text: str, start: int, end: int, out: Pieces, places: Stitched) -> None:
    """Decode one run in one walk: each decoded character may complete an escape with those before it."""
    # characters so far, their places, and whether they are decoded bytes
    codes, begins, ends, is_byte = array("I"), array("q"), array("q"), bytearray()

    def cut(n: int) -> int:
        a = begins[-n]
        for x in (codes, begins, ends, is_byte):
            del x[-n:]
        return a

    marks, digits = {37, 92}, frozenset(map(ord, HEX_DIGITS))
    i = start
    while i < end:
        code, a, b, byte = ord(text[i]), i, i + 1, 0
        i += 1
        while True:
            codes.append(code)
            begins.append(a)
            ends.append(b)
            is_byte.append(byte)
            if code not in digits:
                break
            if len(codes) >= 3 and codes[-3] == 37 and codes[-2] in digits:
                n, byte = 3, 1
            elif len(codes) >= 4 and codes[-4] == 92 and codes[-3] == 120 and codes[-2] in digits:
                n, byte = 4, 0
            elif len(codes) >= 6 and codes[-6] == 92 and codes[-5] == 117 and digits.issuperset(codes[-4:]):
                n, byte = 6, 0
            else:
                break
            code = int("".join(map(chr, codes[1 - n if n == 3 else 2 - n :])), 16)
            a = cut(n)
            if not byte and 0xDC00 <= code < 0xE000 and codes and 0xD800 <= codes[-1] < 0xDC00:
                code = 0x10000 + ((codes[-1] - 0xD800) << 10) + code - 0xDC00
                a = cut(1)
        if marks.isdisjoint(codes[-6:]):  # nothing can be completed before the next mark
            j = min((k for k in (text.find("%", i, end), text.find("\\", i, end)) if k >= 0), default=end)
            codes.extend(map(ord, text[i:j]))
            begins.extend(range(i, j))
            ends.extend(range(i + 1, j + 1))
            is_byte.extend(bytes(j - i))
            i = j
    i = 0
    while i < len(codes):
        j = i
        while j < len(codes) and is_byte[j] and codes[j] >= 0x80:
            j += 1
        if j == i:
            out.add("\ufffd" if 0xD800 <= codes[i] < 0xE000 else chr(codes[i]))
            places.add(1, begins[i], ends[i] - begins[i])
            i += 1
            continue
        raw = bytes(codes[i:j].tolist())
        try:  # bytes in a row may be one character
            for c in raw.decode("utf-8"):
                n = len(c.encode("utf-8"))
                out.add(c)
                places.add(1, begins[i], ends[i + n - 1] - begins[i])
                i += n
        except UnicodeDecodeError:
            out.add(raw.decode("latin-1"))
            for k in range(i, j):
                places.add(1, begins[k], ends[k] - begins[k])
            i = j


class ZstdFrame:
    """One frame, in the manner of the standard library's decompressors."""

    def __init__(self):
        import zstandard

        self.frame, self.eof, self.unused_data = zstandard.ZstdDecompressor().decompressobj(), False, b""

    def decompress(self, raw: bytes, limit: int) -> bytes:
        """Stops soon after limit bytes: a piece of 256 bytes holds at most 64 blocks of 128 KB."""
        out, n = [], 0
        for at in range(0, len(raw), 256):
            out.append(self.frame.decompress(raw[at : at + 256]))
            n += len(out[-1])
            if self.frame.eof:
                self.eof, self.unused_data = True, self.frame.unused_data + raw[at + 256 :]
            if self.eof or n >= limit:
                break
        return b"".join(out)


UNPACK = {"gzip": lambda: zlib.decompressobj(47), "zlib": lambda: zlib.decompressobj(47), "bz2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor, "zstd": ZstdFrame}


def unpacked(raw: bytes, limit: int) -> tuple[list[bytes], bytes]:
    """What each member of compressed bytes holds, and the bytes after the last; no members if they are not compressed; OverflowError beyond limit."""
    out: list[bytes] = []
    n = 0
    while raw and (kind := next((k for m, k in MAGIC if raw.startswith(m)), None)):
        try:
            member = UNPACK[kind]()
            out.append(member.decompress(raw, limit + 1 - n))
        except Exception:  # noqa: BLE001  chance bytes that look like a header
            break
        n += len(out[-1])
        if n > limit:
            raise OverflowError
        raw = member.unused_data.lstrip(b"\0") if member.eof else b""
    return out, raw


def contents(raw: bytes, limit: int) -> Iterator[tuple[bytes, bool]]:
    """(raw, False), or (what it holds, True) if it is compressed: all members together, each by itself, and what follows them.

    OverflowError at the end if anything unpacks beyond limit.
    """
    work, seen, over, first = [raw], set(), False, True
    del raw
    while work:
        x = work.pop()
        if (mark := hashlib.blake2b(x, digest_size=16).digest()) in seen:
            continue
        seen.add(mark)
        try:
            parts, rest = unpacked(x, limit)
        except OverflowError:
            over = True
            continue
        if parts:
            work += [rest, *parts, b"".join(parts)]
        else:
            yield x, not first
        first = False
    if over:
        raise OverflowError


def readings(raw: bytes, placed: bool) -> Iterator[tuple[str, np.ndarray | None]]:
    """The texts that bytes may be, each with the bytes before each character if wanted and not as many as characters."""
    if not raw:
        return
    text = raw.decode("utf-8", "surrogateescape")
    offsets = None
    if placed and len(text) < len(raw):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        widths = 1 + (codes >= 0x80).astype(np.uint8) + (codes >= 0x800) + (codes >= 0x10000)
        widths[codes & 0xFFFFFF80 == 0xDC80] = 1
        offsets = running(widths, 0)
    yield SURROGATES.sub("\ufffd", text), offsets
    for codec, pattern in WIDE:
        for shift in sorted({m.start() % 2 for m in pattern.finditer(raw)}):
            text = raw[shift : len(raw) - (len(raw) - shift) % 2].decode(codec, "surrogatepass")
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") if placed else None
            yield SURROGATES.sub("\ufffd", text), running(2 + 2 * (codes >= 0x10000).astype(np.uint8), shift) if placed else None


def running(widths: np.ndarray, first: int) -> np.ndarray:
    out = np.full(len(widths) + 1, first, np.uint32)
    out[1:] += np.cumsum(widths, dtype=np.uint32)
    return out


def tokens(text: str) -> Iterator[tuple[str, array, int, int]]:
    """What may be base64: its characters, where its lines begin, how long they are but for the last, and where it ends."""
    for m in TOKEN64.finditer(text):
        body = m[0].rstrip("=")
        yield body, array("q", [m.start()]), len(body), m.end()
    for block in LINES64.finditer(text):
        starts, ends = array("q"), array("q")

        def token(a: int, b: int, starts=starts, ends=ends):
            return "".join([text[x:y] for x, y in zip(starts[a:b], ends[a:b], strict=True)]), starts[a:b], ends[a] - starts[a], ends[b - 1]

        for m in LINE64.finditer(text, block.start(), block.end()):
            starts.append(m.start())
            ends.append(m.end())
        i = 0
        while i < len(starts):
            j, width = i + 1, ends[i] - starts[i]
            while j < len(starts) and ends[j] - starts[j] == width:
                j += 1
            # a shorter line may be a word of its own
            shorter = j < len(starts) and ends[j] - starts[j] < width
            padded = shorter and text.startswith("=", ends[j])
            if shorter and (padded or j > i + 1 or LINE_END.match(text, ends[j])):
                yield token(i, j + 1)
            if j > i + 1 and not padded:
                yield token(i, j)
            i = j


def token_layers(layer: Layer, limit: Callable[[], int]) -> Iterator[Layer | tuple[int, int]]:
    """A layer for each text that a base64 token holds, plain or compressed; a span if it unpacks beyond what limit() says then."""
    for body, starts, width, end in tokens(layer.text):
        if len(body) % 4 == 1:
            continue
        try:
            raw = base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))
        except binascii.Error:
            continue
        del body
        try:
            for inner, packed in contents(raw, limit()):
                for text, offsets in readings(inner, not packed):
                    yield Layer(text, layer, Whole(starts[0], end) if packed else Token(starts, width, offsets))
        except OverflowError:
            yield layer.span(starts[0], end)


def scan_text(text: str, settings: Settings = Settings()) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """Base spans of the text itself, all spans, and the number of layers scanned."""
    order = {k: i for i, k in enumerate(KINDS)}
    work, seen, base, found = deque([Layer(text)]), set(), [], set()
    layers, left = 0, settings.max_unpacked
    while work:
        layer = work.popleft()
        layers += 1
        for kind, a, b in find(layer.text):
            if layer.parent is None:
                base += [(kind, a, b)] * (kind in BASE)
            # all findings count: what decoding left as it was may be found only now, beside a decoded character
            found.add((kind, *layer.span(a, b)))
        made: list[Layer] = []
        if "%" in layer.text or "\\" in layer.text:
            decoded = one_level(layer) if layer.level < settings.levels else all_levels(layer)
            made += [decoded] if decoded else []
        for x in token_layers(layer, lambda: min(settings.max_layer, left)):
            if isinstance(x, Layer):
                made.append(x)
                left -= len(x.text) if isinstance(x.local, Whole) else 0
            else:
                found.add(("oversize", *x))
        for x in made:
            if (key := x.key()) not in seen:
                seen.add(key)
                work.append(x)
    by = lambda s: (s[1], order[s[0]], s[2])
    return sorted(base, key=by), sorted(found, key=by), layers


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    out, last = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if b <= last:
            continue
        if a >= last:
            out += [text[last:a], mark]
        last = max(last, b)
    return "".join([*out, text[last:]])


def scan(docs: DataFrame, keep: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The columns of ``keep`` with counts and spans, one row for each row of docs."""

    def make():
        n = len(keep)

        def f(*row):
            base, found, layers = scan_text((row[n] or b"").decode("utf-8", "replace"), settings)
            counts = [sum(k == kind for k, _, _ in base) for kind in BASE]
            return (*row[:n], *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(found), layers)

        return f

    schema = T.StructType([*(docs.schema[c] for c in keep), *T.StructType.fromDDL("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long")])
    return per_row(docs.select(*keep, F.col(text).cast("binary").alias("__text")), make, schema)


def redact(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs with every found span replaced by the mark; a null text stays null."""

    def make():
        def f(x: bytes | None):
            if x is None:
                return None
            whole = x.decode("utf-8", "replace")
            found = scan_text(whole, settings)[1]
            return redacted(whole, found, settings.mark) if found else whole

        return f

    return docs.withColumn(text, text_udf(make, T.StringType())(F.col(text).cast("binary")))
