"""Layers round trip: a secret wrapped in encodings is found where its wrapping stands."""

import base64
import bz2
import gzip
import lzma
import re
import zlib
from urllib.parse import quote

import pytest
import zstandard

from meshloom.llm import secret_scan as ss

SECRET = 'password="correct-horse-battery"'
WRAPS = {
    "url": lambda s: "".join(f"%{b:02x}" for b in s.encode()),
    "quoted": lambda s: quote(s, safe=""),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "urlsafe": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "bz2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
    "xz": lambda s: base64.b64encode(lzma.compress(s.encode())).decode(),
    "zstd": lambda s: base64.b64encode(zstandard.ZstdCompressor().compress(s.encode())).decode(),
}


@pytest.mark.parametrize("outer", WRAPS)
@pytest.mark.parametrize("inner", WRAPS)
def test_nested(outer, inner):
    wrapped = WRAPS[outer](WRAPS[inner](SECRET))
    text = f"before é {wrapped} after"
    _, found, layers = ss.scan_text(text)
    at = text.index(wrapped)
    spans = [(a, b) for k, a, b in found if k == "assign"]
    assert spans and layers >= 2
    assert all(at <= a < b <= at + len(wrapped) for a, b in spans)
    assert "battery" not in ss.redacted(text, found, "[X]") and ss.redacted(text, found, "[X]").startswith("before é ")


def test_maps_exactly():
    text = "x %70assword=%61bcdefgh1 y"
    _, found, _ = ss.scan_text(text)
    assert ("assign", text.index("%70"), text.index(" y")) in found


def test_cycle_and_bomb():
    assert ss.scan_text("%25" * 50)[2] < 10
    bomb = base64.b64encode(gzip.compress(b"a" * 1_000_000)).decode()
    _, found, _ = ss.scan_text(bomb, ss.Settings(max_layer=1000))
    assert [k for k, *_ in found] == ["oversize"]


@pytest.mark.parametrize("wrap", WRAPS)
def test_token_twice(wrap):
    """Each copy of a wrapped secret is found where it stands, at the top and within a layer."""
    wrapped = WRAPS[wrap](SECRET)
    text = f"one {wrapped} two {wrapped} three"
    for outer in (text, WRAPS["quoted"](text), text + " " + WRAPS["base64"](text)):
        _, found, _ = ss.scan_text(outer)
        assert ss.redacted(outer, found, "[X]").count("[X]") >= 2
        inner = outer.split("three")[0]
        for m in re.finditer(re.escape(wrapped), inner):
            assert any(k == "assign" and m.start() <= a < b <= m.end() for k, a, b in found), m


@pytest.mark.parametrize("secret", ["ghp_" + "a1B2" * 10, "xoxb-1234567890-abcdef"])
@pytest.mark.parametrize("before", ["Authorization%3A%20Bearer%20", "%22", "\\u0022", "\\x20", "%2522"])
def test_starts_beside_escape(before, secret):
    """The escape ends in a letter or digit, so the word starts only once it is decoded."""
    text = f"x {before}{secret} y"
    _, found, _ = ss.scan_text(text)
    assert text.index(secret) in {a for k, a, _ in found if k in ("forge", "chat")}
    assert secret not in ss.redacted(text, found, "[X]")


PACKS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress, "zstd": zstandard.ZstdCompressor().compress}


@pytest.mark.parametrize("pack", PACKS)
@pytest.mark.parametrize("members", [("plain ", SECRET), ("plain ", "b ", SECRET, " c"), (b"\xff\xfe", SECRET), (SECRET, b"\xff\xfe"), (SECRET[:14], SECRET[14:])])
def test_members(pack, members):
    """All members of compressed bytes are read, also beside one that holds no text."""
    raw = b"".join(PACKS[pack](x if isinstance(x, bytes) else x.encode()) for x in members)
    for tail in (b"", b"\0" * 8, b"\xffjunk", PACKS["gzip"](b"more")):
        text = f"x {base64.b64encode(raw + tail).decode()} y"
        assert "assign" in {k for k, *_ in ss.scan_text(text)[1]}


def test_members_beyond_limit():
    for pack in PACKS.values():
        token = base64.b64encode(pack(b"a" * 600) + pack(b"b" * 600)).decode()
        assert [k for k, *_ in ss.scan_text(token, ss.Settings(max_layer=1000))[1] if k != "hex"] == ["oversize"]


@pytest.mark.parametrize("secret", [b"token=abcdefgh", zlib.compress(b"a" * 32), b"\x28\xb5\x2f\xfd\x20\x20\x03\x01\x00a"])
def test_short_tokens(secret):
    text = f"x {base64.b64encode(secret).decode()} y"
    assert [s[0] for s in ss.scan_text(text)[1]] in (["assign"], ["hex"])
    assert ss.scan_text(text.replace("=", ""))[1]


def test_clean_text():
    assert ss.scan_text("nothing to see, 100% sure \\unlikely") == ([], [], 1)


def test_deep_escapes():
    """Nested escapes are unwrapped to the end in one walk, and what stands at the core is found where it stands."""
    for core in ("70assword=abcdefgh1", "5cx70assword=abcdefgh1", "5cu0070assword=abcdefgh1"):
        text = "x %" + "25" * 100_000 + core + " y"
        _, found, layers = ss.scan_text(text)
        assert layers < 12
        assert ("assign", 2, len(text) - 2) in found
    alternating = "%5cu0025" * 5_000 + "%5cx25" * 5_000 + "41"
    assert ss.scan_text(alternating)[2] < 12


def nested(text, times):
    for k in range(times):
        text = "".join(f"\\u{ord(c):04x}" if k % 2 else f"%{b:02X}" for c in text for b in c.encode("latin-1")[:1])
    return text


@pytest.mark.parametrize("levels", [0, 1, 4])
@pytest.mark.parametrize("times", [1, 2, 3])
def test_levels_agree(levels, times):
    """One level after another or all at once: the same core, and the same place."""
    text = "é " + nested("token=abcdefgh1", times) + " %C3%A9 \\ud83d\\ude00 %zz \\u00"
    _, found, _ = ss.scan_text(text, ss.Settings(levels=levels))
    assert ("assign", 2, 2 + len(nested("token=abcdefgh1", times))) in found
    plain = "é token=abcdefgh1 é 😀 %zz \\u00"
    layer = ss.Layer(text)
    while (deeper := ss.one_level(layer)) is not None:
        layer = deeper
    assert layer.text == plain == ss.all_levels(ss.Layer(text)).text
    for x in (layer, ss.all_levels(ss.Layer(text))):
        assert x.span(0, 2) == (0, 2) and x.span(len(plain) - 8, len(plain)) == (len(text) - 8, len(text))
        assert text[slice(*x.span(plain.index("😀"), plain.index("😀") + 1))] == "\\ud83d\\ude00"
        assert text[slice(*x.span(plain.rindex("é"), plain.rindex("é") + 1))] == "%C3%A9"


def test_large_layer():
    """A layer of 60 MB: in seconds, and below 300 MB more than before."""
    import resource
    import time

    token = base64.b64encode(gzip.compress(b"a b c d " * 7_500_000 + SECRET.encode())).decode()
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    _, found, _ = ss.scan_text(f"x {token} y")
    assert ("assign", 2, 2 + len(token)) in found
    assert time.perf_counter() - began < 60 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


def test_many_large_layers():
    """What one text unpacks to is bounded in all; tokens beyond it are reported."""
    tokens = [base64.b64encode(gzip.compress(bytes([97 + i]) + b" word" * 2_000)).decode() for i in range(5)]
    _, found, _ = ss.scan_text(" ".join(tokens), ss.Settings(max_unpacked=35_000))
    assert sum(k == "oversize" for k, *_ in found) == 2


LONG = 'api_key = "' + "k3Y9" * 12 + '" and password: correct-horse-battery'


def lines(token, width, end="\n", indent=""):
    return (end + indent).join(token[i : i + width] for i in range(0, len(token), width))


@pytest.mark.parametrize(
    "raw",
    [
        b"caf\xe9 " + LONG.encode(),
        LONG.encode() + b" \xff\xfe",
        LONG.encode("utf-16"),
        LONG.encode("utf-16-le"),
        LONG.encode("utf-16-be"),
        b"\x01" + ("\u4e2d\U0001f600 " + LONG).encode("utf-16-le"),
        b"\x01\x02\x03" * 40 + LONG.encode(),
    ],
)
@pytest.mark.parametrize("pack", [bytes, zlib.compress])
@pytest.mark.parametrize("wrap", [None, (64, "\n", ""), (76, "\r\n", ""), (20, "\n", "    ")])
def test_no_layer_is_dropped(raw, pack, wrap):
    """Bytes that are no UTF-8, UTF-16 of either order, control characters, and tokens over several lines."""
    token = base64.b64encode(pack(raw)).decode()
    token = token if wrap is None else lines(token, *wrap)
    text = f"some words before\n{token}\nand others after"
    _, found, _ = ss.scan_text(text)
    at = text.index(token)
    spans = {(a, b) for k, a, b in found if k == "assign"}
    assert len(spans) >= (2 if pack is bytes else 1) and all(at <= a < b <= at + len(token) + (4 if wrap else 0) for a, b in spans)
    # what is left of the token gives neither secret
    left = ss.redacted(text, found, "[X]")
    for whole in (left, *(x for m in ss.TOKEN64.finditer(left) for x in (base64.b64decode(m[0] + "=" * (-len(m[0]) % 4) if len(m[0]) % 4 != 1 else "").decode("latin-1"),))):
        assert "horse-battery" not in whole.replace("\0", "") and "k3Y9" * 11 not in whole.replace("\0", "")


@pytest.mark.parametrize("before", [b"", b"caf\xe9 ", "\u4e2d\u6587\U0001f600".encode()])
@pytest.mark.parametrize("width", [16, 64])
def test_places_within_a_token(before, width):
    """A span in a token covers the characters that hold its bytes, also over line ends."""
    raw = before + b"some words " * 5 + b"password=abcdefgh1 " + b"others follow " * 5
    token = base64.b64encode(raw).decode()
    text = "x " + lines(token, width) + "\n\ny"
    at = raw.index(b"password")
    want = {2 + i + i // width for i in range(at * 4 // 3, -(-(at + 18) * 4 // 3))}
    assert ("assign", min(want), max(want) + 1) in ss.scan_text(text)[1]


def test_lines_of_words_are_no_token():
    text = "an extraordinarily\nlong-word stands\nincomprehensibly\nat the ends of\nincomprehensible\n"
    assert ss.scan_text(text)[:2] == ([], [])


def grown(f):
    """Megabytes that f takes at most, in a process of its own, and seconds."""
    import multiprocessing

    def run(send):
        import resource
        import time

        before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
        out = f()
        send.send(((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024, time.perf_counter() - began, out))

    take, send = multiprocessing.get_context("fork").Pipe(False)
    p = multiprocessing.get_context("fork").Process(target=run, args=(send,))
    p.start()
    out = take.recv()
    p.join()
    return out


@pytest.mark.parametrize(
    "make",
    [
        lambda: "%41" * 6_666_000 + " %70assword=abcdefgh1",
        lambda: "%" + "25" * 5 + "41 " + "plain words " * 750_000 + " %70assword=abcdefgh1",
        lambda: "\\u0041" * 3_333_000 + " \\u0070assword=abcdefgh1",
        lambda: "%C3%A9a" * 1_400_000 + " %70assword=abcdefgh1",
    ],
)
def test_long_escapes(make):
    """Texts of 9 to 20 MB of escapes, and with one deep escape, below 300 MB."""
    text = make()
    mb, _, found = grown(lambda: ss.scan_text(text)[1])
    assert ("assign", text.index(" %70" if " %70" in text else " \\u0070") + 1, len(text)) in found
    assert mb < 300, mb
