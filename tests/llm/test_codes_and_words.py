"""Byte pairs against the tokenizers library, vector codes and spelling variants against plain versions."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from os.path import commonprefix

import numpy as np
import pytest

from meshloom.llm import bpe, spelling, vector_codes
from meshloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.Settings().file)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load(bpe.Settings().file), bpe.Settings())


@pytest.fixture(scope="module")
def decoder():
    return bpe.Decoder(bpe.load(bpe.Settings().file))


def told(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)


def test_bpe(spark, tables, documents, library):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_bpe"](spark, tables).collect()}
    for d, t in documents:
        ids, text = told(library, t or "")
        assert got[d] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), d


def test_bpe_on_odd_texts(library, encoder, decoder):
    r = random.Random(1)
    pool = ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "''", " ", "\n", "Σ", "İ", "é", "ͅ", "֋", "\U00016ea0", "\U00010d50", "ᫎ", "٣", "中", "🙂", "the", "ing", "\x85", "\xa0", "‍", "\x1c", "_", "--"]
    for _ in range(4000):
        text = "".join(r.choice(pool) if r.random() < 0.6 else chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x3000), r.randrange(0x10000, 0x20000)])) for _ in range(r.randint(0, 25)))
        ids, back = told(library, text)
        assert encoder.encode(text.encode()) == ids and decoder.decode(ids).decode() == back, ascii(text)


def test_bpe_on_long_words_and_texts(library, encoder, monkeypatch):
    r = random.Random(2)
    merged = bpe.Encoder(bpe.load(bpe.Settings().file), bpe.Settings(short=0))
    for _ in range(200):
        text = "".join(r.choice("aaabetinghs") for _ in range(r.randint(1, 400)))
        assert encoder.encode(text.encode()) == merged.encode(text.encode()) == told(library, text)[0]
    monkeypatch.setattr(bpe, "STRETCH", 40)
    for _ in range(300):
        text = "".join(r.choice(["the ", "cat's", "'", "s", "9", "  ", "--", "é", "'lla", "!'re"]) for _ in range(r.randint(1, 200)))
        assert encoder.encode(text.encode()) == told(library, text)[0]


def test_bpe_of_unknown_ids_nulls_and_clashing_names(spark, decoder):
    assert decoder.decode(struct.pack("<3I", 320, 4_000_000_000, 321)) == b"a</w> b</w>"
    df = spark.createDataFrame([(1, None, "x"), (2, "a b", "y")], "ids int, text string, decoded string")
    got = bpe.decode(bpe.encode(df)).collect()
    assert [(r.text, bytes(r.ids), r.decoded) for r in got] == [(None, b"", ""), ("a b", struct.pack("<2I", 320, 321), "a</w> b</w>")]
    assert bpe.decode(spark.createDataFrame([(None,)], "ids binary")).first().decoded is None
    with pytest.raises(FileNotFoundError):
        bpe.encode(df, settings=bpe.Settings(file="/nowhere.json"))


def test_bpe_in_bounded_memory(encoder, decoder):
    import tracemalloc

    for text in ("a" * 3_000_000, "the cat's mat, 99! " * 200_000):
        tracemalloc.start()
        ids = encoder.encode(text.encode())
        decoder.decode(ids)
        assert tracemalloc.get_traced_memory()[1] < 200 << 20
        tracemalloc.stop()


VECTORS = "vec_id long, embedding array<float>, label int, code string, error string, position int"


def plain_codes(rows, entries=256, parts=4, rounds=4):
    """rows (vec_id, vector, label) to {vec_id: (code, error)} and the codebooks, with Python's numbers."""
    rows = sorted((r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: r[0])
    whole = [[int(np.floor(float(x) * 1024)) for x in v] for _, v, _ in rows]
    w = len(whole[0]) // parts
    cut = [[v[k * w : (k + 1) * w] for v in whole] for k in range(parts)]
    books = [[list(p) for p in some[:entries]] for some in cut]
    far = lambda p, c: sum((a - b) ** 2 for a, b in zip(p, c, strict=True))
    near = lambda k: [min((far(p, c), e) for e, c in enumerate(books[k])) for p in cut[k]]
    for _ in range(rounds):
        for k in range(parts):
            at = near(k)
            for e in range(len(books[k])):
                own = [p for p, (_, x) in zip(cut[k], at, strict=True) if x == e]
                if own:
                    books[k][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [near(k) for k in range(parts)]
    return {r[0]: ("".join(f"{f[i][1]:02x}" for f in found), sum(f[i][0] for f in found)) for i, r in enumerate(rows)}, books


def vectors(n, seed=5, length=8):
    r = random.Random(seed)
    out = [(3 * i, [r.gauss(0, 1) for _ in range(length)], r.choice([0, 1, None])) for i in range(n)]
    out += [(10_000 + i, [0.5] * length, 7) for i in range(n)]  # one vector that half of all rows repeat
    return out + [(-1, None, 1), (-2, [], 1), (-3, [1.0, None] * (length // 2), 1), (-4, [float("nan")] * length, 1), (-5, [float("inf")] * length, 1)]


def test_vector_codes(spark, tmp_path):
    rows = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None, y) for i, v, y in vectors(400)]
    spark.createDataFrame([(*r, "x", "y", 1) for r in rows], VECTORS).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, books = plain_codes(rows)
    got = {r.vec_id: r for r in QUERIES["op12_vector_codes"](spark, str(tmp_path)).collect()}
    assert {k: (r.code, r.error) for k, r in got.items()} == want
    labels = defaultdict(int)
    for i, _, y in rows:
        labels[y] += want.get(i, ("", 0))[1]
    assert all(got[i].label_error == labels[y] for i, _, y in rows if i in got)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    assert {r.codebooks_sha256 for r in got.values()} == {digest}


def test_vector_codes_on_odd_tables(spark):
    codes, books = vector_codes.quantise(spark.createDataFrame([], VECTORS), "vec_id", "embedding", "label")
    assert codes.collect() == [] and books.shape == (4, 0, 0)
    # fewer rows than entries, repeated rows, null keys, a length that four doesn't divide, another length, huge components
    rows = [(1, [1.0] * 6, 1), (1, [1.0] * 6, 1), (None, [2.0] * 6, None), (None, [3e38] * 6, 2), (5, [1.0] * 4, 1)]
    codes, books = vector_codes.quantise(spark.createDataFrame([(*r, "", "", 0) for r in rows], VECTORS), "vec_id", "embedding")
    got = codes.collect()
    assert books.shape == (4, 4, 2) and sorted((r.vec_id or 0, r.error, r.code.hex()) for r in got) == [(0, 0, "02020200"), (0, 0, "03030300"), (1, 0, "00000000"), (1, 0, "00000000")]
    back = vector_codes.restored(codes.where("vec_id = 1"), books, 6).collect()
    assert [list(r.vector) for r in back] == [[1.0] * 6] * 2


def test_only_parts_that_change_move(spark):
    """An entry's members are spread over owners by salt; a part that keeps its entry is in no shuffle."""
    df = spark.createDataFrame([(i, k % 2, i % 3) for i in range(600) for k in range(2)], "row long, position int, entry int")
    dealt = vector_codes.migrated(df, {(p, e): 200 for p in range(2) for e in range(3)}, vector_codes.Settings())
    assert sorted(dealt.collect()) == sorted(df.collect())
    x = np.array([[5, 5], [1 << 26, 0]], np.int64)
    entry, error = vector_codes.nearest(x, np.array([[5, 5], [5, 5], [0, 0]], np.int64))
    assert entry.tolist() == [0, 2 if (1 << 52) < (((1 << 26) - 5) ** 2 + 25) else 0] and error[0] == 0 and error[1] == min(((1 << 26) - 5) ** 2 + 25, 1 << 52)


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_variants(docs):
    count = Counter()
    for d, t in docs:
        for run in RUN.findall(t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    near = {w: [v for v in words if edits(v, w)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)
    return out


def edits(u, v):
    if u == v or abs(len(u) - len(v)) > 1:
        return False
    u, v = sorted((u, v), key=len)
    p = len(commonprefix((u, v)))
    return u[p + 1 :] == v[p + 1 :] if len(u) == len(v) else u[p:] == v[p + 1 :]


def word_rows():
    """Documents with chains of forms, ties, capitals, letters beyond A-Z, long runs and words that differ in each place."""
    r = random.Random(8)
    texts = ["Receive " * 1200 + "recieve receivé receivs receives " * 3, "abcdefgh " * 300 + "abcdefg " * 20 + "abcdef " * 9 + "xabcdefg " * 2, "ÀÉÎÕÜß÷× éééééééé ééééééé " * 4]
    stem = "variation"
    every = [stem[:i] + c + stem[i + k :] for i in range(len(stem) + 1) for c in ("", *"aeiouxyz") for k in (0, 1)]
    texts += [" ".join(r.choice(every) for _ in range(400)) for _ in range(6)] + ["q" * 900 + " " + "q" * 901 + " z" + "q" * 900] * 2 + [None, "", "1234567 short"]
    return [(None if k == 4 else k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("crowd", [1, 7, 512])
def test_spelling(spark, crowd):
    docs = word_rows()
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.grouped(df, settings=spelling.Settings(crowd=crowd)).collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(found) == len(got) > 100 and found == plain_variants(docs)
    assert any(root not in (w, form) for w, (form, root, *_) in found.items())  # a form that has a form


def test_spelling_of_repeated_and_empty_tables(spark, odd_tables):
    repeated, empty = odd_tables
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{repeated}/documents.parquet").collect()]
    got = QUERIES["op13_spelling"](spark, repeated).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain_variants(docs)
    assert QUERIES["op13_spelling"](spark, empty).collect() == []


def test_scan(spark):
    r = random.Random(2)
    for _ in range(300):
        lists = [sorted({"".join(r.choice("abé") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 30))}) for _ in range(r.randint(1, 4))]
        flat, group = [w for some in lists for w in some], np.repeat(np.arange(len(lists)), [len(some) for some in lists])
        asks = np.array([r.random() < 0.7 for _ in flat])
        i, j = spelling.scan(flat, group, asks)
        want = [(a, b) for a in range(len(flat)) if asks[a] for b in range(len(flat)) if group[a] == group[b] and edits(flat[a], flat[b])]
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == want
