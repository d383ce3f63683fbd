"""The pipeline against a plain version of its stages, and each stage's columns."""

import hashlib
import math
from collections import Counter

import pytest
import zstandard

import corpus_pipeline
from meshloom.llm import quality_rules as qr
from tests.llm import brute


def good(text):
    """Base rules, then compression bands of the whole text and of its chunks."""
    if brute.quality(text)[-1]:
        return False
    limits, raw = qr.Limits(), (text or "").encode()
    ratio = lambda b: len(b) / len(zstandard.ZstdCompressor(level=limits.level).compress(b))
    outside = lambda b: not next((x.low, x.high) for x in limits.bands if len(b) < x.below)[0] <= ratio(b) <= next(x.high for x in limits.bands if len(b) < x.below)
    chunks = [raw[i : i + limits.chunk] for i in range(0, len(raw), limits.chunk)]
    return not outside(raw) and sum(map(outside, chunks)) <= limits.bad_chunks * len(chunks)


def without_secrets(text):
    spans = sorted((m.start(), m.end()) for _, p, ok in brute.KINDS for m in p.finditer(text) if ok(m))
    out, last = "", 0
    for a, b in spans:
        if b > last:
            out += (text[last:a] + "[REDACTED]") if a >= last else ""
            last = b
    return out + text[last:]


def copies(docs):
    """doc_id, text, source to doc_id: how often the mix takes it."""
    size = {d: len(brute.WORD.findall(t)) for d, t, _ in docs}
    sources = sorted({s for *_, s in docs}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(size[d] for d, _, x in docs if x == s) for s in sources}
    target, free, left = {}, set(sources), 1.5 * sum(total.values())
    while True:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= 2 * total[s]}
        if not over:
            break
        target |= {s: 2.0 * total[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    target |= {s: share * weight[s] for s in free}
    out = {}
    for d, _, s in docs:
        rate = target[s] / total[s] if total[s] else 0.0
        draw = int(hashlib.md5(f"7:{d}".encode()).hexdigest()[:13], 16) / 16**13
        out[d] = math.floor(rate) + (draw < rate - math.floor(rate))
    return out


def test_pipeline(spark, tables):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    docs = [(d, r.text) for d, r in rows.items() if good(r.text)]
    linked = brute.simhash(docs)
    docs = [(d, t) for d, t in docs if linked[d][1] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    bad = brute.decontaminate(docs, items)
    docs = [(d, without_secrets(t)) for d, t in docs if not bad[d][-1]]
    times = copies([(d, t, rows[d].source) for d, t in docs])
    want = Counter({(d, t): times[d] for d, t in docs})
    got = corpus_pipeline.run(spark, tables)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == +want
    assert got.columns == spark.read.parquet(f"{tables}/documents.parquet").columns


def first_of_components(rows):
    """Of each component of linked fingerprints the row of the smallest doc_id, null last."""
    fps = {t: brute.fingerprint(t) for _, t, _ in rows}
    kinds, parent = sorted(set(fps.values())), {f: f for f in fps.values()}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(b)] = root(a)
    first = {}
    for d, t, _ in rows:
        c = root(fps[t])
        if c not in first or (d is None, d or 0) < (first[c][0] is None, first[c][0] or 0):
            first[c] = (d, t)
    return Counter(first.values())


def mixed(rows):
    """Rows as often as the mix takes them, each row counted by itself."""
    sizes = [len(brute.WORD.findall(t or "")) for _, t, _ in rows]
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(n for n, (*_, x) in zip(sizes, rows, strict=True) if x == s) for s in sources}
    target, free, left = {}, set(sources), 1.5 * sum(total.values())
    while over := {s for s in free if left / sum(weight[x] for x in free) * weight[s] >= 2 * total[s]}:
        target |= {s: 2.0 * total[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
        if not free:
            break
    target |= {s: left / sum(weight[x] for x in free) * weight[s] for s in free}
    out = Counter()
    for d, t, s in rows:
        rate = target[s] / total[s] if total[s] else 0.0
        draw = int(hashlib.md5(f"7:{'' if d is None else d}".encode()).hexdigest()[:13], 16) / 16**13
        out[d, t] += math.floor(rate) + (draw < rate - math.floor(rate))
    return +out


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_tables(spark, odd_tables, k):
    """Each stage on repeated rows and null doc_ids against a plain version, and on empty tables."""
    repeated, empty = odd_tables
    docs = spark.read.parquet(f"{repeated}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{repeated}/benchmark.parquet").collect()]
    bad = {t: x[-1] for t, x in brute.decontaminate([(t, t) for t in {t for _, t, _ in rows}], items).items()}
    want = [
        lambda: Counter((d, t) for d, t, _ in rows if good(t)),
        lambda: first_of_components(rows),
        lambda: Counter((d, t) for d, t, _ in rows if not bad[t]),
        lambda: Counter((d, None if t is None else without_secrets(t)) for d, t, _ in rows),
        lambda: mixed(rows),
    ][k]()
    out = corpus_pipeline.STAGES[k][1](spark, docs, repeated)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == want
    docs = spark.read.parquet(f"{empty}/documents.parquet")
    out = corpus_pipeline.STAGES[k][1](spark, docs, empty)
    assert out.columns == docs.columns and out.isEmpty()
