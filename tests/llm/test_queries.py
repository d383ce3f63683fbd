"""Every query against a plain version on small tables, and on repeated, null and empty ones."""

import math
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meshloom.llm import common, token_counts
from meshloom.llm.queries import QUERIES
from tests.llm import brute


def rows(spark, name, d):
    return QUERIES[name](spark, d).collect()


def by_id(got, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in got}


@pytest.mark.parametrize("name", QUERIES)
def test_odd_tables(spark, odd_tables, name):
    repeated, empty = odd_tables
    n = spark.read.parquet(f"{repeated}/documents.parquet").count()
    if name != "op13_spelling":  # a row for each word
        assert len(rows(spark, name, repeated)) == (0 if name == "op12_vector_codes" else n)
    assert rows(spark, name, empty) == []


def test_token_counts(spark, tables, documents):
    vocabulary = set(token_counts.pieces(token_counts.Settings().model))
    got = by_id(rows(spark, "op1_token_counts", tables), "n_words", "n_tokens")
    for d, t in documents:
        if len(t or "") < 1_000_000:
            assert got[d] == (len(brute.WORD.findall(t or "")), brute.greedy(vocabulary, t)), d


def test_toxicity(spark, tables):
    got = rows(spark, "op2_toxicity", tables)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_toxicity_ignores_held_out_labels(spark, tables, tmp_path):
    """Labels of held-out documents turned round, and texts, sources and languages of labels' rows apart, change no score."""
    held = common.is_remainder(F.col("doc_id"), 4, 2)
    docs, labels = common.table(spark, tables, "documents"), common.table(spark, tables, "labels")
    docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("toxic")).write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(f"{tmp_path}/labels.parquet")
    assert by_id(rows(spark, "op2_toxicity", tables), "held_out", "score") == by_id(rows(spark, "op2_toxicity", str(tmp_path)), "held_out", "score")


@pytest.mark.parametrize("fold", [0, 1, 2])
def test_toxicity_of_few_labels(spark, tables, fold):
    """Without labels, with those for the trees alone and with those for the calibration alone each text has a score."""
    from meshloom.llm import toxicity

    docs = common.table(spark, tables, "documents")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.length("text") % 2).alias("toxic"))
    some = toxicity.labelled(labels, F.lit(True), toxicity.Settings()).where(F.col("fold") == fold).select("key").distinct()
    few = labels.join(some, labels.doc_id == some.key, "left_semi")
    got = toxicity.score(docs, few, F.lit(False)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert (len({r.score for r in got}) > 1) == (fold == 1)  # the trees' own probability


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no tables")
def test_toxicity_on_held_out_rows(spark):
    """Held-out documents: nearly all toxic ones score above nearly all others, and scores are chances."""
    d = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [(r.score, truth[r.doc_id], r.predicted) for r in rows(spark, "op2_toxicity", d) if r.held_out and r.doc_id in truth]
    bad, good = [s for s, t, _ in got if t], [s for s, t, _ in got if not t]
    auc = sum((x > y) + 0.5 * (x == y) for x in bad for y in good) / (len(bad) * len(good))
    right = sum(p == t for _, t, p in got) / len(got)
    assert len(bad) > 100 and auc > 0.98 and right > 0.97, (len(bad), len(good), auc, right)
    assert sum(s for s, *_ in got) / len(got) == pytest.approx(len(bad) / len(got), abs=0.03)


def plain_features(text, learned, settings):
    import re

    from meshloom.llm import toxicity as tx

    text = text or ""
    words = re.findall(r"[^\W\d_]+", text.lower())
    weight = lambda w: max([learned.get(w, 0.0)] + [learned.get(w[:n] + "*", 0.0) for n in settings.beginnings if n < len(w)])
    n, times = max(1, len(words)), Counter(words)
    insults, strong = [w for w in words if w in tx.INSULTS], [w for w in words if weight(w) >= 3]
    you = [i for i, w in enumerate(words) if w in tx.SECOND_PERSON]
    near = sum(any(abs(i - j) <= settings.near for j in you) for i, w in enumerate(words) if w in tx.INSULTS or weight(w) >= 3)
    odd = tx.ODD.findall(text)
    plain = ["".join(re.findall(r"[^\W\d_]+", w.lower().translate(tx.LEET))) for w in odd]
    upper, chars = sum(c.isupper() for c in text), max(1, len(text))
    return [
        math.log1p(len(words)), len(insults), len(insults) / n, sum(weight(w) > 0 for w in words), sum(weight(w) > 0 for w in words) / n, sum(map(weight, words)) / n, max(map(weight, words), default=0.0),
        len({w for w in words if weight(w) > 0}), len(strong), len(strong) / n, len(you) / n, near, upper / chars, float(upper > chars / 2), sum(c in "!?" for c in text) / chars,
        sum(c in "*#$%&@" for c in text) / chars, len(odd) / n, sum(w in tx.INSULTS or weight(w) >= 3 for w in plain), max(times.values(), default=0) / n,
    ]


def test_toxicity_features(documents):
    from meshloom.llm import toxicity as tx

    settings = tx.Settings()
    learned = {"moron": 3.5, "stup*": 4.0, "abc*": 0.5, "for": 0.1, "cc": 3.0}
    featurer = tx.Featurer(learned, settings)
    texts = [t for _, t in documents] + ["YOU stupidly abcdef IDIOT!!! 1d10t m0r0n$ f00l you cc cc", "du Trottel du", "a you a a a a a moron a a a a a a you"]
    for t in texts:
        assert featurer((t or "").encode() or None) == pytest.approx(plain_features(t, learned, settings)), t


TREES = [{}, {"context_least": 3, "least": 2, "ratio": 1.5, "min_bits": 1.0, "head": 20}, {"context_least": 2, "least": 2, "ratio": 1.2, "min_bits": 4.0, "depth": 5, "head": 0, "named": 3}, {"least": 3, "depth": 1, "min_bits": 2.0}]


@pytest.mark.parametrize("given", TREES)
def test_suffix_tree_scores(spark, tables, documents, given):
    """Every text's score against plain counting, whatever part of the values is broadcast and whatever is joined."""
    import zlib

    from meshloom.llm import suffix_tree as st

    settings = st.Settings(**given)
    say = [(5 * i + j, t) for i in range(30) for j, t in enumerate(("a b c a b d a b c", "A b c a b c", "d a b", None, "x a b c a b d d d d d d"))]
    for rows_ in (documents, say):
        held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows_}
        score, tree, _ = brute.suffix_tree([t for d, t in rows_ if not held[d]], settings.depth, settings.context_least, settings.least, settings.ratio, settings.discount, settings.min_bits)
        docs = spark.createDataFrame(rows_, "doc_id long, text string").repartition(3)
        got = by_id(st.score(docs, common.is_remainder(F.col("doc_id"), 5, 1), settings=settings).collect(), "base_score", "score")
        assert tree and (rows_ is documents or settings.depth == 1 or max(map(len, tree)) > 1)
        for d, t in rows_:
            assert got[d] == pytest.approx(score(t), rel=1e-9), d


def test_suffix_tree_leaves_out_only_what_is_not_kept(spark):
    """Pairs of common words that are left out early change no score."""
    import random

    from meshloom.llm import suffix_tree as st

    r = random.Random(7)
    say = lambda: " ".join(r.choices("abcdefgh", [30, 20, 10, 5, 3, 2, 1, 1], k=80))
    rows_ = [(i, say() + " x y z " + say() + " a h h a") for i in range(150)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string").repartition(3)
    counted = []
    kept = st.count_runs
    try:
        st.count_runs = lambda *a: counted.append(kept(*a).count()) or kept(*a)
        got = [by_id(st.score(docs, F.lit(False), settings=st.Settings(common=n)).collect(), "score") for n in (0, 1000)]
    finally:
        st.count_runs = kept
    assert got[0] == {d: pytest.approx(x, rel=1e-12) for d, x in got[1].items()} and counted[1] < counted[0]


def test_suffix_tree_sums_to_one():
    """After any context the chances of all tokens, unknown ones together, add up to 1."""
    training = ["a b c a b d a b c", "a b c a b c", "d a b"] * 5
    _, tree, chance = brute.suffix_tree(training, 3, 2, 2, 1.5, 0.75, 1.0)
    words = {w for t in training for w in brute.tokens(t)}
    assert max(map(len, tree)) > 1
    for c in [*tree, ("c", "a"), ("x",), ("", "a")]:
        assert sum(chance(c, w) for w in [*words, "unknown"]) == pytest.approx(1.0)


def test_word_hashes_over_blocks(monkeypatch):
    """Words that run over blocks hash as they do whole, and streams keep the borders of texts."""
    import numpy as np

    from meshloom.llm import hashing

    monkeypatch.setattr(hashing, "BLOCK", 16)
    texts = [b"ab " * 40, b"x" * 500, b" " + b"y" * 16 + b" ", b"z" * 32 + b" q\n\nAB", None, b"", b"q ab", b"\t", b"one two three four five six"]
    whole = {}
    for t in texts:
        words = (t or b"").lower().split()
        hashes = hashing.word_hashes(t, lower=True).tolist()
        assert len(words) == len(hashes)
        assert all(whole.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(whole.values())) == len(whole)
    end = np.uint64(1)
    got = [(int(h), int(d)) for hs, ds in hashing.streams(texts, end) for h, d in zip(hs, ds, strict=True)]
    assert got == [(h, i) for i, t in enumerate(texts) for h in [*(whole[w] for w in (t or b"").lower().split()), 1]]


def test_buckets_add_up():
    """Packed lists of buckets add up to the counts, up to 255, with gaps of any size."""
    import numpy as np

    from meshloom.llm.suffix_tree import Buckets

    r = np.random.default_rng(3)
    for tokens in (1, 5_000, 1 << 22):
        b = Buckets(tokens)
        want, total = {}, {}
        for n in (0, 1, 3, 3_000):
            at = np.unique(r.integers(0, 1 << b.bits, n)).astype(np.uint64)
            times = r.integers(1, 400, len(at))
            for k, t in zip(at.tolist(), times.tolist(), strict=True):
                want[k] = min(255, want.get(k, 0) + t)
            for s, deltas, counts in b.packed(at, times):
                b.added(total.setdefault(s, np.zeros(b.width, np.uint8)), deltas, counts)
        assert {s * b.width + int(i): int(x[i]) for s, x in total.items() for i in np.flatnonzero(x)} == want


def test_filter_denies_no_key(spark):
    import numpy as np

    from meshloom.llm.hashing import Filter

    keys = np.random.default_rng(1).integers(-(2**63), 2**63, 5000)
    made = Filter.from_table(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert made.has(keys.view(np.uint64)).all() and (made.bits == Filter.of(keys.view(np.uint64)).bits).all()
    assert made.has(np.random.default_rng(2).integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.05
    assert not Filter.from_table(spark.createDataFrame([], "k long"), "k").has(keys.view(np.uint64)).any()


def test_mixing(spark, tables, documents):
    got = rows(spark, "op4_mixing", tables)
    assert {r.doc_id: r.size for r in got} == {d: len(brute.WORD.findall(t or "")) for d, t in documents}
    assert all(r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-9 for r in got)
    total, targets = sum(r["size"] for r in got), {(r.source_size, r.target) for r in got}
    assert sum(t for _, t in targets) == pytest.approx(1.5 * total)
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows(spark, "op4_mixing", tables)))


def test_substring_dedup(spark, tables, documents):
    assert by_id(rows(spark, "op5_substring_dedup", tables), "n_words", "n_removed", "kept_sha256") == brute.dedup(documents)


@pytest.mark.parametrize("shard_words", [0, 300])
def test_substring_dedup_large_shards(spark, tables, documents, shard_words):
    from meshloom.llm import substring_dedup as sd

    docs = common.table(spark, tables, "documents")
    got = by_id(sd.dedup(docs, settings=sd.Settings(piece=20, shard_words=shard_words)).collect(), "n_words", "n_removed", "kept_sha256")
    assert got == brute.dedup(documents)


def test_substring_dedup_long_texts(spark):
    """Texts cut in stretches, with a word longer than a block of hashing."""
    from meshloom.llm import substring_dedup as sd

    say = lambda k, n: " ".join(f"{k}w{i * i % 997}" for i in range(n))
    texts = [say("a", 900), "x" * 600_000 + " " + say("a", 400), say("b", 70) + " " + say("a", 900), say("b", 120), "y" * 300_000]
    docs = list(enumerate(texts))
    got = by_id(sd.dedup(spark.createDataFrame(docs, "doc_id long, text string"), settings=sd.Settings(stretch=100)).collect(), "n_words", "n_removed", "kept_sha256")
    assert got == brute.dedup(docs)
    with pytest.raises(TypeError, match="integer"):
        sd.dedup(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_substring_dedup_with_changed_parallelism(spark, tables, documents, tmp_path):
    """The last job reads its files in other partitions than the jobs before."""
    from meshloom.llm import substring_dedup as sd

    common.table(spark, tables, "documents").repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism")}
    try:
        df = sd.dedup(common.table(spark, str(tmp_path), "documents"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "13")
        got = by_id(df.collect(), "n_words", "n_removed", "kept_sha256")
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == brute.dedup(documents)


def test_decontaminate(spark, tables, documents):
    items = [(r.item_id, r.text) for r in common.table(spark, tables, "benchmark").collect()]
    want = brute.decontaminate(documents, items)
    assert by_id(rows(spark, "op6_decontaminate", tables), "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


def test_decontaminate_one_word():
    """A text and an item that repeat one word take time in proportion to their length."""
    import time

    from meshloom.llm import decontaminate as dc

    began = time.perf_counter()
    hit, items = dc.Automaton([("a", [b"x"] * 100_000), ("b", [b"x"] * 20)], 13).stream([b"y", *[b"x"] * 100_000])
    assert not hit[0] and hit[1:].all() and items == {0, 1}
    assert time.perf_counter() - began < 20


def test_decontaminate_in_shards(spark, tables, documents):
    from meshloom.llm import decontaminate as dc

    docs, items = common.table(spark, tables, "documents"), common.table(spark, tables, "benchmark")
    want = brute.decontaminate(documents, [(r.item_id, r.text) for r in items.collect()])
    settings = dc.Settings(shard_words=5)
    assert by_id(dc.hits(docs, items, ["doc_id"], settings=settings).collect(), "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    kept = {r.doc_id for r in dc.drop_contaminated(docs, items, settings=settings).collect()}
    assert kept == {d for d, x in want.items() if not x[-1]} == {r.doc_id for r in dc.drop_contaminated(docs, items).collect()}


def test_simhash(spark, tables, documents):
    assert by_id(rows(spark, "op7_simhash", tables), "fingerprint", "component_id") == brute.simhash(documents)


def test_simhash_small_tiles(spark, tables):
    """Random fingerprints around a few centres, with tiles far smaller than their buckets."""
    import random

    from meshloom.llm import simhash as sh

    r = random.Random(1)
    fps = set()
    for _ in range(5):
        centre = r.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    prints = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {row.fp: row.component_id for row in sh.with_components(prints, "doc_id", sh.Settings(tile=7)).collect()}
    parent = {f: f for f in signed}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in signed:
        for b in signed:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2:
                parent[root(a)] = root(b)
    least = {}
    for i, f in enumerate(signed):
        least.setdefault(root(f), i)
    assert got == {f: least[root(f)] for f in signed}


def test_simhash_keeps_one_of_each(spark):
    """One row of each component stays, whatever its doc_ids: null, or also on texts of other components."""
    from meshloom.llm import simhash as sh

    say = lambda k: " ".join(f"word{k}x{i}" for i in range(60))
    ids = {
        "a": [None, None], "b": [None], "c": [None],  # only null ids
        "d": [3, 5, None], "e": [5],  # 5 on a copy of d and on a text of its own
        "f": [7, 7], "g": [9, 8], "h": [8],
    }
    docs = spark.createDataFrame([(d, say(k), k) for k, ds in ids.items() for d in ds], "doc_id long, text string, rid string").repartition(3)
    got = sh.keep_first(docs)
    assert got.columns == docs.columns
    assert sorted((r.rid, r.doc_id) for r in got.collect()) == [("a", None), ("b", None), ("c", None), ("d", 3), ("e", 5), ("f", 7), ("g", 8), ("h", 8)]


def test_quality(spark, tables, documents):
    import zstandard

    from meshloom.llm.quality_rules import Limits
    from tests.llm.test_pipeline import good

    got = rows(spark, "op8_quality_rules", tables)
    assert {r.doc_id: r.kept for r in got} == {d: good(t) for d, t in documents}
    ratio = lambda b: len(b) / len(zstandard.ZstdCompressor(level=Limits().level).compress(b)) if b else 0.0
    for d, t in documents:
        raw, r = (t or "").encode(), next(r for r in got if r.doc_id == d)
        parts = [ratio(raw[i : i + Limits().chunk]) for i in range(0, max(1, len(raw)), Limits().chunk)]
        assert (r.ratio, r.chunk_ratio_low, r.chunk_ratio_high, r.n_chunks) == (ratio(raw), min(parts), max(parts), len(parts))
    want = {d: brute.quality(t) for d, t in documents}
    assert by_id(got, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert not any(r.kept and r.base_failed for r in got)


def test_licenses(spark, tables, documents):
    got = rows(spark, "op9_license_scan", tables)
    assert by_id(got, "n_words", "n_base", "first_word", "last_word", "base_labels") == {d: brute.phrases(t) for d, t in documents}
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels for r in got)


def license_spans(text, given):
    """All matches of the rules (start, end, label, priority, confidence), and those kept: taken in order, one goes if a kept one suppresses it."""
    import re

    found = [(m.start(), m.end(), r.label, r.priority, r.confidence) for r in given for m in re.finditer(r.pattern, text or "", re.ASCII) if all(k in text.lower() for k in r.keys)]
    live: list = []
    # by priority; within one, longer ones that begin first come first
    for x in sorted(found, key=lambda x: (x[3], x[0], -x[1], x[2])):
        a, b, _, p, _ = x
        if not any((q < p and c < b and a < d) or (q == p and c <= a and b <= d) for c, d, _, q, _ in live):
            live.append(x)
    return found, live


LICENSE_TEXTS = (
    "SPDX-License-Identifier: MIT\nLicensed under the Apache License, Version 2.0. Apache Licence 2.0; BSD 3-Clause, GNU General Public License v2 (c) Copyright (c) 2020. All rights reserved. CC BY-SA 3.0",
    None,
    "nothing",
    "The Artistic License 2.0, the artistic license. creativecommons.org/licenses/by-sa/4.0 and licensed under CC BY-SA 4.0 and CC BY-SA and cc-by-nc-nd-2.5 All rights reserved all\nrights reserved",
    "This is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published, either version 3 of the License, or (at your option) any later version, WITHOUT ANY WARRANTY",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. Permission is hereby granted, free of charge, to deal in the Software without restriction, to copy, modify, merge, publish, distribute, sublicense. zlib License; libpng license zlib/libpng license',
    "All rights reserved. Apache License 2.0. " * 60,
)


def test_license_chains(spark):
    """What is hidden hides nothing."""
    from meshloom.llm import license_scan as ls

    given = [ls.Rule(x, (x.lower(),), p, k, 0.5) for k, (x, p) in enumerate([("a1", "a1 b1"), ("b1", "b1 c1"), ("c1", "c1 d1"), ("d1", "d1 e1")])]
    given.append(ls.Rule("e1", ("e1",), "e1|d1", 3, 0.4))
    for text, want in (("a1 b1 c1 d1 e1", "a1,c1,e1"), ("b1 c1 d1 e1", "b1,d1"), ("c1 d1 e1 d1 e1", "c1,d1,e1"), ("", "")):
        assert ls.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"], given=given).first().labels == want
        assert ",".join(sorted({x[2] for x in license_spans(text, given)[1]})) == want


def test_license_detections(spark, documents):
    """Against Python's re, match by match, with suppression told pair by pair; and labels and score of whole tables."""
    from meshloom.llm import license_scan as ls

    given = ls.rules()
    rows_ = [*enumerate(LICENSE_TEXTS), *((100 + d, t) for d, t in documents)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    got: dict = {}
    for r in ls.spans(df, ["doc_id"]).where("start IS NOT NULL").collect():
        got.setdefault(r.doc_id, []).append(r)
    scanned = {r.doc_id: r for r in ls.scan(df, ["doc_id"]).collect()}
    for d, t in rows_:
        found, live = license_spans(t, given)
        mine = got.get(d, [])
        assert sorted((r.start, r.end, r.label, r.priority) for r in mine) == sorted(x[:4] for x in found), d
        assert {(r.start, r.end, r.label) for r in mine if not r.hidden} == {x[:3] for x in live}, d
        base = set(filter(None, brute.phrases(t)[-1].split(",")))
        assert scanned[d].labels == ",".join(sorted(base | {x[2] for x in live}))
        assert scanned[d].score == max([x[4] for x in live] + [0.5 * bool(base)])
    assert set(scanned[0].labels.split(",")) >= {"mit", "apache-2.0", "bsd-3-clause", "gpl-2.0", "cc-by-sa-3.0", "reserved"}


def test_license_repeats_are_linear(spark):
    """A notice that repeats: ten times the text takes no more than some thirty times the time."""
    import time

    from meshloom.llm import license_scan as ls

    took = []
    for n in (2_000, 20_000):
        df = spark.createDataFrame([(1, "All rights reserved, Apache License 2.0; " * n)], "doc_id long, text string")
        began = time.perf_counter()
        row = ls.scan(df, ["doc_id"]).collect()[0]
        took.append(time.perf_counter() - began)
        assert (row.n_base, row.labels) == (n, "apache-2.0,reserved")
    assert took[1] < 30 * took[0] + 5


def examples(pattern):
    """Texts that a rule's pattern matches: each alternative, each optional part with and without, spaces as newlines."""
    from itertools import product
    from re import _constants as c
    from re import _parser as parser

    def of(tree):
        out = [""]
        for op, x in tree:
            if op is c.LITERAL:
                some = [chr(x)]
            elif op is c.IN:
                first = next((y for y in x if y[0] is not c.NEGATE), x[0])
                some = ["\n"] if first == (c.CATEGORY, c.CATEGORY_SPACE) else ["1" if first[0] is c.CATEGORY and first[1] is c.CATEGORY_DIGIT else "x" if x[0][0] is c.NEGATE or first[0] is c.CATEGORY else chr(first[1] if first[0] is c.LITERAL else first[1][0])]
            elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
                some = [e * n for n in sorted({x[0], max(x[0], min(x[1], 1))}) for e in of(x[2])]
            elif op is c.SUBPATTERN:
                some = of(x[3])
            elif op is c.BRANCH:
                some = [e for b in x[1] for e in of(b)]
            else:
                some = ["x"] if op in (c.ANY, c.NOT_LITERAL) else [""]
            out = [a + b for a, b in product(out, dict.fromkeys(some))]
        return out

    return of(parser.parse(pattern))


def test_license_keys(spark):
    """What a rule's pattern matches holds the rule's keys and passes the gate of all rules."""
    import re

    from meshloom.llm import license_scan as ls

    one = {}
    for r in ls.rules():
        held = [x for x in examples(r.pattern) if re.search(r.pattern, x)]
        assert held, r
        for x in held:
            assert all(k in x.lower() for k in r.keys), (r, x)
        one.setdefault(r.label, held[-1])
    wrapped = {"permissive": "Permission is hereby\ngranted, free of charge", "permissive ": "Redistribution and use in source and binary forms, with or\nwithout", "terms": "terms\nof use", "public-domain": "into the public\ndomain", "mit": "the MIT\nLicense", "mit ": "licensed\nunder MIT\nLicense", "cc0-1.0": "Creative Commons\nZero", "proprietary": "may not be copied", "proprietary ": "may not be\ndistributed", "reserved": "All rights\nreserved"}
    rows = [(k.strip(), x) for k, x in [*one.items(), *wrapped.items()]]
    got = ls.scan(spark.createDataFrame([(i, x) for i, (_, x) in enumerate(rows)], "doc_id long, text string"), ["doc_id"]).collect()
    assert {r.doc_id for r in got if rows[r.doc_id][0] not in r.labels.split(",")} == set()
    assert next(r.score for r in got if rows[r.doc_id] == ("mit", wrapped["mit "])) == 0.9


def test_secrets(spark, tables, documents):
    got = rows(spark, "op10_secret_scan", tables)
    assert by_id(got, "n_assign", "n_access", "n_hex", "base_sha256") == {d: brute.secrets(t) for d, t in documents}
