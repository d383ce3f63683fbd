"""Plain versions of the operators, straight from their contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def greedy(vocabulary, text):
    """Pieces of every word of text, longest first, with the start mark in front."""
    longest, n = max(map(len, vocabulary)), 0
    for w in WORD.findall(text or ""):
        rest = ("▁" + w).encode()
        while rest:
            k = next(k for k in range(min(longest, len(rest)), 0, -1) if rest[:k] in vocabulary)
            rest, n = rest[k:], n + 1
    return n


def dedup(docs, window=50):
    """doc_id, text rows (distinct doc_ids) to doc_id: (n_words, n_removed, kept_sha256)."""
    first = {}
    words = {d: WORD.findall(t or "") for d, t in docs}
    for d, w in words.items():
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(d, first.get(k, d))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def decontaminate(docs, items, window=13):
    windows = {}
    for name, text in items:
        w = PLAIN.findall(lower(text))
        if w:
            for i in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[i : i + window]), set()).add(str(name))
    sizes = {len(k) for k in windows}
    out = {}
    for d, text in docs:
        w, hit, names = PLAIN.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    names |= windows[k]
        out[d] = (len(w), len(hit), len(names), sha(",".join(sorted(names))), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def fingerprint(text):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, radius=2):
    """doc_id: (fingerprint, smallest linked doc_id)."""
    fps = {d: fingerprint(t) for d, t in docs}
    kinds = sorted(set(fps.values()))
    parent = {f: f for f in kinds}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(kinds):
        for b in kinds[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[root(b)] = root(a)
    least = {}
    for d, f in fps.items():
        least[root(f)] = min(d, least.get(root(f), d))
    return {d: (f"{f:016x}", least[root(f)]) for d, f in fps.items()}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORD.findall(text)
    times = Counter(zip(w, w[1:], w[2:], strict=False))
    repeat = {j for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, seen = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(repeat), len(w) < 50 or 100 * len(repeat) > 50 * len(w)


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def phrases(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    w = PLAIN.findall(lower(text))
    at, labels = [], set()
    for p, label in PHRASES.items():
        k = p.split()
        found = [i for i in range(len(w)) if w[i : i + len(k)] == k]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256."""
    found = [(m.start(), i, m.end(), kind) for i, (kind, p, good) in enumerate(KINDS) for m in p.finditer(text or "") if good(m)]
    counts = Counter(k for *_, k in found)
    return *(counts[k] for k, *_ in KINDS), sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found)))


def tokens(text):
    return [*WORD.findall(lower(text)), ""]


def suffix_tree(training, depth, context_least, least, ratio, discount, min_bits):
    """A function from a text to (base score, score), and the contexts of the tree, by plain counting over the training texts."""
    streams = [["", *tokens(t)] for t in training]
    words = Counter(w for s in streams for w in s[1:])
    floor = sum(words.values()) + 0.5 * (len(words) + 1)
    root = lambda w: (words[w] + 0.5) / floor
    tree = {}  # context: what it leaves, chances of its kept continuations

    def chance(context, w):
        for k in range(len(context)):
            if context[k:] in tree:
                left, own = tree[context[k:]]
                return own.get(w, 0.0) + left * chance(context[k + 1 :], w)
        return root(w)

    often = {(w,): n for w, n in words.items() if n >= least}
    for k in range(1, depth + 1):
        after, grown = {}, {}
        for s in streams:
            for i in range(k, len(s)):
                c = tuple(s[i - k : i])
                if "" not in c[1:]:
                    after.setdefault(c, Counter())[s[i]] += 1
        for c, nexts in after.items():
            total = sum(nexts.values())
            kept = {w: n for w, n in nexts.items() if n >= least and often.get(c, 0) >= context_least and n >= ratio * total * chance(c[1:], w)}
            own = {w: (n - discount) / total for w, n in kept.items()}
            left = 1 - sum(own.values())
            bits = sum(n * math.log2((own[w] + left * chance(c[1:], w)) / chance(c[1:], w)) for w, n in kept.items()) + (total - sum(kept.values())) * math.log2(max(left, 1e-12))
            if kept and bits >= min_bits:
                grown[c] = (left, own)
        tree.update(grown)
        often = {(*c, w): n for c, nexts in after.items() for w, n in nexts.items() if n >= least and often.get(c, 0) >= context_least}

    def score(text):
        s = ["", *tokens(text)]
        base = full = 0.0
        for i in range(1, len(s)):
            c = tuple(s[max(0, i - depth) : i])
            while len(c) > 1 and "" in c[1:]:
                c = c[1:]
            base += math.log10(root(s[i]))
            full += math.log10(chance(c, s[i]))
        return base, full

    return score, tree, chance
