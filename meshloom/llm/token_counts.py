"""Token counts: greedy longest-match pieces, counted by a linear automaton that builds no pieces.

The vocabulary is a trie over bytes; a word is matched with its start mark in front. Each trie node has a failure link to the
node that is reached once the longest pieces in front of it are popped, and the number of pieces popped on the way, so a word
takes as many steps as it has bytes, plus its failures, and only counts are added up. All single bytes are pieces (byte
fallback), so every word can be cut. Counts of words seen before are kept in a table of bounded size, which changes no count.

Defined cases: a null text counts as empty and has no tokens; words are separated by ASCII white space and matched whole,
whatever their length; repeated rows count alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import once_a_worker, per_row

#: start of a word, in vocabularies of this kind
MARK = "▁".encode()


@dataclass(frozen=True)
class Settings:
    #: a sentencepiece model file whose pieces are the vocabulary; its own segmentation is not used
    model: str = "/opt/tokenizers/piece_bpe_32k.model"
    #: words whose counts a task keeps
    kept: int = 1 << 18


def pieces(model: str) -> list[bytes]:
    """The ordinary pieces of a model file as bytes, and all single bytes."""
    import sentencepiece

    if not Path(model).is_file():
        raise FileNotFoundError(f"no vocabulary at {model}: name one by Settings(model=...)")
    p = sentencepiece.SentencePieceProcessor(model_file=model)
    plain = [p.id_to_piece(i).encode() for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
    return sorted({*plain, *(bytes([b]) for b in range(256))})


class Automaton:
    """edges[node][byte], failure links and the number of pieces popped along each."""

    def __init__(self, vocabulary: list[bytes]):
        self.edges: list[dict[int, int]] = [{}]
        is_piece, before, depth = [False], [(0, 0)], [0]
        for piece in vocabulary:
            node = 0
            for b in piece:
                if b not in self.edges[node]:
                    self.edges[node][b] = len(self.edges)
                    self.edges.append({})
                    is_piece.append(False)
                    before.append((node, b))
                    depth.append(depth[node] + 1)
                node = self.edges[node][b]
            is_piece[node] = True
        self.fail, self.popped = [-1] * len(self.edges), [0] * len(self.edges)
        for node in sorted(range(1, len(self.edges)), key=depth.__getitem__):
            if is_piece[node]:
                self.fail[node], self.popped[node] = 0, 1
                continue
            # the string of node is its parent's and one byte more: pop the parent's longest pieces until the byte fits
            at, b = before[node]
            n, at = self.popped[at], self.fail[at]
            while at >= 0 and b not in self.edges[at]:
                n += self.popped[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.popped[node] = self.edges[at][b], n

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match cut of word."""
        edges, fail, popped = self.edges, self.fail, self.popped
        n = node = 0
        for b in word:
            to = edges[node].get(b)
            while to is None:
                n += popped[node]
                node = fail[node]
                to = edges[node].get(b)
            node = to
        while node:
            n += popped[node]
            node = fail[node]
        return n


class Counts(dict):
    """Pieces of a word, kept up to a bound."""

    def __init__(self, automaton: Automaton, kept: int):
        self.of, self.kept = automaton.count, kept

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.kept:
            self.clear()
        n = self[word] = self.of(MARK + word)
        return n


def count(docs: DataFrame, keep: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The columns of ``keep`` with n_words, n_tokens and n_bytes, one row for each row of docs."""
    # a fixed public vocabulary, so its size does not follow the data
    vocabulary = docs.sparkSession.sparkContext.broadcast(pieces(settings.model))

    def make():
        counts, n = once_a_worker("token_counts", vocabulary.value, lambda v: Counts(Automaton(v), settings.kept)), len(keep)

        def f(*row):
            words = row[n].split() if row[n] else []
            return (*row[:n], len(words), sum(map(counts.__getitem__, words)), len(row[n] or b""))

        return f

    schema = T.StructType([*(docs.schema[c] for c in keep), *T.StructType.fromDDL("n_words long, n_tokens long, n_bytes long")])
    return per_row(docs.select(*keep, F.col(text).cast("binary").alias("__text")), make, schema)
