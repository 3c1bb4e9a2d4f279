"""Greedy longest-match token counts in one pass over each word, without building the pieces.

The vocabulary's pieces form a trie.  Each node has a failure link, to the node that is left after the
longest-match pieces of its string are popped, and the number of pieces popped on the way; both are
computed once, breadth first.  A word is then read symbol by symbol: follow edges, and where
there is none follow failure links and add their counts.  A word's last byte is a symbol of its own, as is the last byte
of a piece that ends a word: such pieces match at the end only, no other piece reaches it, and no match can leave
a word's end alone.  A vocabulary with all bytes, inside and at the end, covers every word.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8 bytes.  A word that no pieces cover
counts as one (unknown) token.  Counts of frequent words are kept in a bounded cache per worker.

Cases: null or empty texts have no words; repeated rows are counted each; very long words need memory
for their own bytes alone; an empty table gives an empty result; the other columns come back in ``row``.
"""

from __future__ import annotations

import json
import threading
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.llm.byte_bpe import byte_alphabet
from sparksignal.llm.chunks import row_of
from sparksignal.llm.packing import read_tokenizer

END = 256  # marks a piece that ends a word; added to the last byte of a word
CACHE_WORDS, LONG_WORD = 200_000, 64
BATCH_TEXTS = 256


def vocabulary(tokenizer_path: str, word_end: str = "</w>") -> list[tuple[int, ...]]:
    """Pieces as byte symbols; ``END`` last where the piece ends a word."""
    alphabet, out = byte_alphabet(), []
    for piece in json.loads(read_tokenizer(tokenizer_path))["model"]["vocab"]:
        ends = piece.endswith(word_end) and piece != word_end
        body = piece[:-len(word_end)] if ends else piece
        if all(c in alphabet for c in body):
            out.append((*(alphabet[c] for c in body), *([END] if ends else [])))
    return out


class LongestMatch:
    """Trie, failure links and popped-piece counts."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.edges: list[dict[int, int]] = [{}]
        is_piece = [False]
        for p in pieces:
            at = 0
            for c in (*p[:-2], p[-2] + END) if p[-1:] == (END,) else p:
                nxt = self.edges[at].get(c)
                if nxt is None:
                    nxt = self.edges[at][c] = len(self.edges)
                    self.edges.append({})
                    is_piece.append(False)
                at = nxt
            is_piece[at] = at != 0
        self.link, self.popped = [-1] * len(self.edges), [0] * len(self.edges)
        todo = deque([0])
        while todo:
            v = todo.popleft()
            for c, u in self.edges[v].items():
                todo.append(u)
                if is_piece[u]:
                    self.link[u], self.popped[u] = 0, 1
                    continue
                z, n = self.link[v], self.popped[v]
                while z >= 0 and c not in self.edges[z]:
                    n += self.popped[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[u], self.popped[u] = self.edges[z][c], n

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; 0 if the word cannot be covered."""
        edges, link, popped = self.edges, self.link, self.popped
        v = n = 0
        for c in (*word[:-1], word[-1] + END):
            nxt = edges[v].get(c)
            while nxt is None:
                n += popped[v]
                v = link[v]
                if v < 0:
                    return 0
                nxt = edges[v].get(c)
            v = nxt
        while v:
            n += popped[v]
            v = link[v]
            if v < 0:
                return 0
        return n


class Counts:
    """Counts by word with two generations of cached words; one instance per worker and vocabulary."""

    _own = threading.local()

    def __init__(self, pieces):
        self.automaton, self.young, self.old = LongestMatch(pieces), {}, {}

    @classmethod
    def of(cls, key, pieces) -> Counts:
        if getattr(cls._own, "key", None) != key:
            cls._own.key, cls._own.got = key, cls(pieces)
        return cls._own.got

    def text(self, text: bytes) -> tuple[int, int, int]:
        """(words, tokens, unknown words) of a text."""
        tally = Counter(text.lower().split())  # bytes: ASCII lower case, ASCII white space
        words = tokens = unknown = 0
        for w, n in tally.items():
            c = self.young.get(w)
            if c is None:
                c = self.old.get(w)
                if c is None:
                    c = self.automaton.count(w)
                if len(w) <= LONG_WORD:
                    self.young[w] = c
            words += n
            tokens += n * (c or 1)
            unknown += 0 if c else n
        if len(self.young) > CACHE_WORDS:
            self.young, self.old = {}, self.young
        return words, tokens, unknown


def token_counts(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``row`` (struct of the other columns), ``n_words``, ``n_tokens``, ``n_unknown``."""
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer_path))  # a vocabulary: bounded by read_tokenizer
    src = docs.select(row_of(docs, text_col), F.col(f"`{text_col}`").cast("binary").alias("t"))
    names = ("n_words", "n_tokens", "n_unknown")
    schema = T.StructType([src.schema["row"], *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches):
        counts = Counts.of(tokenizer_path, pieces.value)
        for b in batches:
            got = [counts.text(t.as_py() or b"") for t in b.column(1)]
            cols = list(zip(*got)) if got else [[], [], []]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols]], ["row", *names])

    return src.mapInArrow(run, schema)
