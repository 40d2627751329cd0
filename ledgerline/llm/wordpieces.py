"""Token counts: greedy longest-match word pieces by a linear automaton.

The vocabulary is a trie. Where a word leaves the trie, the failure link says
which node stands for what remains after the longest pieces have been taken
off, and the number of pieces taken off is precomputed; so a word is read once
and its count is a sum of those numbers: no piece is ever built. ``ends``
holds the pieces of a node's whole string, for the word's end.

A vocabulary may have other pieces for the continuation of a word (``prefix``,
for example ``##``); without one, the same pieces serve everywhere.

Cases: null and empty texts have no words and no pieces; a word that cannot be
split into pieces counts as one (the unknown token); texts are whole; repeated
rows are each counted; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from ledgerline.llm.byte_bpe import char_classes, parse_ranks, read_ranks, split_words
from ledgerline.llm.textblock import kept, map_text, prefix_sums, quoted, span_hash, utf8

MAX_WORDS = 500_000
NONE = -1


class PieceCounter:
    def __init__(self, pieces, prefix: bytes = b""):
        """``pieces``: the vocabulary as bytes; with ``prefix``, pieces that start
        with it continue a word and the others start one."""
        self.child: list[dict[int, int]] = [{}, {}]
        self.is_piece = [False, False]
        self.start, self.inner = 0, 1 if prefix else 0
        for p in pieces:
            node = self.start
            if prefix and p.startswith(prefix) and len(p) > len(prefix):
                node, p = self.inner, p[len(prefix):]
            for c in p:
                nxt = self.child[node].get(c)
                if nxt is None:
                    nxt = self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.is_piece.append(False)
                node = nxt
            if p:
                self.is_piece[node] = True
        self._link()

    def _link(self) -> None:
        n = len(self.child)
        self.fail = [NONE] * n   # node of what remains once pieces are taken off
        self.pops = [0] * n      # how many pieces that takes off
        self.ends = [NONE] * n   # pieces of the node's whole string; NONE: it has none
        level = [self.start] + ([self.inner] if self.inner else [])
        for r in level:
            self.ends[r] = 0
        # by depth: links of a node need those of shallower ones
        while level:
            below = []
            for u in level:
                for c, v in self.child[u].items():
                    if self.is_piece[v]:
                        self.fail[v], self.pops[v], self.ends[v] = self.inner, 1, 1
                    else:
                        z, k = self.fail[u], self.pops[u]
                        while z != NONE and c not in self.child[z]:
                            k += self.pops[z]
                            z = self.fail[z]
                        if z != NONE:
                            w = self.child[z][c]
                            self.fail[v], self.pops[v] = w, k
                            if self.ends[w] != NONE:
                                self.ends[v] = k + self.ends[w]
                    below.append(v)
            level = below

    def count(self, word: bytes) -> int:
        """Greedy longest-match pieces of the word; 1 if it cannot be split."""
        node, n = self.start, 0
        child, fail, pops = self.child, self.fail, self.pops
        for c in word:
            nxt = child[node].get(c)
            while nxt is None:
                n += pops[node]
                node = fail[node]
                if node == NONE:
                    return 1
                nxt = child[node].get(c)
                if nxt is None and node == self.inner:
                    return 1
            node = nxt
        last = self.ends[node]
        return n + last if last != NONE else 1


def _counter(data: bytes):
    return kept(("wordpieces", hash(data)), lambda: (PieceCounter(parse_ranks(data)), char_classes(), {}))


def count_pieces(docs: DataFrame, vocabulary_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_pieces and the pieces of its longest-split
    word (max_pieces). The vocabulary file (base64 piece and rank a line) is size-checked
    and broadcast."""
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary_path))

    def setup():
        counter, classes, known = _counter(data.value)

        def work(texts: pa.Array) -> list:
            buf, off = utf8(texts)
            n = len(texts)
            s, e = split_words(buf, off, classes)
            if not len(s):
                return [np.zeros(n, np.int64)] * 3
            if len(known) > MAX_WORDS:
                known.clear()
            uniq, where, back = np.unique(span_hash(prefix_sums(buf), s, e), return_index=True, return_inverse=True)
            uniq = uniq.tolist()
            raw = buf.tobytes()
            got = list(map(known.get, uniq))
            for i, g in enumerate(got):
                if g is None:
                    w = where[i]
                    got[i] = known[uniq[i]] = counter.count(raw[s[w]:e[w]])
            pieces = np.array(got, np.int64)[back]
            at = np.searchsorted(s, off)
            sums = np.append(0, np.cumsum(pieces))[at]
            most = np.zeros(n, np.int64)
            np.maximum.at(most, np.repeat(np.arange(n), np.diff(at)), pieces)
            return [pa.array(x) for x in (np.diff(at), np.diff(sums), most)]
        return work

    fields = [StructField(c, LongType()) for c in ("n_words", "n_pieces", "max_pieces")]
    return map_text(docs.select(quoted(id).alias("doc_id"), quoted(text).alias("text")), "text", None, fields, keep=["doc_id"], limit=1 << 20, setup=setup)
