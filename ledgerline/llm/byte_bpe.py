"""Byte-level BPE encoding and decoding with a lazily determinised transducer.

The merges are compiled into a nondeterministic transducer over bytes: a
hypothesis is (place in the vocabulary trie, last token, tokens not yet
emitted). Completing a token is allowed only if it may stand next to the last
one, i.e. no merge across their border would have come before the merges
inside them; exactly one hypothesis of a word is complete at its end, and it is
the result of the merges. Subsets of hypotheses are the states of a
deterministic transducer, built when first reached; what all hypotheses of a
subset agree on is emitted at once, so the lookahead is bounded by the longest
token. Decoding feeds token bytes to an incremental UTF-8 decoder.

Cases: null and empty texts have no tokens; a text of any length is encoded
whole, in pieces; repeated rows and ties are kept row by row; an empty table
gives an empty result; extra columns are kept unless they have the name of an
added one.
"""

from __future__ import annotations

import base64
import codecs
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from ledgerline.llm.textblock import kept, map_text, prefix_sums, span_hash, utf8

#: Limits of what a worker keeps: words (in each of two generations), determinised states, token pairs.
MAX_WORDS, MAX_STATES, MAX_PAIRS = 250_000, 80_000, 200_000
SLICE = 1 << 20
MAX_VOCABULARY_BYTES = 64 << 20
NEVER = 1 << 62
_DEAD = (None, ())


def read_ranks(path: str) -> bytes:
    """The rank file's bytes; its size is checked, as every executor gets them."""
    if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def merge_word(word: bytes, ranks: dict[bytes, int], below: int = NEVER) -> list[bytes]:
    """Plain merging of the lowest-ranked pair under ``below``, leftmost first."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
        if rank >= below:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for t, r in ranks.items():
            node = 0
            for c in t:
                nxt = self.child[node].get(c)
                if nxt is None:
                    nxt = self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = r
        self.edges: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((0, -1, ()),)
        self.ids = {start: 0}
        self.subset = [start]
        self.step: list[dict[int, tuple]] = [{}]

    def _spines(self, t: int):
        """For the merges that made ``t``: its pieces along the left and the right
        edge, smallest first, each with the rank of the merge that absorbs it.
        None if merging never yields ``t``."""
        got = self.edges.get(t, 0)
        if got == 0:
            word = self.bytes_of[t]
            if len(word) == 1:
                got = ([(word, NEVER)], [(word, NEVER)])
            else:
                parts = merge_word(word, self.ranks, t)
                got = None
                if len(parts) == 2:
                    a, b = (self._spines(self.ranks[p]) for p in parts)
                    if a and b:
                        got = (a[0][:-1] + [(parts[0], t), (word, NEVER)], b[1][:-1] + [(parts[1], t), (word, NEVER)])
            self.edges[t] = got
        return got

    def may_follow(self, a: int, b: int) -> bool:
        """True if merging a's bytes followed by b's gives a, b."""
        right = self._spines(b)
        if right is None:
            return False
        if a < 0:
            return True
        key = a << 24 | b
        got = self.pairs.get(key)
        if got is None:
            xs, ys, i, j = self._spines(a)[1], right[0], 0, 0
            while True:
                (x, x_end), (y, y_end) = xs[i], ys[j]
                rank = self.ranks.get(x + y, NEVER)
                if rank < x_end and rank <= y_end and rank != NEVER:
                    got = False
                    break
                if x_end == NEVER and y_end == NEVER:
                    got = True
                    break
                if x_end <= y_end:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            self.pairs[key] = got
        return got

    def _build(self, state: int, byte: int) -> tuple:
        nxt = []
        children, tokens, pairs = self.child, self.token, self.pairs
        for node, last, pending in self.subset[state]:
            child = children[node].get(byte)
            if child is None:
                continue
            t = tokens[child]
            if t >= 0:
                ok = pairs.get(last << 24 | t)
                if self.may_follow(last, t) if ok is None else ok:
                    nxt.append((0, t, (*pending, t)))
            if children[child]:
                nxt.append((child, last, pending))
        if not nxt:
            return _DEAD
        common = first = nxt[0][2]
        if common:
            for _, _, p in nxt:
                while common and p[:len(common)] != common:
                    common = common[:-1]
        if k := len(common):
            nxt = [(n, last, p[k:]) for n, last, p in nxt]
            common = first[:k]
        key = tuple(nxt)
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.subset)
            self.subset.append(key)
            self.step.append({})
        return to, common

    def encode_words(self, words: list[bytes]) -> Iterator[list[int]]:
        """Ids of each word; a word takes up where it leaves the one before, so
        sorted words share their common beginnings."""
        if len(self.subset) > MAX_STATES:
            self._reset()
        step, subset, ranks = self.step, self.subset, self.ranks
        path, ids_at, before, out = [0], [0], b"", []  # states and output sizes along the last word
        for word in words:
            whole = ranks.get(word)
            if whole is not None:
                yield [whole]
                continue
            k = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                k += 1
            k = min(k, len(path) - 1)
            del path[k + 1:], ids_at[k + 1:], out[ids_at[k]:]
            state = path[k]
            before = word
            for c in word[k:]:
                go = step[state].get(c)
                if go is None:
                    go = step[state][c] = self._build(state, c)
                state, emitted = go
                if state is None:
                    break
                if emitted:
                    out += emitted
                path.append(state)
                ids_at.append(len(out))
            rest = None if state is None else next((p for node, _, p in subset[state] if node == 0), None)
            if rest is None:  # no hypothesis left: merge plainly
                yield [ranks[p] for p in merge_word(word, ranks)]
            else:
                yield out + list(rest)

def char_classes() -> np.ndarray:
    """Per code point: 1 letter, 2 number, 3 white space, 0 other."""
    import regex
    points = np.delete(np.arange(0x110000, dtype="<u4"), np.s_[0xD800:0xE000])
    every = points.tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    for k, cls in enumerate((r"\p{L}+", r"\p{N}+", r"\s+"), 1):
        for m in regex.finditer(cls, every):
            out[points[m.start():m.end()]] = k
    return out


LETTER, NUMBER, SPACE = 1, 2, 3
#: Contractions of the pattern after the apostrophe (fixed values).
ONE, TWO = "stmd", ("re", "ve", "ll")


def pretokens(points: np.ndarray, borders: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the matches of
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    in all texts at once (``borders``: their n+1 offsets)."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cls = classes[points]
    cut = np.ones(n, bool)
    cut[1:] = cls[1:] != cls[:-1]
    border = np.zeros(n + 1, bool)
    border[borders] = True
    cut |= border[:-1]
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    kind = cls[start]
    first = points[start]
    space = kind == SPACE
    last_of_text = border[end]
    # a blank right before a run joins it; other white space stands alone
    before = np.where(start > 0, points[start - 1], 0)
    joins = ~space & (before == 0x20) & ~border[start]
    begin = start - joins
    # contractions: a lone apostrophe that starts a match, then given letters
    nxt = np.minimum(start + 1, n - 1)
    nxt2 = np.minimum(start + 2, n - 1)
    lone = (first == 0x27) & (end - start == 1) & ~joins & ~last_of_text
    one = lone & np.isin(points[nxt], [ord(c) for c in ONE])
    two = np.zeros(len(start), bool)
    for a, b in TWO:
        two |= lone & (points[nxt] == ord(a)) & (points[nxt2] == ord(b)) & (start + 2 < n) & ~border[nxt2]
    taken = one + 2 * (two & ~one)
    stop = end + taken
    begin[1:] += taken[:-1]
    # white space before more text: all but its last character, then that one
    # alone unless a blank joined the next run
    inner = space & ~last_of_text
    blank = np.zeros(len(start), bool)
    blank[:-1] = joins[1:]
    tail_at = end[inner & ~blank] - 1
    stop = np.where(inner, end - 1, stop)
    ok = stop > begin
    b = np.concatenate([begin[ok], tail_at])
    e = np.concatenate([stop[ok], tail_at + 1])
    order = np.argsort(b, kind="stable")
    return b[order], e[order]


def split_words(buf: np.ndarray, off: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the pretokens of all texts."""
    if not len(buf) or buf.max() < 0x80:
        return pretokens(buf, off, classes)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)  # byte offset of each code point
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    s, e = pretokens(points, np.searchsorted(lead, off), classes)
    lead = np.append(lead, len(buf))
    return lead[s], lead[e]


class Store:
    """Ids of words by fingerprint, in flat arrays."""

    def __init__(self):
        self.known: dict[int, int] = {}
        self.at = np.zeros(1 << 16, np.int64)     # word -> first id in flat
        self.size = np.zeros(1 << 16, np.int64)   # word -> number of ids
        self.flat = np.zeros(1 << 18, np.uint32)
        self.n_flat = 0

    def add(self, prints: list[int], sizes: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.known)
        need = n + len(prints)
        if need > len(self.at):
            grow = max(need, 2 * len(self.at)) - len(self.at)
            self.at, self.size = (np.append(x, np.zeros(grow, np.int64)) for x in (self.at, self.size))
        if self.n_flat + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros(max(len(ids), len(self.flat)), np.uint32))
        self.flat[self.n_flat:self.n_flat + len(ids)] = ids
        self.size[n:need] = sizes
        self.at[n:need] = self.n_flat + np.cumsum(sizes) - sizes
        self.n_flat += len(ids)
        self.known.update(zip(prints, range(n, need)))


class Encoder:
    """Splits texts by the pattern, each distinct word by the transducer; the
    ids of recent words are kept by the word's 64-bit fingerprint, in two
    generations, so that what is in use is never forgotten."""

    def __init__(self, ranks: dict[bytes, int]):
        self.fst = Transducer(ranks)
        self.classes = char_classes()
        self.young, self.old = Store(), Store()

    def _learn(self, prints: list[int], words: list[bytes]) -> None:
        ids: list[int] = []
        sizes = []
        for got in self.fst.encode_words(words):
            sizes.append(len(got))
            ids += got
        self.young.add(prints, np.array(sizes, np.int64), np.array(ids, np.uint32))

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (bytes and offsets) and their n+1 offsets."""
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if len(self.young.known) > MAX_WORDS:
            self.old, self.young = self.young, Store()
        s, e = split_words(buf, off, self.classes)
        prints = span_hash(prefix_sums(buf), s, e)
        uniq, where, back = np.unique(prints, return_index=True, return_inverse=True)
        uniq = uniq.tolist()
        young, old = self.young, self.old
        got = list(map(young.known.get, uniq))
        new = [i for i, g in enumerate(got) if g is None]
        if new:
            again = [(i, g) for i in new if (g := old.known.get(uniq[i])) is not None]
            if again:  # used again: taken over from the older generation
                g = np.array([g for _, g in again])
                young.add([uniq[i] for i, _ in again], old.size[g], gather(old.flat, old.at[g], old.size[g]))
                new = [i for i in new if uniq[i] not in young.known]
            data = buf.tobytes()
            at = where[new]
            todo = sorted(zip([data[a:b] for a, b in zip(s[at].tolist(), e[at].tolist())], [uniq[i] for i in new]))
            if todo:
                self._learn([p for _, p in todo], [w for w, _ in todo])
            got = list(map(young.known.get, uniq))
        word = np.array(got, np.int64)[back]
        ids = gather(young.flat, young.at[word], size := young.size[word])
        sums = np.append(0, np.cumsum(size))
        return ids, sums[np.searchsorted(s, off)]


def gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[at[0]:at[0]+size[0]], flat[at[1]:...], ... joined."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(at - (ends - size), size)]


class Decoder:
    """Bytes of ids; characters cut between chunks wait in the UTF-8 automaton."""

    def __init__(self, bytes_of: dict[int, bytes]):
        top = max(bytes_of, default=-1) + 1
        parts = [bytes_of.get(i, b"") for i in range(top)]
        self.size = np.array([len(p) for p in parts], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text as far as it is complete after each chunk of ids; bytes that are no
        UTF-8 come as surrogate escapes."""
        automaton = codecs.getincrementaldecoder("utf-8")("surrogateescape")
        for ids in chunks:
            yield automaton.decode(gather(self.flat, self.at[ids], self.size[ids]).tobytes())
        yield automaton.decode(b"", True)

    def decode(self, ids: np.ndarray, chunk: int = 1 << 16) -> str:
        return "".join(self.stream(ids[i:i + chunk] for i in range(0, len(ids), chunk)))


def coders(data: bytes) -> tuple[Encoder, Decoder]:
    """The worker's coders for a rank file, made once."""
    def make():
        enc = Encoder(parse_ranks(data))
        return enc, Decoder(enc.fst.bytes_of)
    return kept(("byte_bpe", hash(data)), make)


def encode_decode(docs: DataFrame, ranks_path: str, text: str = "text", keep: list[str] | None = None,
                  decode: bool = True) -> DataFrame:
    """Adds ``ids`` (packed little-endian uint32) and, with ``decode``, ``decoded``
    (the bytes read back from the ids)."""
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def setup():
        enc, dec = coders(data.value)

        def work(texts: pa.Array) -> list:
            flat, at = enc.encode(*utf8(texts))
            rows = [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            out = [pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary())]
            if decode:
                out.append(pa.array([dec.decode(r).encode("utf-8", "surrogateescape") for r in rows], pa.binary()))
            return out
        return work

    fields = [StructField("ids", BinaryType())] + ([StructField("decoded", BinaryType())] if decode else [])
    return map_text(docs, text, None, fields, keep=keep, limit=SLICE, setup=setup)


def token_digest(encoded: DataFrame, id: str = "doc_id") -> DataFrame:
    return encoded.select(F.col(id), (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
