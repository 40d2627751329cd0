"""BPE with word ends, long unsplit text by tree concatenation.

A text is cut at special tokens, normalised and split into words; each distinct
word is a sequence of symbols (bytes, the last one marked as word end). A word of
at most ``LEAF`` symbols is merged plainly. A longer one is a binary tree: its
leaves are encoded each on its own, and every two neighbours are joined by
encoding a window around the join again. The window grows on a side until it
begins (ends) with the very token that side had there; then each two adjacent
tokens of the joined sequence stand next to each other in some exact encoding,
and a sequence with that property is the encoding of the whole.

Leaves and the joins of one level do not depend on each other. ``encode_all``
works level by level over all long words of a slice and holds the tokens of these
words only.

Cases: null and empty texts have no tokens and decode to the empty text; a text
of any length is encoded whole; strings that read like special tokens are these
tokens, as in the library; repeated rows and ties are kept row by row; an empty
table gives an empty result; extra columns are kept unless they have the name of
an added one.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from ledgerline.llm.textblock import kept, map_text, quoted

#: Symbols of a leaf, tokens a side of a join starts with, words a worker keeps
#: (in each of two generations).
LEAF, WINDOW, MAX_WORDS = 32, 2, 250_000
MAX_FILE_BYTES = 64 << 20
NONE = 1 << 62
#: The pattern's contractions.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def read_model(path: str) -> bytes:
    """The tokenizer file's bytes; its size is checked, as every executor gets them."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, otherwise the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _ranges(points: Iterable[int]) -> str:
    """A character class's inside from sorted code points."""
    out, lo, hi = [], None, None
    for c in points:
        if hi is not None and c == hi + 1:
            hi = c
            continue
        if lo is not None:
            out.append((lo, hi))
        lo = hi = c
    if lo is not None:
        out.append((lo, hi))
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


class Splitter:
    """Text -> parts between special tokens -> words, as the library cuts them.

    Python's tables decide what a letter, a number or a lower-case form is; parts
    with a code point that they do not assign go to the library's own normaliser
    and splitter, whose tables may be of another Unicode version."""

    def __init__(self, data: bytes, special: list[str]):
        kinds: dict[str, list[int]] = {"L": [], "N": [], "Cn": []}
        for c in range(sys.maxunicode + 1):
            k = unicodedata.category(chr(c))
            if k[0] in kinds:
                kinds[k[0]].append(c)
            elif k == "Cn":
                kinds["Cn"].append(c)
        blank = [c for c in range(sys.maxunicode + 1) if chr(c).isspace() and not 0x1C <= c <= 0x1F]
        letter, number, space = _ranges(kinds["L"]), _ranges(kinds["N"]), _ranges(blank)
        self.words = re.compile("|".join([*map(re.escape, CONTRACTIONS), f"[{letter}]+", f"[{number}]", f"[^{space}{letter}{number}]+"])).findall
        self.ascii_words = re.compile("|".join([*map(re.escape, CONTRACTIONS), "[a-z]+", "[0-9]", r"[^\t-\r a-z0-9]+"])).findall
        self.beyond = re.compile(f"[^{_ranges(range(kinds['Cn'][0]))}]").search  # quick: above all but assigned ones
        self.unassigned = re.compile(f"[{_ranges(kinds['Cn'])}]").search
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None
        self.special = special
        self.data, self.library = data, None

    def _part(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words(text.lower())
        if self.beyond(text) and self.unassigned(text):
            from tokenizers import Tokenizer
            self.library = self.library or Tokenizer.from_str(self.data.decode("utf-8"))
            clean = self.library.normalizer.normalize_str(text)
            return [clean[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(clean)]
        # lower case by code point: only the capital sigma depends on its neighbours in Python
        return self.words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[str | int]:
        """Words; a special token comes as its place in ``special``."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._part(text)
        out: list[str | int] = []
        for i, part in enumerate(self.cut(text)):
            if i % 2:
                out.append(self.special.index(part))
            else:
                out += self._part(part)
        return out


class Merger:
    """Merges of symbol ids: plain for short sequences, tree joins for long ones."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        #: left << 32 | right -> rank << 32 | merged id
        self.rank = {vocab[a] << 32 | vocab[b]: r << 32 | vocab[a + b] for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.parts = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in pairs}
        self.n_windows = self.n_grown = 0

    def plain(self, symbols: list[int]) -> list[int]:
        """The lowest-ranked pair is merged until none is left, leftmost first."""
        if len(symbols) > 2 * LEAF:
            return self._queued(symbols)
        ids, get = list(symbols), self.rank.get
        found = [get(x << 32 | y, NONE) for x, y in zip(ids, ids[1:])]
        while found and (best := min(found)) < NONE:
            i = found.index(best)
            ids[i] = t = best & 0xFFFFFFFF
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << 32 | t, NONE)
            if i < len(found):
                found[i] = get(t << 32 | ids[i + 1], NONE)
        return ids

    def _queued(self, symbols: list[int]) -> list[int]:
        """The same with a priority queue over a linked list."""
        ids, n, rank = list(symbols), len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(got, i) for i in range(n - 1) if (got := rank.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            best, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= n or rank.get(ids[i] << 32 | ids[j]) != best:
                continue  # one of the two has been merged since
            t = best & 0xFFFFFFFF
            ids[i], ids[j] = t, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (got := rank.get(t << 32 | ids[k])) is not None:
                    heapq.heappush(queue, (got, i))
            if (h := before[i]) >= 0 and (got := rank.get(ids[h] << 32 | t)) is not None:
                heapq.heappush(queue, (got, h))
        return [t for t in ids if t >= 0]

    def symbols(self, ids: list[int]) -> list[int]:
        out, stack = [], list(reversed(ids))
        while stack:
            t = stack.pop()
            two = self.parts.get(t)
            if two is None:
                out.append(t)
            else:
                stack += (two[1], two[0])
        return out

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours' text from their encodings."""
        a, b = min(WINDOW, len(left)), min(WINDOW, len(right))
        while True:
            self.n_windows += 1
            window = self.plain(self.symbols(left[len(left) - a:] + right[:b]))
            same_left = a == len(left) or window[0] == left[len(left) - a]
            same_right = b == len(right) or window[-1] == right[b - 1]
            if same_left and same_right:
                return left[:len(left) - a] + window + right[b:]
            self.n_grown += 1
            if not same_left:
                a = min(2 * a, len(left))
            if not same_right:
                b = min(2 * b, len(right))

    def encode_all(self, sequences: list[list[int]]) -> list[list[int]]:
        """Each sequence's encoding; the trees of the long ones go up together."""
        level = [[self.plain(s[i:i + LEAF]) for i in range(0, len(s), LEAF)] for s in sequences]
        while any(len(nodes) > 1 for nodes in level):
            level = [[self.join(*nodes[i:i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)] for nodes in level]
        return [nodes[0] if nodes else [] for nodes in level]


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


class Encoder:
    """Ids of whole texts and the text of ids; recent words are kept by their text, in
    two generations, so that forgetting never empties the store."""

    def __init__(self, data: bytes):
        doc = json.loads(data)
        model = doc["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("only BPE models of plain merges with a word-end mark are supported")
        vocab = dict(model["vocab"])
        added = doc.get("added_tokens") or []
        if any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("only special tokens that are matched as they stand are supported")
        end = model.get("end_of_word_suffix") or ""
        self.token = {i: t for t, i in vocab.items()} | {a["id"]: a["content"] for a in added}
        self.split = Splitter(data, [a["content"] for a in added])
        self.special = [pack([a["id"]]) for a in added]
        self.merger = Merger(vocab, model["merges"])
        shown = byte_symbols()
        self.inner = [vocab[s] for s in shown]
        self.last = [vocab[s + end] for s in shown]
        self.young: dict[str | int, bytes] = {}
        self.old: dict[str | int, bytes] = {}

    def _sequence(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        return [inner[b] for b in data[:-1]] + [self.last[data[-1]]]

    def _learn(self, words: set[str | int]) -> None:
        long = []
        for w in words:
            got = self.special[w] if isinstance(w, int) else self.old.get(w)
            if got is None:
                s = self._sequence(w)
                if len(s) > LEAF:
                    long.append((w, s))
                    continue
                got = pack(self.merger.plain(s))
            self.young[w] = got
        for (w, _), ids in zip(long, self.merger.encode_all([s for _, s in long])):
            self.young[w] = pack(ids)

    def encode(self, text: str | None) -> bytes:
        """Packed int32 ids of a text."""
        if not text:
            return b""
        if len(self.young) > MAX_WORDS:  # between texts: a text finds all its words among the young
            self.old, self.young = self.young, {}
        pieces = self.split.pieces(text)
        if new := set(pieces).difference(self.young):
            self._learn(new)
        return b"".join(map(self.young.__getitem__, pieces))

    def decode(self, packed: bytes) -> str:
        """Text of packed ids: the tokens' own texts joined by a blank."""
        return " ".join(map(self.token.__getitem__, memoryview(packed).cast("i")))


def encoder(data: bytes) -> Encoder:
    """The worker's encoder for a tokenizer file, made once."""
    return kept(("tree_bpe", hash(data)), lambda: Encoder(data))


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids`` (array of int) and ``decoded`` (the text read back from the ids:
    token texts joined by a blank, as this tokenizer has no decoder)."""
    data = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def setup():
        enc = encoder(data.value)

        def work(texts: pa.Array) -> list:
            packed = [enc.encode(t) for t in texts.to_pylist()]
            decoded = list(map(enc.decode, packed))
            at = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=at[1:])
            flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            return [pa.ListArray.from_arrays(pa.array(at), flat), pa.array(decoded, pa.string())]
        return work

    fields = [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
    return map_text(docs, text, None, fields, keep=keep, setup=setup)


def token_digest(encoded: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts and digests of ids (decimal, joined by a blank) and decoded text."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(quoted(id).alias(id), F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
