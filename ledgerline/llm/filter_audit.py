"""Filter interaction audit by truth-table survival words.

Five filters decide per document. Bit s of a document's 32-bit survival word is
set if the document survives the subset s of filters, so adding the words up
position by position gives the survivors of every subset, and from these 32
numbers follow all orders, steps and Shapley sums. The words of a part and label
are counted with carry-save adders: three vectors of one weight become one of that
weight and one of twice the weight, and only at the end are bits counted.

Filter E (an earlier document has the same text) is decided by the SHA-256 of the
text: the smallest id of each digest is aggregated and joined back by id and
digest, so that a text with very many copies is no hot key.

Cases: a null text is the empty text, a null source the empty part; a null id has
no order, so the row never fails E, makes none fail, and has no labels; repeated
rows count each, and rows of the smallest id with one text do not fail E; a
document is good (toxic) if any labels row of its id says 1; an empty table
has no parts and gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ledgerline.llm.textblock import map_text, quoted, utf8
from ledgerline.session import cut_lineage

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LABELS = ("all", "good", "toxic")
#: Thresholds of the filters (fixed values).
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT, FORBIDDEN = 200, 50, 2, b"[#$%&*|]"
#: Survival word of each failure mask: bit s set if no filter of s fails.
SURVIVES = np.array([sum(1 << s for s in range(SUBSETS) if not m & s) for m in range(SUBSETS)], np.uint32)
LANES = 256
#: Texts above this many bytes are split into words piece by piece.
PIECE = 1 << 20
#: Parts whose counters a task holds before it hands them on.
MAX_PARTS = 2048


def distinct_words(text: bytes) -> tuple[int, int]:
    """Words and distinct words; ``bytes.split`` cuts at exactly 20 and 09-0D."""
    if len(text) <= PIECE:
        words = text.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):  # cut before a blank: up to the last one, or on to the next
            cut = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            while cut < 0 and end < len(text) and not text[end:end + 1].isspace():
                end += 1
            end = cut + 1 if cut >= 0 else end
        words = text[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def text_failures(texts: pa.Array) -> np.ndarray:
    """Failure masks of the filters A to D."""
    buf, off = utf8(texts)
    at = off[:-1]

    def count(hit: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(hit, dtype=np.int64))
        return sums[off[1:]] - sums[at]

    points = count((buf & 0xC0) != 0x80)
    capitals = count((buf >= 65) & (buf <= 90))
    marks = count(np.isin(buf, np.frombuffer(FORBIDDEN[1:-1], np.uint8)))
    data = buf.tobytes()
    words, distinct = np.array([distinct_words(data[a:b]) for a, b in zip(at.tolist(), off[1:].tolist())], np.int64).reshape(-1, 2).T
    fails = (words < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * words, 100 * capitals > MAX_CAPITAL_PERCENT * points, marks > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def features(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, digest, mask): one row a document, texts left behind."""
    slim = docs.select(quoted(id).alias("id"), F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"), quoted(text).alias("text"))

    def work(texts: pa.Array) -> list:
        digests = [hashlib.sha256(b.as_buffer() if b.is_valid else b"").digest() for b in texts.cast(pa.binary())]
        return [pa.array(digests, pa.binary()), pa.array(text_failures(texts), pa.int32())]

    return map_text(slim, "text", work, [StructField("digest", BinaryType()), StructField("mask", IntegerType())], keep=["id", "part"])


def failure_masks(feats: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """(part, mask with E, good, toxic) of each document."""
    known = feats.where("id IS NOT NULL")
    first = known.groupBy("digest").agg(F.min("id").alias("id"))
    marks = (labels.where(quoted(id).isNotNull()).groupBy(quoted(id).alias("id"))
             .agg(F.max(F.coalesce(quoted("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(quoted("toxic") == 1, F.lit(False))).alias("toxic")))
    no = F.lit(False)
    judged = (known.join(first.withColumn("first", F.lit(True)), ["id", "digest"], "left").join(marks, "id", "left")
              .select("part", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + (1 << 4)).alias("mask"),
                      F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")))
    return judged.unionByName(feats.where("id IS NULL").select("part", "mask", no.alias("good"), no.alias("toxic")))


def carry_save(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bit vectors."""
    half = a ^ b
    return half ^ c, a & b | half & c


class PositionalCount:
    """How often each of 32 bit positions is set in the words added so far."""

    def __init__(self):
        self.weights: list[list[np.ndarray]] = []  # weight 2**k: at most two vectors

    def _push(self, k: int, row: np.ndarray) -> None:
        while True:
            if k == len(self.weights):
                self.weights.append([])
            self.weights[k].append(row)
            if len(self.weights[k]) < 3:
                return
            total, row = carry_save(*self.weights[k])
            self.weights[k] = [total]
            k += 1

    def add(self, words: np.ndarray) -> None:
        rows = np.zeros((-(-len(words) // LANES), LANES), np.uint32)
        rows.reshape(-1)[:len(words)] = words
        for row in rows:
            self._push(0, row)

    def counts(self) -> np.ndarray:
        out = np.zeros(32, np.int64)
        for k, rows in enumerate(self.weights):
            for row in rows:
                bits = np.unpackbits(row.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
                out += bits.sum(axis=0, dtype=np.int64) << k
        return out


def _count_column(label: str, subset: int) -> str:
    return f"{label}_{subset}"


COUNT_COLUMNS = [_count_column(label, s) for label in LABELS for s in range(SUBSETS)]


def survivors(masks: DataFrame) -> DataFrame:
    """Per part, the survivors of each subset of filters among all, good and toxic
    documents (one column each)."""
    out = StructType([StructField("part", StringType())] + [StructField(c, LongType()) for c in COUNT_COLUMNS])

    def run(batches):
        held: dict[str, list[PositionalCount]] = {}

        def flush():
            if not held:
                return
            table = np.array([np.concatenate([c.counts() for c in counts]) for counts in held.values()])
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *map(pa.array, table.T.copy())], names=out.names)
            held.clear()

        for b in batches:
            if not b.num_rows:
                continue
            parts = b.column(0).dictionary_encode()
            code = parts.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            code = code[order]
            words = SURVIVES[b.column(1).to_numpy()[order]]
            pick = [None, *(pc.cast(b.column(i), pa.int8()).to_numpy()[order].astype(bool) for i in (2, 3))]
            start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            for lo, hi in zip(start.tolist(), np.append(start[1:], len(code)).tolist()):
                counts = held.setdefault(parts.dictionary[int(code[lo])].as_py(), None) or [PositionalCount() for _ in LABELS]
                held[parts.dictionary[int(code[lo])].as_py()] = counts
                for c, p in zip(counts, pick):
                    c.add(words[lo:hi] if p is None else words[lo:hi][p[lo:hi]])
                if len(held) >= MAX_PARTS:
                    yield from flush()
        yield from flush()

    partial = masks.select("part", "mask", "good", "toxic").mapInArrow(run, out)
    return partial.groupBy("part").agg(*[F.sum(c).alias(c) for c in COUNT_COLUMNS])


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step (see the module)."""
    feats = cut_lineage(features(docs, id, text, part))  # each text is read once
    found = survivors(failure_masks(feats, labels, id))
    full = SUBSETS - 1

    def column(label: str):
        return F.array(*[F.col(_count_column(label, s)) for s in range(SUBSETS)])

    def shapley(f: int):
        total = F.lit(0).cast("long")
        for s in range(SUBSETS):
            if not s >> f & 1:
                k = s.bit_count()
                weight = math.factorial(k) * math.factorial(len(FILTERS) - 1 - k)
                total = total + F.lit(weight) * (F.col(_count_column("all", s)) - F.col(_count_column("all", s | 1 << f)))
        return total

    per_part = found.select(
        "part", *[column(label).alias(label) for label in LABELS],
        F.array(*[F.col(_count_column("all", 0)) - F.col(_count_column("all", 1 << f)) for f in range(len(FILTERS))]).alias("failing"),
        F.array(*[F.col(_count_column("all", full ^ 1 << f)) - F.col(_count_column("all", full)) for f in range(len(FILTERS))]).alias("only"),
        F.array(*[shapley(f) for f in range(len(FILTERS))]).alias("shapleys"))
    # the fixed list of orders: 120 texts, and per order and step the filter and the filters before it
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    letters = [FILTERS.index(c) for o in orders for c in o]
    befores = [sum(1 << FILTERS.index(c) for c in o[:k]) for o in orders for k in range(len(FILTERS))]
    steps = len(FILTERS)
    rows = per_part.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(letters) - 1))).alias("i"))
    rows = rows.select("*", F.lit(letters)[F.col("i")].alias("f"), F.lit(befores)[F.col("i")].alias("before"))
    rows = rows.withColumn("after", F.col("before").bitwiseOR(F.lit([1 << f for f in range(steps)])[F.col("f")]))

    def removed(label: str):
        return F.col(label)[F.col("before")] - F.col(label)[F.col("after")]

    return rows.select("part", F.lit(orders)[F.floor(F.col("i") / steps).cast("int")].alias("filter_order"),
                       (F.col("i") % steps + 1).cast("int").alias("step"), F.col("all")[F.col("after")].alias("kept"),
                       removed("all").alias("removed"), (F.col("failing")[F.col("f")] - removed("all")).alias("redundant"),
                       F.col("only")[F.col("f")].alias("unique_fails"), removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"),
                       F.col("shapleys")[F.col("f")].alias("shapley"))
