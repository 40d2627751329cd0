"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` turns documents into index segments (document-partitioned, one
row per segment of bounded size): for every term of the test vocabulary its
postings, i.e. sorted (document, position) places, packed term by term. The
segments are written to the shared checkpoint folder, once; no row is shuffled.
Every segment has a key of its own, which with the row's place in it is the row's
key. Terms are 64-bit fingerprints of the lower-cased words.

``search`` sends the test windows to the segments. A window's terms are ordered
from the rarest (corpus frequency summed from the index); the rarest term's
places, moved back by its offset, are the candidate starts, and each further
list, moved by its own offset, is intersected with them. What survives all
terms is an exact phrase match; with ``slop`` the rarest terms may each be up to
``slop`` words away from their offset (proximity match).

Test items go to the segments in blocks of at most ``block_windows`` windows
(so what is broadcast is bounded; a long item is cut); the matches of all blocks
are merged by row key, so equal rows and rows without an id stay apart.

Cases: null and empty texts have no words and no hits; items of null or empty text have
no window; an item without an id hits like any other and is left out of the id lists; an item with fewer words than the window is one window; texts of any
length are whole (a long one is a segment of its own); repeated documents or
items are each treated on their own, repeated item ids count once; empty tables
give an empty result, or documents without hits; only the id and text columns
are read, so other columns' names do not matter.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from ledgerline.llm.textblock import BYTE_LOWER, WORD_ALNUM, prefix_sums, quoted, slices, span_hash, utf8, word_spans
from ledgerline.session import cut_lineage

WINDOW = 10
SEGMENT_BYTES = 4 << 20
BLOCK_WINDOWS = 200_000
#: With more test terms than this the index posts all terms, so that nothing larger is sent.
VOCABULARY = 4_000_000

SEGMENT = StructType([StructField("segment", BinaryType()), StructField("doc_ids", BinaryType()), StructField("n_words", BinaryType()), StructField("terms", BinaryType()),
                      StructField("ends", BinaryType()), StructField("docs", BinaryType()), StructField("positions", BinaryType())])


def term_prints(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of all texts, and the n+1 word offsets."""
    buf, off = utf8(arr)
    start, end, at = word_spans(buf, off, WORD_ALNUM)
    return span_hash(prefix_sums(buf, BYTE_LOWER), start, end), at


# --- test windows ---------------------------------------------------------

def item_terms(bench: DataFrame, id: str, text: str):
    """(item id, its term fingerprints) of the items with words."""
    for row in bench.select(quoted(id).cast("string"), quoted(text).cast("string")).toLocalIterator():
        if row[1] is not None:
            prints, _ = term_prints(pa.array([row[1]], pa.string()))
            if len(prints):
                yield row[0], prints


def vocabulary_of(bench: DataFrame, id: str, text: str, limit: int = VOCABULARY) -> np.ndarray | None:
    """Sorted terms of all items; None where they are more than ``limit``."""
    voc, new, size = np.zeros(0, np.uint64), [], 0
    for _, prints in item_terms(bench, id, text):
        new.append(prints)
        size += len(prints)
        if size > limit:
            voc, new, size = np.unique(np.concatenate([voc, *new])), [], 0
            if len(voc) > limit:
                return None
    voc = np.unique(np.concatenate([voc, *new]))
    return voc if len(voc) <= limit else None


def item_blocks(bench: DataFrame, id: str, text: str, window: int, block_windows: int):
    """Blocks of (item ids, windows, item of each window), each of at most
    ``block_windows`` windows; items pass the driver block by block."""
    ids: list[str | None] = []
    wins: list[np.ndarray] = []
    owner: list[int] = []
    for item, w in item_terms(bench, id, text):
        count, at = max(1, len(w) - window + 1), 0
        while at < count:
            if len(wins) >= block_windows:
                yield ids, wins, owner
                ids, wins, owner = [], [], []
            n = min(count - at, block_windows - len(wins))
            wins += [w[i:i + window] for i in range(at, at + n)]
            owner += [len(ids)] * n
            ids.append(item)
            at += n
    yield ids, wins, owner


# --- index ------------------------------------------------------------------

def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text", vocabulary=None,
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Index segments of the documents. ``vocabulary``: a broadcast variable of the
    sorted term fingerprints to post (default: all terms)."""
    src = docs.select(quoted(id).cast("long").alias("i"), quoted(text).cast("string").alias("t"))

    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo, hi in slices(texts, segment_bytes):
                prints, at = term_prints(texts.slice(lo, hi - lo))
                doc = np.repeat(np.arange(hi - lo, dtype=np.int32), np.diff(at))
                pos = (np.arange(len(prints)) - np.repeat(at[:-1], np.diff(at))).astype(np.int32)
                if vocabulary is not None:
                    voc = vocabulary.value
                    k = np.minimum(np.searchsorted(voc, prints), max(len(voc) - 1, 0))
                    on = voc[k] == prints if len(voc) else np.zeros(len(prints), bool)
                    prints, doc, pos = prints[on], doc[on], pos[on]
                order = np.argsort(prints, kind="stable")  # places stay in order within a term
                prints = prints[order]
                last = np.flatnonzero(np.append(prints[1:] != prints[:-1], True)) if len(prints) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().bytes], pa.binary())] + [pa.array([x.tobytes()], pa.binary()) for x in (
                        ids.slice(lo, hi - lo).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64), np.diff(at).astype(np.int64),
                        prints[last], (last + 1).astype(np.int64), doc[order], pos[order])],
                    names=SEGMENT.names)

    return src.mapInArrow(run, SEGMENT)


#: Stands for a null id inside a segment.
NULL_ID = -(1 << 63)


def term_counts(index: DataFrame, terms) -> DataFrame:
    """(term, n): places of the ``terms`` (a broadcast sorted array) in the whole index."""
    wanted = terms

    def run(batches):
        for b in batches:
            for terms, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, terms = np.diff(np.frombuffer(ends, np.int64), prepend=0), np.frombuffer(terms, np.uint64)
                on = np.isin(terms, wanted.value, assume_unique=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms[on].view(np.int64)), pa.array(n[on])], names=["term", "n"])
    return index.select("terms", "ends").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


# --- search -----------------------------------------------------------------

def _plan(wins: list[np.ndarray], counts: dict[int, int], rarest: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per window: its length, the terms and their offsets from the rarest on;
    ``rarest`` = 0 keeps all terms. Windows with a term that no text has go."""
    out = []
    for k, w in enumerate(wins):
        n = np.array([counts.get(int(t), 0) for t in w.view(np.int64)])
        if n.min():
            order = np.argsort(n, kind="stable")
            out.append((k, w[order[:rarest or None]], order[:rarest or None]))
    return out


class Segment:
    def __init__(self, row: list[bytes]):
        self.key, row = row[0], row[1:]
        self.doc_ids, self.n_words, self.terms, self.ends = (np.frombuffer(x, t) for x, t in zip(row, (np.int64, np.int64, np.uint64, np.int64)))
        docs, positions = np.frombuffer(row[4], np.int32), np.frombuffer(row[5], np.int32)
        self.places = docs.astype(np.int64) << 32 | positions  # sorted within each term

    def list_of(self, term) -> np.ndarray:
        k = int(np.searchsorted(self.terms, term))
        if k == len(self.terms) or self.terms[k] != term:
            return self.places[:0]
        return self.places[self.ends[k - 1] if k else 0:self.ends[k]]

    def starts(self, terms: np.ndarray, offsets: np.ndarray, slop: int = 0) -> np.ndarray:
        """Places where the window starts."""
        got = None
        for t, o in zip(terms, offsets.tolist()):
            places = self.list_of(t)
            if got is None:
                got = places[(places & 0xFFFFFFFF) >= o - slop] - o
            elif slop:
                at = np.searchsorted(places, got + o - slop)
                near = places[np.minimum(at, len(places) - 1)] if len(places) else got[:0]
                got = got[(at < len(places)) & (near <= got + o + slop)] if len(places) else near
            elif len(places) > 16 * len(got):
                at = np.minimum(np.searchsorted(places, got + o), len(places) - 1)
                got = got[places[at] == got + o]
            else:
                got = got[np.isin(got + o, places)]
            if not len(got):
                break
        return got


MATCH = StructType([StructField("segment", BinaryType()), StructField("row", IntegerType()), StructField("doc_id", LongType()), StructField("n_words", LongType()),
                    StructField("starts", ArrayType(IntegerType())), StructField("lengths", ArrayType(IntegerType())),
                    StructField("items", ArrayType(IntegerType()))])


def _search_block(index: DataFrame, plan_b, slop: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                seg = Segment(list(row))
                doc, start, length, item = [], [], [], []
                present = {}
                for size, owner, terms, offsets in plan_b.value:
                    first = terms[0]
                    if (ok := present.get(first)) is None:
                        ok = present[first] = len(seg.list_of(first)) > 0
                    if not ok:
                        continue
                    got = seg.starts(terms, offsets, slop)
                    if len(got):
                        doc.append(got >> 32)
                        start.append(got & 0xFFFFFFFF)
                        length.append(np.full(len(got), size))
                        item.append(np.full(len(got), owner))
                cat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc, start, length, item)]
                order = np.argsort(cat[0], kind="stable")
                cuts = np.searchsorted(cat[0][order], np.arange(len(seg.doc_ids) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[order].astype(np.int32))) for x in cat[1:]]
                ids = pa.array(seg.doc_ids, mask=seg.doc_ids == NULL_ID)
                key = [pa.array([seg.key] * len(ids), pa.binary()), pa.array(np.arange(len(ids), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([*key, ids, pa.array(seg.n_words), *lists], names=MATCH.names)

    return index.mapInArrow(run, MATCH)


def search(docs: DataFrame, bench: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           window: int = WINDOW, slop: int = 0, rarest: int = 0, block_windows: int = BLOCK_WINDOWS):
    """Yields per block of test items (item ids, matches): one row per document, with
    its key, and starts, lengths and items (indexes into the ids) of its matches."""
    if slop and not rarest:
        rarest = 3
    sc = docs.sparkSession.sparkContext
    voc = vocabulary_of(bench, item_id, item_text)
    index = cut_lineage(build_index(docs, id, text, None if voc is None else sc.broadcast(voc)))
    for ids, wins, owner in item_blocks(bench, item_id, item_text, window, block_windows):
        terms = np.unique(np.concatenate(wins)) if wins else np.zeros(0, np.uint64)
        counts = {r["term"]: r["n"] for r in term_counts(index, sc.broadcast(terms)).collect()}  # at most the block's terms
        plan = [(len(wins[k]), owner[k], terms, offs) for k, terms, offs in _plan(wins, counts, rarest)]
        plan.sort(key=lambda p: int(p[2][0]))
        yield ids, _search_block(index, sc.broadcast(plan), slop)


def contamination(docs: DataFrame, bench: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, slop: int = 0, rarest: int = 0,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a match), items (sorted
    ids of the matching items), spans (merged [start, end) word ranges hit)."""
    merged = None
    for ids, matches in search(docs, bench, id, text, item_id, item_text, window, slop, rarest, block_windows):
        names = docs.sparkSession.sparkContext.broadcast(ids)

        def run(batches, names=names):
            for b in batches:
                keep = names.value
                out = []
                for starts, lengths, items in zip(*(b.column(i).to_pylist() for i in (4, 5, 6))):
                    out.append(_spans(np.array(starts, np.int64), np.array(lengths, np.int64)) + (sorted({keep[i] for i in items} - {None}),))
                cols = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())))]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), *cols], names=[*MATCH.names[:4], "starts", "ends", "items"])

        part = matches.mapInArrow(run, "segment binary, row int, doc_id long, n_words long, starts array<int>, ends array<int>, items array<string>")
        merged = part if merged is None else merged.unionByName(part)
        blocks = 1 if merged is part else 2
    if blocks > 1:  # ranges of several blocks of items meet per document row
        merged = merged.groupBy("segment", "row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                                                      F.flatten(F.collect_list("starts")).alias("starts"),
                                                      F.flatten(F.collect_list("ends")).alias("ends"),
                                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        ends = F.udf(lambda s, e: [list(x) for x in _spans(np.array(s, np.int64), np.array(e, np.int64) - np.array(s, np.int64))],
                     ArrayType(ArrayType(IntegerType())))
        merged = merged.withColumn("r", ends("starts", "ends")).withColumns({"starts": F.col("r")[0], "ends": F.col("r")[1]}).drop("r")
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return merged.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", F.arrays_zip("starts", "ends").alias("spans"))


def _spans(start: np.ndarray, length: np.ndarray) -> tuple[list[int], list[int]]:
    """Union of the ranges as sorted starts and ends."""
    if not len(start):
        return [], []
    order = np.argsort(start, kind="stable")
    s = start[order]
    e = np.maximum.accumulate((start + length)[order])
    new = np.append(True, s[1:] > e[:-1])
    return s[new].tolist(), e[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)].tolist()


def contamination_digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
