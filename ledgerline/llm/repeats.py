"""Removal of repeated byte strings by prefix-free parsing.

A byte is removed if a string of ``length`` bytes (400) that covers it also
starts somewhere else. Rolling-hash triggers cut every text into phrases, so
equal strings are cut alike wherever they stand; all strings of ``length`` that
hold their first trigger at the same place form a *run*: a suffix of one phrase,
whole phrases and a prefix of the last. The dictionary is the set of distinct
run texts, the parse the list of runs. Instead of a lexicographic order of all
suffixes, which no single machine could hold, runs and strings are brought
together by 64-bit fingerprints; equal strings become neighbours either way.

1. Parse: per run a fingerprint of the text around its trigger (``core``, part
   of each of its strings) and one of its whole text (``whole``). Runs equal
   within a slice of the table are already settled there and go on as one row.
2. A core seen once has no repeated string. Runs whose whole text is seen twice
   or more are repeated from end to end.
3. Only at the borders of repeated passages (one core, several texts) single
   strings are compared: each distinct run text gives its strings' fingerprints,
   which are counted. Copies of one text count as one row with a weight.
4. The ranges of each text are merged and cut out.

Strings without a coarse trigger near their start use a finer trigger, and
strings without that one stand for themselves, so no string is left out.

Cases: null and empty texts are zero bytes; texts shorter than ``length`` stay
whole; texts are parsed whole; repeated rows are repeated strings and are cut
everywhere, the first one too; rows with equal id and text share their ranges,
which are equal; an empty table gives an empty result; only the id and the text
are read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.textblock import U64, mix, prefix_sums, quoted, slices, span_hash, utf8
from ledgerline.session import ensure_checkpoint_dir

LENGTH = 400
#: Bytes of a trigger, and one trigger in so many bytes (coarse, fine).
TRIGGER, COARSE, FINE = 16, 100, 32
#: Runs are cut by how far a string starts before its trigger, as shares of the
#: length: up to 36 %, 68 % and 92 %. What all strings of one class have in
#: common, their core, is then at least 64 % of a string.
FAR = (0.36, 0.68, 0.92)
RUN = "key long, core long, whole long, weight int, lo int, hi int"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared checkpoint folder and read again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/repeats-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def parse(buf: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """Runs of all texts: lo, hi (first and last string's start), core, whole."""
    size = np.diff(off)
    starts = [np.arange(a, b - length + 1) for a, b, n in zip(off[:-1].tolist(), off[1:].tolist(), size.tolist()) if n >= length]
    z = np.zeros(0, np.int64)
    if not starts:
        return z, z, z.view(U64), z.view(U64), None
    sums = prefix_sums(buf)
    i = np.concatenate(starts)
    ends = np.arange(TRIGGER, len(buf) + 1)
    rolling = span_hash(sums, ends - TRIGGER, ends)
    anchor = np.full(len(i), -1, np.int64)
    level = np.zeros(len(i), np.int64)
    far = np.array([int(f * length) for f in FAR])
    farthest = far[-1]
    for lv, rate in ((1, COARSE), (2, FINE)):
        at = np.flatnonzero((rolling >> U64(33)) % U64(rate) == 0) + TRIGGER
        if not len(at):
            continue
        open_ = anchor < 0
        nxt = np.searchsorted(at, i[open_] + TRIGGER)
        b = at[np.minimum(nxt, len(at) - 1)]
        ok = (nxt < len(at)) & (b <= i[open_] + farthest)
        where = np.flatnonzero(open_)[ok]
        anchor[where] = b[ok]
        level[where] = lv
    alone = anchor < 0
    anchor[alone] = i[alone]
    level = level * 4 + np.searchsorted(far, anchor - i)  # 0: alone; else level and distance class
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (level[1:] != level[:-1]) | (i[1:] != i[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(i) - 1)
    lo, hi, b, lv = i[first], i[last], anchor[first], level[first]
    whole = mix(span_hash(sums, lo, hi + length) + ((b - lo) * 16 + lv).astype(U64))
    core = whole.copy()
    has = lv > 0
    near = np.append(TRIGGER, far[:-1])
    c = lv[has] % 4
    core[has] = mix(span_hash(sums, b[has] - near[c], b[has] + length - far[c]) + lv[has].astype(U64))
    return lo, hi, core, whole, sums


def parse_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of ``docs`` (key, text): one row per distinct run of a slice, with its
    weight; the other equal runs of the slice are settled (core null) and come as
    byte ranges [lo, hi)."""
    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            for a, z in slices(texts):
                buf, off = utf8(texts.slice(a, z - a))
                lo, hi, core, whole, _ = parse(buf, off, length)
                if not len(lo):
                    continue
                doc = np.searchsorted(off, lo, side="right") - 1
                # empty texts share their offset with the next one
                key = keys[a:z][doc]
                lo, hi = lo - off[doc], hi - off[doc]
                _, first, back, weight = np.unique(core ^ mix(whole), return_index=True, return_inverse=True, return_counts=True)
                again = np.ones(len(lo), bool)
                again[first] = False
                yield _rows(key[first], core[first], whole[first], weight, lo[first], hi[first])
                if again.any():
                    k, s, e = merge(key[again], doc[again], lo[again], hi[again] + length)
                    yield _rows(k, None, None, np.zeros(len(k)), s, e)

    return docs.select("key", "text").mapInArrow(run, RUN)


def _rows(key, core, whole, weight, lo, hi) -> pa.RecordBatch:
    none = pa.nulls(len(key), pa.int64())
    cols = [pa.array(key, pa.int64()), none if core is None else pa.array(core.view(np.int64)), none if whole is None else pa.array(whole.view(np.int64)),
            *(pa.array(np.asarray(x).astype(np.int32)) for x in (weight, lo, hi))]
    return pa.RecordBatch.from_arrays(cols, names=["key", "core", "whole", "weight", "lo", "hi"])


def merge(key: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Unions of the ranges of each document."""
    order = np.lexsort((start, doc))
    key, doc, start, end = key[order], doc[order], start[order], end[order]
    wide = int(end.max()) + 1
    s, e = doc * wide + start, np.maximum.accumulate(doc * wide + end)
    new = np.append(True, (s[1:] > e[:-1]) | (doc[1:] != doc[:-1]))
    at = np.flatnonzero(new)
    to = np.append(at[1:] - 1, len(s) - 1)
    return key[at], start[at], e[to] - doc[to] * wide


def border_strings(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(print, weight, key, at) of the strings of given runs of ``texts``
    (key, text, runs: array of (lo, hi, weight)); key and at are null for runs
    seen more than once, which are settled."""
    def run(batches):
        for b in batches:
            for key, text, runs in zip(*(c.to_pylist() for c in b.columns)):
                sums = prefix_sums(np.frombuffer(text.encode(), np.uint8))
                for p in range(0, len(runs), 512):
                    part = runs[p:p + 512]
                    at = np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in part])
                    weight = np.concatenate([np.full(r["hi"] + 1 - r["lo"], r["weight"]) for r in part])
                    one = weight == 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array(span_hash(sums, at, at + length).view(np.int64)), pa.array(weight, pa.int64()),
                        pa.array(np.full(len(at), key), mask=~one), pa.array(at.astype(np.int32), mask=~one)], names=["print", "weight", "key", "at"])
    return texts.select("key", "text", "runs").mapInArrow(run, "print long, weight long, key long, at int")


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, lo, hi) byte ranges of repeated strings of ``docs`` (key, text)."""
    rows = stored(parse_runs(docs, length), "parse")
    settled = rows.where("core is null").select("key", "lo", "hi")
    runs = rows.where("core is not null")
    cores = runs.groupBy("core").agg(F.sum("weight").alias("n")).where("n > 1").select("core")
    some = stored(runs.join(cores, "core"), "repeated")
    kinds = some.groupBy("core", "whole").agg(F.sum("weight").alias("n"), F.min(F.struct("key", "lo", "hi")).alias("one"))
    kinds = stored(kinds, "kinds")
    whole = some.join(kinds.where("n > 1").select("core", "whole"), ["core", "whole"]).select("key", "lo", (F.col("hi") + length).alias("hi"))
    # cores with several texts, one of them seen once: its strings may still be elsewhere
    mixed = kinds.groupBy("core").agg(F.count("*").alias("texts"), F.min("n").alias("least")).where("texts > 1 and least = 1").select("core")
    border = kinds.join(mixed, "core").select("one.key", F.struct("one.lo", "one.hi", F.least("n", F.lit(2)).cast("int").alias("weight")).alias("run"))
    lists = border.groupBy("key").agg(F.collect_list("run").alias("runs"))  # of one text
    strings = stored(border_strings(docs.join(lists, "key"), length), "strings")
    twice = strings.groupBy("print").agg(F.sum("weight").alias("n")).where("n > 1").select("print")
    single = strings.where("key is not null").join(twice, "print").select("key", F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))
    return settled.unionByName(whole).unionByName(single)


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, starts and ends of the removed runs, kept
    (the remaining bytes)."""
    src = docs.select(quoted(id).alias("doc_id"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("key", F.xxhash64("doc_id", "text"))
    ranges = repeated_ranges(src.select("key", "text"), length)
    per_doc = ranges.groupBy("key").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))

    def run(batches):
        for b in batches:
            for a, z in slices(b.column(1), 4 << 20):
                part = b.slice(a, z - a)
                buf, off = utf8(part.column(1))
                out = []
                for n, (lo, hi) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    data = buf[off[n]:off[n + 1]]
                    if not lo:
                        out.append(([], [], data.tobytes()))
                        continue
                    one = np.zeros(len(lo), np.int64)
                    _, s, e = merge(one, one, np.array(lo, np.int64), np.array(hi, np.int64))
                    cuts = zip(np.append(0, e).tolist(), np.append(s, len(data)).tolist())
                    out.append((s.tolist(), e.tolist(), b"".join(data[x:y].tobytes() for x, y in cuts)))
                cols = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(off)), *cols], names=["doc_id", "n_bytes", "starts", "ends", "kept"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.join(per_doc, "key", "left").select("doc_id", "text", "lo", "hi").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, starts array<int>, ends array<int>, kept binary")


def repeat_digest(cut: DataFrame) -> DataFrame:
    """Counts and digest of what is kept; ``removed_share`` of the bytes (0 for an empty
    text) and ``repeated``, whether anything was removed."""
    removed = (F.col("n_bytes") - F.length("kept")).cast("long")
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"),
                      F.when(F.col("n_bytes") > 0, removed / F.col("n_bytes")).otherwise(F.lit(0.0)).alias("removed_share"),
                      (removed > 0).alias("repeated"))
