"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

``statistics`` reads every whole text once and gives some two dozen document
statistics. Random Fourier features of the standardised statistics approximate
a Gaussian kernel; the normal equations of the ridge regression are summed per
partition (and then over partitions, in a tree), so what reaches the driver has
a fixed size. A held-back fifth of the labelled rows calibrates the scores:
label sums in fixed score bins, made monotone by pooling adjacent violators.

Cases: null and empty texts have all statistics zero and are scored like any
other; without usable labels (none, or one class only) every score is the
share of label 1, or 0.5; null labels and labels of unknown documents are not
learned from; repeated rows each count and each get a row; a null id is never
learned from and not held out; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField

from ledgerline.llm.textblock import BYTE_LOWER, WORD_NOT_BLANK, map_text, mix, prefix_sums, quoted, span_hash, utf8, word_spans
from ledgerline.session import cut_lineage

N_FEATURES = 256
KERNEL_WIDTH = 6.0
RIDGE = 1e-3
SEED = 20
BINS = 400
THRESHOLD = 0.7
#: Partition sums meet in this many groups before they reach the driver.
FAN_IN = 8

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (32, 9), "line": (10, 13), "stop": (46, 59, 58, 63),
    "comma": (44,), "bang": (33,), "bar": (124,), "mark": (35, 36, 37, 38, 42, 64, 94, 126, 43, 61), "quote": (34, 39, 40, 41, 91, 93),
    "angle": (60, 62, 47, 92, 95, 123, 125), "high": range(128, 256), "control": [*range(0, 9), *range(11, 13), *range(14, 32), 127],
}
_CLASS_OF = np.zeros(256, np.int64)
for _i, _c in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_c)] = _i
_N_CLASSES = len(_CLASSES)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
N_STATS = _N_CLASSES + 12


def _distinct(doc: np.ndarray, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: number of distinct prints, and the largest number of repeats."""
    if not len(prints):
        return np.zeros(n), np.zeros(n)
    order = np.argsort(prints, kind="stable")
    order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")]
    d, p = doc[order], prints[order]
    new = np.append(True, (p[1:] != p[:-1]) | (d[1:] != d[:-1]))
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(p)))
    most = np.zeros(n)
    np.maximum.at(most, d[at], run)
    return np.bincount(d[at], minlength=n).astype(float), most


def text_statistics(arr: pa.Array) -> np.ndarray:
    """One row of statistics per text."""
    buf, off = utf8(arr)
    n = len(arr)
    size = np.diff(off).astype(float)
    doc = np.repeat(np.arange(n), np.diff(off))
    share = np.bincount(doc * _N_CLASSES + _CLASS_OF[buf], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES) / np.maximum(size, 1)[:, None]
    start, end, at = word_spans(buf, off, WORD_NOT_BLANK)
    words = np.diff(at)
    owner = np.repeat(np.arange(n), words)
    sums = prefix_sums(buf, BYTE_LOWER)
    prints = span_hash(sums, start, end)
    n_words = np.maximum(words, 1)
    distinct, most = _distinct(owner, prints, n)
    two = mix(prints[:-1]) + prints[1:] if len(prints) else prints
    same = owner[1:] == owner[:-1]
    pairs, most_pairs = _distinct(owner[1:][same], two[same], n)
    length = (end - start).astype(float)
    total = np.bincount(owner, length, minlength=n)
    square = np.bincount(owner, length ** 2, minlength=n)
    mean = total / n_words
    spread = np.sqrt(np.maximum(square / n_words - mean ** 2, 0))
    capital = np.bincount(owner, _UPPER[buf[start]], minlength=n) / n_words
    not_line = np.ones(256, bool)
    not_line[10] = False
    ls, le, la = word_spans(buf, off, not_line)
    lines = np.diff(la)
    line_owner = np.repeat(np.arange(n), lines)
    line_kinds, most_lines = _distinct(line_owner, span_hash(sums, ls, le), n)
    n_lines = np.maximum(lines, 1)
    repeated_words = np.bincount(owner[1:][same], prints[1:][same] == prints[:-1][same], minlength=n) / n_words
    extra = [np.log1p(size), np.log1p(words), mean, spread, capital, distinct / n_words, most / n_words, pairs / n_words,
             most_pairs / n_words, line_kinds / n_lines, np.log1p(size / n_lines), repeated_words]
    out = np.column_stack([share, *extra])
    out[size == 0] = 0.0
    return out


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats): packed doubles."""
    def work(texts: pa.Array) -> list:
        return [pa.array([r.tobytes() for r in text_statistics(texts)], pa.binary())]
    return map_text(docs.select(quoted(id).alias("doc_id"), quoted(text).alias("text")), "text", work, [StructField("stats", BinaryType())], keep=["doc_id"])


def unpack(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), -1) if len(col) else np.zeros((0, N_STATS))


class Model:
    """Standardisation, random features, ridge weights and calibration knots."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, prior: float):
        self.mean, self.std, self.prior = mean, std, prior
        rng = np.random.default_rng(SEED)
        self.w = rng.normal(size=(len(mean), N_FEATURES)) / KERNEL_WIDTH
        self.b = rng.uniform(0, 2 * np.pi, N_FEATURES)
        self.coef: np.ndarray | None = None
        self.knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.std, -8, 8)
        z = np.sqrt(2 / N_FEATURES) * np.cos(x @ self.w + self.b)
        return np.column_stack([np.ones(len(x)), z])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.coef

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.full(len(stats), self.prior)
        raw = self.raw(stats)
        flat = np.interp(raw, *self.knots) if self.knots is not None else np.clip(raw, 0, 1)
        # a trace of the raw score keeps its order within flat parts
        return np.clip(0.998 * flat + 0.002 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def tree_sum(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of packed double vectors (column ``v``), one per partition: first in
    ``FAN_IN`` groups on the executors, then those on the driver."""
    def add(batches):
        total = np.zeros(size)
        for b in batches:
            for v in b.column(0).to_pylist():
                total += np.frombuffer(v, np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])
    rows = parts.select("v").repartition(FAN_IN).mapInArrow(add, "v binary").collect()
    return np.sum([np.frombuffer(r["v"], np.float64) for r in rows], axis=0) if rows else np.zeros(size)


def _partition_sums(rows: DataFrame, size: int, add) -> np.ndarray:
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            x, y = unpack(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(float)
            for i in range(0, len(x), 4096):
                total += add(x[i:i + 4096], y[i:i + 4096])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])
    return tree_sum(rows.select("stats", "y").mapInArrow(run, "v binary"), size)


def held_out(id: str, folds: int = 4, fold: int = 2):
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Closest non-decreasing sequence in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(n, v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", learn_from=None) -> Model:
    """Fits on ``labels`` (doc_id, label 0/1) of the documents in ``stats``; by
    default rows of the held-out fold are never learned from."""
    d = N_STATS
    keep = ~held_out("doc_id") if learn_from is None else learn_from
    y = labels.select(F.col("doc_id"), quoted(label).cast("double").alias("y")).where("y in (0, 1) and doc_id is not null").where(keep)
    rows = cut_lineage(stats.join(y, "doc_id").select("stats", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("calibrate")))
    sums = _partition_sums(rows, 2 * d + 2, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)]))
    n, ones = sums[0], sums[1]
    if n == 0 or ones in (0, n):
        return Model(np.zeros(d), np.ones(d), 0.5 if n == 0 else float(ones / n))
    mean = sums[2:2 + d] / n
    std = np.sqrt(np.maximum(sums[2 + d:] / n - mean ** 2, 1e-9))
    model = Model(mean, std, float(ones / n))
    k = N_FEATURES + 1

    def normal(x, y):
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])
    eq = _partition_sums(rows.where("not calibrate"), k * k + k, normal)
    a, b = eq[:k * k].reshape(k, k), eq[k * k:]
    penalty = np.full(k, RIDGE * max(a[0, 0], 1.0) / 10)
    penalty[0] = 1e-9
    model.coef = np.linalg.solve(a + np.diag(penalty), b)

    def binned(x, y):
        at = np.clip(((model.raw(x) + 0.5) * BINS / 2).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])
    bins = _partition_sums(rows.where("calibrate"), 2 * BINS, binned)
    count, ones = bins[:BINS], bins[BINS:]
    used = count > 0
    if used.any():
        level = pool_adjacent(ones[used] / count[used], count[used])
        model.knots = (np.flatnonzero(used) + 0.5) * 2 / BINS - 0.5, level
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``stats``."""
    m = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.value.score(unpack(b.column(1))))], names=["doc_id", "score"])
    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    stats = cut_lineage(statistics(docs, id, text))
    scored = score(stats, fit(stats, labels.withColumnsRenamed({id: "doc_id"}), label))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; all rows where the labels
    give no model (none usable, or of one class only). The statistics are made again
    beside the text instead of moving texts for a join."""
    stats = cut_lineage(statistics(docs, id, text))
    fitted = fit(stats, labels.withColumnsRenamed({id: "doc_id"}), label)
    if fitted.coef is None:
        return docs
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def work(texts: pa.Array) -> list:
        return [pa.array(model.value.score(text_statistics(texts)))]
    order = docs.columns
    # the text itself is kept besides being read, under another name
    scored = map_text(docs.withColumn("__text", quoted(text)), "__text", work, [StructField("__score", DoubleType())], keep=order)
    return scored.where(F.col("__score") >= threshold).select(*[quoted(c) for c in order])
