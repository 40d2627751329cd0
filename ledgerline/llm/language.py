"""Language identification by a string kernel.

A text is the set of its byte n-grams (1 to 3, lower-cased, non-letters of ASCII
as blanks), hashed to ``CELLS`` cells; the blended-spectrum presence kernel of
two texts is the size of the intersection over the geometric mean of the sizes.
``PER_LANGUAGE`` landmark texts of each language (those with the smallest
hashes of id and text; whole, their presence rows are made in the tasks) give Nyström features, on
which one ridge regression per language (one versus rest) is fitted from
partition-summed normal equations over a bounded sample of ``FIT_ROWS`` learnable
rows, drawn per language. Scores come from batched matrix products: presence rows times landmarks,
times the weights.

Cases: null texts and texts without a letter are ``und`` with score 0; so is
everything if no language can be learned; ties go to the first language in
alphabetical order; texts are whole; repeated rows each get a row; an empty
table gives an empty result; a null id is never learned from and not held out;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from ledgerline.llm.quality import held_out, tree_sum
from ledgerline.llm.textblock import map_text, quoted, utf8

CELLS = 1 << 16
PER_LANGUAGE = 24
FIT_ROWS = 20_000
RIDGE = 1e-4
SHARPNESS = 8.0
UNKNOWN = "und"
#: Texts whose presence rows are in memory at once.
ROWS = 256

_BLANK = np.arange(256, dtype=np.uint32)
_BLANK[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32


def presence(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """texts x CELLS: which n-grams a text has."""
    n = len(off) - 1
    out = np.zeros((n, CELLS), bool)
    flat = out.reshape(-1)
    b = _BLANK[buf]
    doc = np.repeat(np.arange(n, dtype=np.int64) * CELLS, np.diff(off))
    gram = np.zeros(len(b), np.uint32)
    for k in range(3):
        if len(b) <= k:
            break
        m = len(b) - k
        gram = gram[:m] * np.uint32(257) + b[k:k + m] + np.uint32(1)
        cell = (gram * np.uint32(0x9E3779B1)) >> np.uint32(16)
        inside = doc[:m] == doc[k:k + m]
        flat[(doc[:m] + cell)[inside]] = True
    return out


class Kernel:
    """``p``: the landmarks' presence rows."""

    def __init__(self, langs: list[str], p: np.ndarray):
        self.langs = langs
        self.cells = np.flatnonzero(p.any(0))
        self.marks = p[:, self.cells].astype(np.float32)
        self.sizes = np.sqrt(np.maximum(p.sum(1), 1))
        k = (self.marks @ self.marks.T) / np.outer(self.sizes, self.sizes)
        value, vector = np.linalg.eigh(k.astype(float))
        good = value > 1e-6 * value[-1]
        self.root = vector[:, good] / np.sqrt(value[good])  # K(x, landmarks) @ root: Nyström features
        self.weights = np.zeros((self.root.shape[1] + 1, len(langs)))

    @staticmethod
    def _rows(arr: pa.Array) -> np.ndarray:
        return presence(*utf8(pc.utf8_lower(arr)))

    def features(self, arr: pa.Array) -> np.ndarray:
        out = np.ones((len(arr), self.root.shape[1] + 1))
        for i in range(0, len(arr), ROWS):
            p = self._rows(arr.slice(i, ROWS))
            near = p[:, self.cells].astype(np.float32) @ self.marks.T
            near = near / np.outer(np.sqrt(np.maximum(p.sum(1), 1)), self.sizes)
            out[i:i + ROWS, :-1] = near @ self.root
        return out

    def predict(self, arr: pa.Array) -> tuple[list[str], np.ndarray]:
        s = self.features(arr) @ self.weights
        e = np.exp(SHARPNESS * (s - s.max(1, keepdims=True)))
        best = s.argmax(1)
        return [self.langs[i] for i in best], (e / e.sum(1, keepdims=True))[np.arange(len(best)), best]


def has_letter(arr: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(arr.fill_null(""), r"\pL").to_numpy(zero_copy_only=False)


#: Steps of the sampling shares.
SHARES = 1 << 40


def fit_shares(counts: dict[str, int], fit_rows: int) -> dict[str, float]:
    """Share of each language's rows to fit on: all rows of rare languages, and an
    equal number of the others', ``fit_rows`` together."""
    out, left = {}, fit_rows
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, left / (len(counts) - k))
        out[lang], left = take / n, left - take
    return out


def fit(rows: DataFrame, per_language: int = PER_LANGUAGE, fit_rows: int = FIT_ROWS) -> Kernel | None:
    """From learnable ``rows`` (id, text, lang)."""
    rows = (rows.where("id is not null and lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
            .withColumn("h", F.xxhash64("id", "text")))
    near = Window.partitionBy("lang").orderBy("h")
    chosen = rows.select("lang", "h", "text").withColumn("r", F.row_number().over(near)).where(F.col("r") <= per_language)

    def pack(batches):  # whole texts stay in the tasks; a landmark is CELLS bits
        for b in batches:
            bits = [np.packbits(Kernel._rows(b.column(2).slice(i, 1))).tobytes() for i in range(len(b))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.binary())], names=["lang", "h", "bits"])
    marks = chosen.select("lang", "h", "text").mapInArrow(pack, "lang string, h long, bits binary").orderBy("lang", "h").collect()
    if not marks:
        return None
    langs = sorted({m["lang"] for m in marks})
    kernel = Kernel(langs, np.unpackbits(np.array([np.frombuffer(m["bits"], np.uint8) for m in marks]), axis=1).astype(bool))
    spark = rows.sparkSession
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    below = spark.createDataFrame([(g, int(s * SHARES)) for g, s in fit_shares(counts, fit_rows).items()], "lang string, below long")
    sample = rows.join(F.broadcast(below), "lang").where(F.pmod(F.xxhash64("h"), F.lit(SHARES)) < F.col("below"))
    shared = spark.sparkContext.broadcast(kernel)
    k, m = kernel.weights.shape
    size = k * k + k * m

    def run(batches):
        kern, sums = shared.value, np.zeros(size)
        index = {g: i for i, g in enumerate(kern.langs)}
        for b in batches:
            for i in range(0, len(b), ROWS):
                texts, lang = b.column(0).slice(i, ROWS), b.column(1).slice(i, ROWS).to_pylist()
                ok = has_letter(texts) & np.array([g in index for g in lang])
                if not ok.any():
                    continue
                z = kern.features(texts.filter(pa.array(ok)))
                y = np.full((len(z), m), 0.0)
                y[np.arange(len(z)), [index[g] for g, o in zip(lang, ok) if o]] = 1.0
                sums += np.concatenate([(z.T @ z).ravel(), (z.T @ y).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["v"])

    sums = tree_sum(sample.select("text", "lang").mapInArrow(run, "v binary"), size)
    a, b = sums[:k * k].reshape(k, k), sums[k * k:].reshape(k, m)
    kernel.weights = np.linalg.solve(a + np.eye(k) * max(RIDGE * a[-1, -1], 1e-9), b)
    return kernel


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, fold: int = 1) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learned from the rows that
    are not held out."""
    src = docs.select(quoted(id).alias("doc_id"), quoted(text).cast("string").alias("text"))
    rows = docs.select(quoted(id).alias("id"), quoted(text).cast("string").alias("text"), quoted(lang).cast("string").alias("lang"))
    kernel = docs.sparkSession.sparkContext.broadcast(fit(rows.where(~held_out("id", folds, fold))))

    def work(texts: pa.Array) -> list:
        model, ok = kernel.value, has_letter(texts)
        n = len(texts)
        lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
        if model is not None and ok.any():
            lang[ok], score[ok] = model.predict(texts.filter(pa.array(ok)))
        return [pa.array(lang.tolist(), pa.string()), pa.array(score)]

    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return map_text(src, "text", work, fields, keep=["doc_id"]).select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "lang_pred", "score")
