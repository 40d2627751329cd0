"""Whole texts as byte blocks: Arrow buffers seen as numpy, words and rolling hashes.

Every text operator reads its column through ``map_text`` (one Python pass, the
rows dealt in slices of a few MB so memory does not follow the batch size) and
works on the UTF-8 bytes without building a Python string per word.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 1 << 20
U64 = np.uint64


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n+1 offsets of a string array; nulls count as empty."""
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(arr: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes (a longer text goes alone)."""
    _, off = utf8(arr)
    lo, n = 0, len(arr)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(n, hi, lo + 8192)
        yield lo, hi
        lo = hi


_KEPT: dict[Hashable, object] = {}


def release() -> None:
    """Drops what the worker keeps, and gives free memory back to the system:
    workers outlive their stage, next to those of the following ones."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
    trim()


def trim() -> None:
    """Free memory back to the system; what is kept stays."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def kept(key: Hashable, make: Callable[[], object]):
    """The worker's object for ``key``, made once; only one operator's is kept."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def map_text(df: DataFrame, text: str, fn: Callable[[pa.Array], list], fields: list[StructField],
             keep: list[str] | None = None, limit: int = SLICE_BYTES, setup: Callable | None = None) -> DataFrame:
    """``df``'s ``keep`` columns plus ``fields`` computed from whole texts.

    ``fn`` gets a slice of the text column and returns one Arrow array (or list)
    per field; with ``setup``, ``fn`` is what ``setup()`` returns on the executor.
    A kept column with the name of a computed one gives way to it.
    """
    new = {f.name for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    src = df.select(*[quoted(c).alias(f"k{i}") for i, c in enumerate(keep)], quoted(text).cast("string").alias("t"))
    out = StructType([StructField(f"k{i}", df.schema[c].dataType, True) for i, c in enumerate(keep)]
                     + [StructField(f"n{i}", f.dataType, True) for i, f in enumerate(fields)])
    n_keep = len(keep)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        types = [to_arrow_type(f.dataType) for f in fields]
        if setup is None:
            release()  # this operator keeps nothing
        work = setup() if setup else fn
        for b in batches:
            texts = b.column(n_keep)
            for lo, hi in slices(texts, limit):
                got = work(texts.slice(lo, hi - lo))
                cols = [b.column(i).slice(lo, hi - lo) for i in range(n_keep)]
                for g, t in zip(got, types):
                    g = g if isinstance(g, pa.Array) else pa.array(g, t)
                    cols.append(g if g.type == t else g.cast(t))
                yield pa.RecordBatch.from_arrays(cols, names=out.names)
        trim()  # an idle worker holds no more than it keeps

    res = src.mapInArrow(run, out)
    return res.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                      *[F.col(f"n{i}").alias(f.name) for i, f in enumerate(fields)])


# --- hashing: two polynomial prefix sums modulo 2^31 - 1, each with a random base ---

def _splitmix(x: np.ndarray) -> np.ndarray:
    x = x.astype(U64) + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


mix = _splitmix
#: The field: a prime, so two spans of n bytes agree in both sums with a probability
#: of (n / 2^31)^2 at most, whatever their bytes (a power of two has no such bound).
PRIME = (1 << 31) - 1
_P, _BITS = U64(PRIME), U64(31)
_BASES = (1_402_024_253, 1_790_655_309)
BYTE = np.arange(1, 257, dtype=U64)  # coefficient of each byte
LOWER = np.arange(256)
LOWER[65:91] += 32
BYTE_LOWER = BYTE[LOWER]
#: So many products of a coefficient and a power add up to less than 2^64 as they are.
PLAIN_SUM, CHUNK = 1 << 24, 1 << 15


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint32)
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m].astype(U64) * U64(pow(base, k, PRIME)) % _P
        k *= 2
    return out


_pow: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint32), np.ones(1, np.uint32))] * 2


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per base, its powers and those of its inverse: kept up to a slice's length,
    made anew for a longer text."""
    if len(_pow[0][0]) >= n:
        return _pow
    size = max(n, 1 << 16)
    if n <= SLICE_BYTES + 1:
        size = min(max(size, 2 * len(_pow[0][0])), SLICE_BYTES + 1)
    got = [(_powers_of(b, size), _powers_of(pow(b, -1, PRIME), size)) for b in _BASES]
    if n <= SLICE_BYTES + 1:
        _pow[:] = got
    return got


def prefix_sums(buf: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """Two rows of running sums whose differences identify any span of ``buf``."""
    n = len(buf)
    out = np.empty((2, n + 1), U64)
    out[:, 0] = 0
    powers = _powers(n + 1)
    for a in range(0, n, CHUNK):  # in pieces that stay in the processor's cache
        b = min(n, a + CHUNK)
        values = table[buf[a:b]]
        for k, (power, _) in enumerate(powers):
            part = out[k, a + 1:b + 1]
            np.multiply(values, power[a:b], out=part)
            if n >= PLAIN_SUM:
                part[:] = (part & _P) + (part >> _BITS)
            np.cumsum(part, out=part)
            part += out[k, a]
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the spans; equal bytes give equal values anywhere."""
    high, low = ((sums[k][end] - sums[k][start]) % _P * inverse[start] % _P for k, (_, inverse) in enumerate(_powers(sums.shape[1])))
    return _splitmix((high << _BITS | low) ^ (np.asarray(end - start).astype(U64) << U64(40)))


def word_spans(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each text.

    ``is_word`` marks word bytes; words end at text borders."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.empty(len(buf), bool)
    before[0], before[1:] = False, w[:-1]
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = False, w[1:]
    start = np.flatnonzero(w & (~before | edge[:-1]))
    end = np.flatnonzero(w & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


WORD_NOT_BLANK = np.ones(256, bool)  # [^\x20\x09-\x0D]+
WORD_NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
WORD_ALNUM = np.zeros(256, bool)  # lower-cased [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
WORD_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
