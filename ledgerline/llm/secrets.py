"""Secret scans: fixed patterns plus a randomness test battery.

Base patterns find assigned credentials, access keys and long hex strings. The
battery looks at every other long token: its encoding is inferred from its
characters (digits, hex, base32, base64), and three tests ask how random it is
for that alphabet: chi-squared uniformity of the symbols, the runs test (over
upper, lower and other characters, letters and digits, or low and high digits)
and the serial correlation of neighbours. Each gives
a normal score; the worst of them is turned into a p-value of "this token is
ordinary text" with the distribution of tokens made of dictionary words (alone,
joined, in any case, with numbers and separators) of the same form and length
class. That null does not depend on the input, so one rule holds at every size.
Discoveries are then taken by Benjamini-Hochberg within each length class and
form (length-aware false-discovery control), over all documents, with Storey's
estimate of the number of ordinary tokens.

Cases: null and empty texts have no spans; texts are scanned whole; repeated
rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import random
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField

from ledgerline.llm.textblock import map_text, quoted
from ledgerline.session import cut_lineage

KINDS = ("assign", "access", "hex")
# The base patterns.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more
ASSIGN_MIN, ACCESS_MIN = 6, 20
#: Every assigned credential holds one of these in some letter case.
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Length classes of the battery (lower ends) and its false-discovery rate.
LENGTHS = (20, 24, 32, 48, 64, 96)
RATE = 0.01
BINS = 64
#: Discoveries are sought within a length class and a form: the encoding, and for
#: base64 also one letter case or both, without and with digits. Every form is tested.
FORMS = ("digits", "hex", "HEX", "base32", "one case", "one case, digits", "two cases", "two cases, digits")
GROUPS = len(LENGTHS) * len(FORMS)

ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: Ends of the character kinds whose changes the runs test counts.
KINDS_END = {"digits": [5, 10], "hex": [10, 16], "HEX": [10, 16], "base32": [26, 32], "base64": [26, 52, 66]}
_CODE = {}
for _name, _chars in ALPHABETS.items():
    _CODE[_name] = np.full(256, -1, np.int64)
    _CODE[_name][[ord(c) for c in _chars]] = np.arange(len(_chars))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base matches, sorted."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_MIN:
                out.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_MIN:
                out.append((m.start(), 1, m.end()))
    for m in HEX.finditer(text):
        out.append((m.start(), 2, m.end()))
    out.sort()
    return out


def encoding_of(token: str) -> str:
    body = token.rstrip("=")
    chars = set(body)
    for name in ("digits", "hex", "HEX", "base32"):
        if chars <= set(ALPHABETS[name]):
            return name
    return "base64"


def form_of(token: str) -> int:
    body, name = token.rstrip("="), encoding_of(token)
    if name != "base64":
        return FORMS.index(name)
    return FORMS.index("one case" if body in (body.lower(), body.upper()) else "two cases") + any(c.isdigit() for c in body)


def scores(code: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normal scores of the three tests for rows of symbol codes of one encoding."""
    rows, n = code.shape
    k = len(ALPHABETS[name])
    count = np.bincount((code + k * np.arange(rows)[:, None]).ravel(), minlength=rows * k).reshape(rows, k)
    chi2 = np.sum(count.astype(float) ** 2, axis=1) * k / n - n
    uniform = (chi2 - (k - 1)) / math.sqrt(2 * (k - 1))
    side = np.searchsorted(KINDS_END[name], code, side="right")
    change = 1 - float(np.sum((np.diff(KINDS_END[name], prepend=0) / k) ** 2))
    runs = (np.count_nonzero(side[:, 1:] != side[:, :-1], axis=1) - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change))
    x = code - code.mean(axis=1, keepdims=True)
    power = np.sum(x * x, axis=1)
    serial = np.where(power > 0, np.sum(x[:, 1:] * x[:, :-1], axis=1) / np.where(power > 0, power, 1) * math.sqrt(n), math.inf)
    if name != "digits":  # letters alone, say
        runs = np.where((side == side[:, :1]).all(axis=1), np.minimum(runs, -math.sqrt(n)), runs)
    return uniform, runs, serial


def battery(token: str) -> tuple[float, float, float]:
    """Normal scores of the three tests, near zero for a random token: uniformity
    (high: uneven symbols), runs (low: too few) and serial correlation."""
    name = encoding_of(token)
    code = _CODE[name][np.frombuffer(token.rstrip("=").encode(), np.uint8)]
    code = code[code >= 0]
    if len(code) < 8:
        return math.inf, -math.inf, math.inf
    uniform, runs, serial = scores(code[None, :], name)
    return float(uniform[0]), float(runs[0]), float(serial[0])


def evidence(token: str) -> float:
    """How far from random the battery finds the token: the worst of its scores
    (0: nothing against randomness)."""
    uniform, runs, serial = battery(token)
    return max(0.0, uniform, -runs, abs(serial))


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def bin_of(score: float) -> int:
    return min(BINS - 1, int(min(score, 1e6) * 4))


def token_tests(text: str) -> list[tuple[int, int, int]]:
    """(start, end, cell) of each long token; the cell is the group (length class
    and form) and the evidence bin."""
    out = []
    for m in TOKEN.finditer(text):
        t = m.group()
        out.append((m.start(), m.end(), (length_class(len(t)) * len(FORMS) + form_of(t)) * BINS + bin_of(evidence(t))))
    return out


# --- ordinary text ----------------------------------------------------------

#: Dictionary words, of which ordinary tokens are made.
WORDS = """the of and to in for is on that with was as by are this from which have not one more other their some time only
when your make like first people because between through should during system number public general important information
development international government management understanding communication university department service program report
index search result update create delete value table image style script config default button header content window object
string buffer client server handle request response account customer order product region supplier water house world school
state family student group country problem hand part place case week company key query job quick box max zone june
der die und von mit ist nicht auch nach sich einer werden haben wird durch zwischen unter gegen wieder heute arbeit zeit
jahr leben welt verein gesellschaft entwicklung bundes regierung les des est une dans pour que qui pas sur plus avec sont
leur tout comme mais nous vous bien sans temps travail pays ville monde famille question los las del por para con como pero
muy todo hasta desde sobre entre cuando tiempo trabajo ciudad gobierno historia persona""".split()
HEX_WORDS = "facade decade face fade cafe bead deed feed dead beef bad bed add cab dad fed ace decaf faced added".split()
NULL_WORDS = 5_000
#: A null bin with fewer tokens continues the tail geometrically.
LEAST_TAIL = 30
NULL_SCALE = 10 ** 9


def _streams(rng: random.Random) -> list[str]:
    """Long texts of words without blanks, one per way of writing."""
    def number() -> str:
        return rng.choice((str(rng.randint(1900, 2030)), str(rng.randint(0, 99)), f"{rng.randint(0, 99):02d}", str(rng.randint(0, 9999)),
                           f"{rng.randint(1990, 2030)}{rng.randint(1, 12):02d}{rng.randint(1, 28):02d}"))

    def stream(*parts, join="") -> str:
        return join.join(rng.choice(parts)() for _ in range(NULL_WORDS))

    word = lambda: rng.choice(WORDS)
    title, upper = (lambda: word().title()), (lambda: word().upper())
    hexed = lambda: rng.choice(HEX_WORDS)
    sep = lambda: rng.choice("/-_") + word()
    return [stream(word), stream(word, join="_"), stream(word, join="-"), stream(word, join="/"), stream(word, word, number),
            stream(sep, lambda: "-" + number()), stream(title), stream(title, title, number), stream(title, word, join="-"),
            stream(sep, title, upper, number), stream(upper), stream(upper, join="_"), stream(upper, upper, number),
            stream(number), stream(number, join="-"), stream(hexed), stream(hexed, number), stream(lambda: hexed().upper()),
            stream(lambda: hexed().upper(), number)]


@functools.lru_cache(maxsize=1)
def word_null() -> dict[int, int]:
    """Histogram of ordinary tokens, with the keys of ``cut_points``: for each length
    class the evidence of word tokens of its least length (longer ones are less like
    random tokens, so p is not too small), by form."""
    hist = np.zeros((GROUPS, BINS))
    for text in _streams(random.Random(7)):
        raw = np.frombuffer(text.encode(), np.uint8)
        starts = np.unique(np.linspace(0, len(raw) - LENGTHS[-1] - 1, NULL_WORDS).astype(int))
        for c, n in enumerate(LENGTHS):
            tokens = raw[starts[:, None] + np.arange(n)]
            form = _forms(tokens)
            for f in np.unique(form):
                name = FORMS[f] if FORMS[f] in ALPHABETS else "base64"
                uniform, runs, serial = scores(_CODE[name][tokens[form == f]], name)
                worst = np.maximum(np.maximum(uniform, -runs), np.maximum(np.abs(serial), 0.0))
                hist[c * len(FORMS) + f] += np.bincount(np.minimum(worst * 4, BINS - 1).astype(int), minlength=BINS)
    out = {}
    for g, h in enumerate(hist):
        seen, total = np.cumsum(h), h.sum()
        share = seen / total
        low = int(np.argmax(seen >= LEAST_TAIL))
        ratio = share[low] / share[min(low + 1, BINS - 1)] if share[low] < 1 else 0.5
        tail = share[low] * ratio ** np.arange(low, 0, -1)
        share[:low] = np.minimum(tail, (seen[:low] + 3 + 2 * np.sqrt(seen[:low])) / total)  # an upper bound of the share
        for b, x in enumerate(np.diff(share, prepend=0)):
            out[-1 - (g * BINS + b)] = round(x * NULL_SCALE)
    return out


def _forms(tokens: np.ndarray) -> np.ndarray:
    """``form_of`` for rows of bytes."""
    has = lambda chars: np.isin(tokens, np.frombuffer(chars.encode(), np.uint8))
    lower, upper = ((tokens >= x) & (tokens <= x + 25) for x in (97, 65))
    out = np.where(lower.any(1) & upper.any(1), FORMS.index("two cases"), FORMS.index("one case")) + has(ALPHABETS["digits"]).any(1)
    for name in ("base32", "HEX", "hex", "digits"):
        out[has(ALPHABETS[name]).all(1)] = FORMS.index(name)
    return out


def _scan(texts: pa.Array) -> list:
    kinds, starts, ends, tests = [], [], [], ([], [], [])
    for t in texts.to_pylist():
        base = base_spans(t) if t else []
        kinds.append([k for _, k, _ in base])
        starts.append([s for s, _, _ in base])
        ends.append([e for _, _, e in base])
        taken = sorted((x, y) for x, _, y in base)
        begins, reach = [x for x, _ in taken], list(accumulate((y for _, y in taken), max))
        row = []
        for s, e, cell in (token_tests(t) if t else ()):
            before = bisect_left(begins, e)  # base spans that begin before the token's end
            if not before or reach[before - 1] <= s:
                row.append((s, e, cell))
        for i, out in enumerate(tests):
            out.append([r[i] for r in row])
    return [kinds, starts, ends, *tests]


SCAN_FIELDS = [StructField(n, ArrayType(IntegerType())) for n in ("kinds", "starts", "ends", "test_starts", "test_ends", "cells")]


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: base spans and battery results of the other long tokens, with
    their cell (length class, form and evidence bin)."""
    return map_text(docs.select(quoted(id).alias("doc_id"), quoted(text).alias("text")), "text", _scan, SCAN_FIELDS, keep=["doc_id"])


def thresholds(scanned: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per group (length class and form) the highest evidence bin that is a discovery.

    p of a bin: share of ordinary tokens with no more evidence against
    randomness; Benjamini-Hochberg over all of the group's tokens."""
    cells = scanned.select(F.explode("cells").alias("cell"))
    counts = {r["cell"]: r["n"] for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # groups x bins at most
    return cut_points(counts | word_null(), rate) if counts else {}


def cut_points(counts: dict[int, int], rate: float) -> dict[int, int]:
    """``counts``: tokens per cell, and ordinary tokens per cell under -1 - cell."""
    out = {}
    for g in range(GROUPS):
        tests = np.array([counts.get(g * BINS + b, 0) for b in range(BINS)], float)
        null = np.array([counts.get(-1 - (g * BINS + b), 0) for b in range(BINS)], float)
        if not null.sum() or not tests.sum():
            continue
        p = (np.cumsum(null) + 1) / (null.sum() + 1)
        ordinary = min(tests.sum(), (tests[p > 0.5].sum() + 1) / 0.5)  # Storey's estimate at one half
        ok = np.flatnonzero((tests > 0) & (p <= rate * np.cumsum(tests) / ordinary) & (p <= 0.5))
        if len(ok):
            out[g] = int(ok[-1])
    return out


def _all_spans(row, cut: dict[int, int]) -> list[tuple[int, int, int]]:
    """(start, kind index, end), sorted; the battery's kind comes last."""
    kinds, starts, ends, test_starts, test_ends, cells = row
    out = list(zip(starts, kinds, ends))
    out += [(s, len(KINDS), e) for s, e, c in zip(test_starts, test_ends, cells) if c % BINS <= cut.get(c // BINS, -1)]
    return sorted(out)


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """Per document: doc_id, base (kind:start:end texts) and spans (base and
    battery, kind ``random``), in order."""
    scanned = cut_lineage(scan(docs, id, text))
    cut = thresholds(scanned, rate)

    base = F.expr("transform(kinds, (k, i) -> struct(starts[i] as s, k, ends[i] as e))")
    test = " or ".join(["false"] + [f"(x.cell >= {c * BINS} and x.cell <= {c * BINS + b})" for c, b in cut.items()])
    extra = F.expr(f"""transform(filter(transform(cells, (c, i) -> struct(test_starts[i] as s, test_ends[i] as e, c as cell)),
        x -> {test}), x -> struct(x.s as s, {len(KINDS)} as k, x.e as e))""")
    names = "array(" + ", ".join(f"'{k}'" for k in (*KINDS, "random")) + ")"
    show = lambda c: F.expr(f"transform({c}, x -> concat_ws(':', element_at({names}, x.k + 1), x.s, x.e))")
    return (scanned.select("doc_id", base.alias("base"), extra.alias("extra"))
            .withColumn("every", F.array_sort(F.concat("base", "extra")))
            .select("doc_id", "base", show("base").alias("base_spans"), show("every").alias("spans")))


def secret_digest(found: DataFrame) -> DataFrame:
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"), F.concat_ws(",", "spans").alias("spans"))


MARK = "[SECRET]"


def redact(docs: DataFrame, id: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """``docs`` with every span found replaced by a mark; the columns stay as they are."""
    cut = thresholds(cut_lineage(scan(docs, id, text)), rate)

    def clean(texts: pa.Array) -> list:
        out = []
        for t, *row in zip(texts.to_pylist(), *_scan(texts)):
            if t:
                parts, at = [], 0
                for s, _, e in _all_spans(row, cut):
                    if e > at:
                        parts += [t[at:max(s, at)], MARK if s >= at else ""]
                        at = e
                t = "".join(parts) + t[at:]
            out.append(t)
        return [out]

    order = docs.columns
    return map_text(docs, text, clean, [StructField(text, StringType())], keep=[c for c in order if c != text]).select(*[quoted(c) for c in order])
