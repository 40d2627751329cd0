"""MinHash near-duplicate detection with an LSH forest.

A document's set holds the fingerprints of its distinct word shingles; its
signature holds 128 minimum hashes in ``TREES`` orders of ``DEPTH`` hashes each.
Documents sorted by one order form a tree: those that share a prefix share a
node. Equal sets are one class from the start. Then, by region of the forest:

1. Deep and shallow nodes: each member of a node is a candidate with the node's
   hub, the member with the most company in all orders; of a document's
   candidates, the one whose signature agrees best is checked. A node of n members
   gives n - 1 candidates, never all pairs. Checked links make components.
2. Where the shallow nodes of one hub still hold several components, the region
   is dense in texts that are alike but not linked; there, members of different
   components are compared inside one join, by three tests that leave only pairs
   that can reach the threshold: the set sizes, the 2-bit signature planes, and an
   exact upper bound of the intersection from how both sets differ from the
   hub's. What passes is checked. Pairs within one component cannot change the
   result and are left out.

Links are confirmed on the full sets. A pair at similarity s shares no shallow
node with probability (1 - s^3)^16, 1e-5 at s = 0.8.

Cases: null texts, and texts without words, have an empty set and are linked
with nothing; a text of fewer words than a shingle is one shingle; texts are
whole; ties go to the smallest id; repeated rows get equal results, and rows with
one id but several texts are judged each by its own text (a class of equal sets,
not an id, is what is linked); rows with a null id belong to no group; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from ledgerline.llm.graph import components
from ledgerline.llm.textblock import BYTE_LOWER, U64, WORD_NOT_BLANK, map_text, mix, prefix_sums, quoted, span_hash, utf8, word_spans
from ledgerline.session import cut_lineage

TREES, DEPTH = 16, 8
#: Depths at which nodes are looked up: shallow (which bounds what is found) and deep.
SHALLOW, DEEP = 3, 8
HASHES = TREES * DEPTH
SIMILARITY = 80
#: 2-bit signature symbols that may differ: expected 19.2 of 128 at similarity
#: 0.8, standard deviation 4.04; 5.6 deviations are allowed.
MISMATCHES = 42
#: Bits of the sketch of a set's difference from its hub's.
DELTA_BITS = 1024

_rng = np.random.default_rng(8)
_MULTIPLY = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * U64(2) + U64(1)
_SALT = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_prints(arr: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of each text, sorted, and the n+1 offsets."""
    buf, off = utf8(arr)
    n = len(arr)
    start, end, at = word_spans(buf, off, WORD_NOT_BLANK)
    prints = span_hash(prefix_sums(buf, BYTE_LOWER), start, end)
    count = np.diff(at)
    m = len(prints) - words + 1
    doc = np.repeat(np.arange(n), count)
    if m > 0:
        h = np.zeros(m, U64)
        for i in range(words):
            h = mix(h + prints[i:i + m])
        whole = doc[:m] == doc[words - 1:]
        h, d = h[whole], doc[:m][whole]
    else:
        h, d = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        one = np.zeros(len(short), U64)
        for i in range(words - 1):
            has = count[short] > i
            one[has] = mix(one[has] + prints[at[short[has]] + i])
        h = np.append(h, mix(one + count[short].astype(U64)))
        d = np.append(d, short)
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(d[order].astype(np.uint16), kind="stable")]
    h, d = h[order], d[order]
    new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) if len(h) else np.zeros(0, bool)
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(n + 1))


def signatures(prints: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minimum hashes (texts with a set only): rows x HASHES, 32 bits each."""
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), HASHES), np.uint32)
    for k in range(HASHES):
        h = ((prints ^ _SALT[k]) * _MULTIPLY[k]) >> U64(32)
        out[:, k] = np.minimum.reduceat(h, starts)
    return out


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)


SKETCH = [StructField("n", LongType()), StructField("same", LongType()), StructField("nodes", ArrayType(LongType())),
          StructField("planes", ArrayType(LongType()))]


def _sketcher(words: int):
    def work(arr: pa.Array) -> list:
        prints, at = shingle_prints(arr, words)
        size = np.diff(at)
        some = np.flatnonzero(size > 0)
        n = len(arr)
        none = size == 0
        if not len(some):
            empty = pa.array([None] * n, pa.list_(pa.int64()))
            return [pa.array(size, pa.int64()), pa.array([None] * n, pa.int64()), empty, empty]
        sig = signatures(prints, at)
        same = np.zeros(n, np.int64)
        same[some] = _same(prints, at)
        nodes = np.empty((len(some), 2 * TREES), np.int64)
        for t in range(TREES):
            h = np.full(len(some), t, U64)
            for d in range(DEEP):
                h = mix(h + sig[:, t * DEPTH + d].astype(U64))
                if d + 1 == SHALLOW:
                    nodes[:, t] = h.view(np.int64) & ~np.int64(1)  # even: shallow, odd: deep
            nodes[:, TREES + t] = h.view(np.int64) | np.int64(1)
        mixed = sig * np.uint32(0x9E3779B1)
        planes = np.hstack([_pack(mixed >> 31 & 1), _pack(mixed >> 30 & 1)])

        def lists(values):
            cuts = np.append(0, np.cumsum(np.where(none, 0, values.shape[1]))).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(cuts), pa.array(values.ravel()), mask=pa.array(none))
        return [pa.array(size, pa.int64()), pa.array(same, mask=none), lists(nodes), lists(planes)]
    return work


def _same(prints: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Fingerprint of each non-empty set."""
    some = np.diff(at) > 0
    return np.add.reduceat(mix(prints), at[:-1][some]).view(np.int64) if some.any() else np.zeros(0, np.int64)


def _class_key():
    """What stands for a class of equal sets: its fingerprint and size in 63 bits."""
    return F.shiftrightunsigned(F.xxhash64("same", "n"), 1)


def shingle_sets(need: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(id, set) of the classes ``need`` (id); the texts are found by the classes'
    smallest document ids, and told from others of the same id by their set."""
    def work(arr: pa.Array) -> list:
        prints, at = shingle_prints(arr, words)
        same = np.zeros(len(arr), np.int64)
        same[np.diff(at) > 0] = _same(prints, at)
        return [pa.array(same), pa.array(np.diff(at), pa.int64()),
                pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(prints.view(np.int64)))]

    wanted = need.join(classes.select(F.col("rep").alias("id"), "doc"), "id")
    texts = docs.join(wanted.select(F.col("doc").alias("id")).distinct(), "id", "left_semi")
    fields = [StructField("same", LongType()), StructField("n", LongType()), StructField("set", ArrayType(LongType()))]
    sets = map_text(texts, "text", work, fields, keep=[]).where("n > 0").select(_class_key().alias("id"), "set")
    return sets.join(need, "id", "left_semi").groupBy("id").agg(F.first("set").alias("set"))


def _alike(a: str, b: str):
    """Sizes and signature planes still allow the threshold."""
    col = lambda s, x: F.col(f"{s}.{x}")
    differ = sum(F.bit_count(col(a, "planes")[i].bitwiseXOR(col(b, "planes")[i]).bitwiseOR(
        col(a, "planes")[i + 2].bitwiseXOR(col(b, "planes")[i + 2]))) for i in range(2))
    small, large = F.least(col(a, "n"), col(b, "n")), F.greatest(col(a, "n"), col(b, "n"))
    return (small * 100 >= large * SIMILARITY) & (differ <= MISMATCHES), differ


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = shingle_sets(need, classes, docs, words)
    found = (pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
             .join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
             .withColumn("i", F.size(F.array_intersect("x", "y"))))
    return found.where(F.col("i") * 100 >= (F.size("x") + F.size("y") - F.col("i")) * SIMILARITY).select("a", "b")


def deltas(members: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """For (hub, rep): how the set of ``rep`` differs from its hub's. ``gone`` and
    ``new`` are the sizes of both differences, ``bits`` their elements hashed into
    ``DELTA_BITS`` bits, ``lost`` the elements that share a bit with another."""
    need = members.select(F.explode(F.array("hub", "rep")).alias("id")).distinct()
    sets = shingle_sets(need, classes, docs, words)
    both = (members.join(sets.select(F.col("id").alias("hub"), F.col("set").alias("h")), "hub")
            .join(sets.select(F.col("id").alias("rep"), F.col("set").alias("s")), "rep"))

    def run(batches):
        for b in batches:
            for i in range(0, len(b), 512):
                part = b.slice(i, 512)
                gone, new, bits, lost = [], [], [], []
                for h, s in zip(part.column(2), part.column(3)):
                    h, s = h.values.to_numpy(), s.values.to_numpy()
                    out, in_ = np.setdiff1d(h, s, assume_unique=True), np.setdiff1d(s, h, assume_unique=True)
                    at = mix(np.append(out.view(U64), in_.view(U64) ^ U64(0x5555555555555555))) % U64(DELTA_BITS)
                    flag = np.zeros(DELTA_BITS, bool)
                    flag[at.astype(np.int64)] = True
                    gone.append(len(out))
                    new.append(len(in_))
                    bits.append(np.packbits(flag).view(np.int64))
                    lost.append(len(at) - int(flag.sum()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(gone, pa.int64()), pa.array(new, pa.int64()),
                                                  pa.array(bits, pa.list_(pa.int64())), pa.array(lost, pa.int64())],
                                                 names=["rep", "hub", "gone", "new", "bits", "lost"])
    return both.select("rep", "hub", "h", "s").mapInArrow(run, "rep long, hub long, gone long, new long, bits array<long>, lost long")


def _may_link(a: str, b: str):
    """Whether two sets with the same hub can still reach the threshold. With
    |a & b| = n(a) - new(a) - gone(b) + the elements both differences share, the
    shared bits (plus those lost to equal bits) bound the intersection from above."""
    col = lambda s, x: F.col(f"{s}.{x}")
    shared = sum(F.bit_count(col(a, "bits")[i].bitwiseAND(col(b, "bits")[i])) for i in range(DELTA_BITS // 64))
    most = col(a, "n") - col(a, "new") - col(b, "gone") + shared + F.least(col(a, "lost"), col(b, "lost"))
    return most * 100 >= (col(a, "n") + col(b, "n") - most) * SIMILARITY


def grouped(docs: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """(id, th, n, label, component) of every row: the hash of its text, the size of
    its set, the group its set belongs to and the smallest id in that group
    (both null for a null id or an empty set)."""
    docs = docs.select(quoted(id).cast("long").alias("id"), quoted(text).cast("string").alias("text"))
    sketched = map_text(docs.withColumn("th", F.xxhash64("text")), "text", _sketcher(words), SKETCH, keep=["id", "th"])
    sketched = cut_lineage(sketched.withColumn("rep", F.when(F.col("same").isNotNull() & F.col("id").isNotNull(), _class_key())))
    classes = cut_lineage(sketched.where("rep is not null").groupBy("rep").agg(
        F.min("id").alias("doc"), F.first("n").alias("n"), F.first("nodes").alias("nodes"), F.first("planes").alias("planes")))
    members = classes.select("rep", F.explode("nodes").alias("node"))
    crowded = members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    # only members of nodes with company, from here on
    members = cut_lineage(members.join(crowded, "node").select("node", "rep", "size"))
    # the hub of a node is its member with the most company in all orders: of a
    # text and its edited copies, that is the text they come from
    company = members.groupBy("rep").agg(F.sum("size").alias("company"))
    ranked = members.select("node", "rep").join(company, "rep")
    hubs = ranked.groupBy("node").agg(F.max(F.struct("company", (-F.col("rep")).alias("low"))).alias("m")).select("node", (-F.col("m.low")).alias("hub"))
    members = cut_lineage(members.select("node", "rep").join(hubs, "node"))
    narrow = classes.select("rep", "n", "planes")
    near = members.where("rep <> hub").select("rep", "hub").distinct()
    x, y = narrow.alias("x"), narrow.alias("y")
    ok, differ = _alike("x", "y")
    near = (near.join(x, F.col("hub") == F.col("x.rep")).join(y, near["rep"] == F.col("y.rep")).where(ok)
            .groupBy(near["rep"].alias("b")).agg(F.min(F.struct(differ.alias("differ"), F.col("hub").alias("a"))).alias("best")))
    first = near.select(F.least("best.a", "b").alias("a"), F.greatest("best.a", "b").alias("b")).distinct()
    links = cut_lineage(confirm(cut_lineage(first), classes, docs, words))
    joined = components(links)
    # hubs whose company still holds several components; members of one node have
    # one hub, so going by hubs compares all they would, and each pair once a hub
    labelled = (members.where(F.col("node").bitwiseAND(F.lit(1)) == 0).select("hub", "rep").distinct()
                .join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left")
                .select("hub", "rep", F.coalesce("component", "rep").alias("component")))
    open_hubs = labelled.groupBy("hub").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("hub")
    regions = cut_lineage(labelled.join(open_hubs, "hub").join(narrow, "rep"))
    x, y = regions.alias("x"), narrow.alias("y")
    ok, _ = _alike("x", "y")
    # texts far from their hub keep only the sketch test: their differences say little
    close = x.join(y, F.col("x.hub") == F.col("y.rep")).where(ok).select(F.col("x.hub").alias("hub"), F.col("x.rep").alias("rep"))
    delta = cut_lineage(deltas(cut_lineage(close), classes, docs, words))
    regions = cut_lineage(regions.join(delta, ["hub", "rep"], "left"))
    x, y = regions.alias("x"), regions.alias("y")
    ok, _ = _alike("x", "y")
    bound = F.coalesce(_may_link("x", "y"), F.lit(True))
    cross = (x.join(y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.component") < F.col("y.component")) & ok & bound)
             .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct())
    more = cut_lineage(confirm(cut_lineage(cross), classes, docs, words))
    if not more.isEmpty():
        joined = components(links.union(more))
    # every row's class, then the class's group and the smallest id in it
    part = classes.select("rep", "doc").join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "rep", "doc", F.coalesce("component", "rep").alias("label"))
    least = part.groupBy("label").agg(F.min("doc").alias("component"))
    part = part.join(least, "label").select("rep", "label", "component")
    rows = sketched.select("id", "th", "n", "rep")
    found = rows.where("rep is not null").join(part, "rep").select("id", "th", "n", "label", "component")
    nothing = F.lit(None).cast("long")
    return found.unionByName(rows.where("rep is null").select("id", "th", "n", nothing.alias("label"), nothing.alias("component")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 2) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    found = grouped(docs, id, text, words)
    return (found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """One document of each group stays: the one with the smallest id (of several
    texts with that id, the smallest hash), one row of it; columns unchanged. Rows
    of one id with texts of different groups stay each. Rows with a null id belong
    to no group and stay; other rows that repeat an id and a text without words
    stay once."""
    found = cut_lineage(grouped(docs, id, text, words).where("id is not null").select("id", "th", "label"))
    # an (id, text) is in one group, so what stays is told by that, and a large group is no hot key
    first = found.where("label is not null").groupBy("label").agg(F.min(F.struct("id", "th")).alias("first")).select("first.id", "first.th")
    gone = found.where("label is not null").join(first, ["id", "th"], "left_anti").select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), F.lit(False).alias("__more"))
    # a kept (id, text) on several rows: one of them stays
    more = found.groupBy("id", "th").agg(F.count("*").alias("rows")).where("rows > 1").select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), F.lit(True).alias("__more"))
    told = cut_lineage(gone.unionByName(more).groupBy("__id", "__th").agg(F.min("__more").alias("__more")))

    def rows(which: DataFrame, how: str) -> DataFrame:
        same = (quoted(id).cast("long") == which["__id"]) & (F.xxhash64(quoted(text).cast("string")) == which["__th"])
        return docs.join(which, same, how)
    single = rows(told, "left_anti")
    repeated = told.where("__more")
    if repeated.isEmpty():
        return single
    key = [quoted(id).cast("long"), F.xxhash64(quoted(text).cast("string"))]
    several = rows(repeated, "left_semi").groupBy(key[0].alias("i"), key[1].alias("t")).agg(F.min(F.struct(*[quoted(c) for c in docs.columns])).alias("d"))
    return single.unionByName(several.select("d.*"))
