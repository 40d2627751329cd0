"""Near-duplicates, repeated strings, nearest neighbours: against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import graph, neardup, neighbours, repeats
from ledgerline.llm.queries import QUERIES

from ..conftest import SF_SMALL

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def components(rows, k):
    sets, up, inv = {}, {}, defaultdict(list)
    for i, t in rows:
        w = WORD.findall((t or "").encode().lower())
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        up[i] = i

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in sorted(sets):
        n = Counter(j for s in sets[i] for j in inv[s])
        for s in sets[i]:
            inv[s].append(i)
        for j, both in n.items():
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(df, rows, k):
    want = components(rows, k)
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_of_the_whole_table(sp, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(QUERIES["op8_neardup"](sp, SF_SMALL), rows, 2)


def test_chains_stars_and_borderline_pairs(sp):
    """Copies with growing edits: stars around a text, chains of copies of copies,
    and pairs just below and above the threshold."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, n = [], 0
    for _ in range(4):
        base = [word() for _ in range(60)]
        chain = base
        for step in range(25):
            star = [w if rng.random() > 0.12 * rng.random() else word() for w in base]
            chain = [w if rng.random() > 0.04 else word() for w in chain]
            for t in (star, chain):
                rows.append((n, " ".join(t)))
                n += 1
        rows.append((n, " ".join(base)))  # the origin has the largest id of its group
        n += 1
    rng.shuffle(rows)
    check(neardup.near_duplicates(sp.createDataFrame(rows, "doc_id long, text string"), words=2), rows, 2)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = {r.doc_id: r for r in neardup.near_duplicates(odd, words=2).collect() if r.doc_id is not None}
    assert all(got[i].n_shingles == 0 and got[i].kept for i in (0, 1, 2, 3))
    assert got[4].n_shingles == 1 and got[12].component_id == 11 and not got[12].kept
    assert neardup.near_duplicates(odd, words=2).count() == odd.count()
    assert neardup.near_duplicates(empty, words=2).count() == 0
    left = neardup.drop_near_duplicates(odd, words=2)
    assert left.columns == odd.columns and left.where("doc_id is null").count() == 1 and left.where("doc_id = 3").count() == 1


def test_components_of_long_chains(sp):
    edges = sp.range(0, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(sp.createDataFrame([(1000, 1001)], "a long, b long"))
    got = {r.id: r.component for r in graph.components(edges).collect()}
    assert set(got.values()) == {0, 1000} and len(got) == 303
    assert graph.components(edges.limit(0)).count() == 0


def test_delta_bound_never_cuts_a_link():
    """The upper bound of the intersection holds for any three sets."""
    rng = random.Random(3)
    for _ in range(300):
        hub = set(rng.sample(range(400), 120))
        x, y = (set(rng.sample(sorted(hub), 100)) | {rng.randrange(800) for _ in range(rng.randrange(40))} for _ in range(2))
        gone, new = len(hub - y), len(x - hub)
        tag = lambda s: {("g", e) for e in hub - s} | {("n", e) for e in s - hub}
        bits = lambda s: {hash(t) % 64 for t in tag(s)}
        lost = min(len(tag(s)) - len(bits(s)) for s in (x, y))
        assert len(x) - new - gone + len(bits(x) & bits(y)) + lost >= len(x & y)


# ------------------------------------------------------------------ repeated strings

def cut(rows, m):
    data = [(i, (t or "").encode()) for i, t in rows]
    n = Counter(b[j:j + m] for _, b in data for j in range(len(b) - m + 1))
    out = []
    for i, b in data:
        cover = bytearray(len(b))
        for j in range(len(b) - m + 1):
            if n[b[j:j + m]] > 1:
                cover[j:j + m] = b"\1" * m
        keep = bytes(x for x, c in zip(b, cover) if not c)
        spans = sum(c and not p for p, c in zip(b"\0" + bytes(cover), cover))
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(keep).hexdigest()))
    return sorted(out, key=str)


def repeats_of(df, m):
    got = repeats.repeat_digest(repeats.remove_repeats(df, length=m)).collect()
    assert all(r.repeated == (r.n_removed > 0) and r.removed_share == (r.n_removed / r.n_bytes if r.n_bytes else 0) for r in got)
    return sorted((tuple(r)[:5] for r in got), key=str)


def test_repeats_of_the_whole_table(sp, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r)[:5] for r in QUERIES["op4_repeats"](sp, SF_SMALL).collect()), key=str)
    assert got == cut(rows, 400)


@pytest.mark.parametrize("m", [50, 400])
def test_repeats_of_periodic_and_edited_texts(sp, m):
    rng = random.Random(m)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop é") for _ in range(n))
    passage = text(3 * m)
    rows = [(0, "a" * (3 * m)), (1, "ab" * m), (2, text(m) + passage + text(m)), (3, passage[m // 2:] + text(m)), (4, text(2 * m)),
            (5, passage[:m]), (6, passage[:m - 1]), (7, "Eroresat " * m), (8, None), (9, ""), (10, text(2 * m) * 2), (11, "a" * (m + 1)), (12, "a" * m),
            (13, passage), (13, passage), (None, text(2 * m))]
    for k in range(8):  # copies with single edits
        at = rng.randrange(3 * m)
        rows.append((20 + k, passage[:at] + "#" + passage[at + 1:]))
    df = sp.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert repeats_of(df, m) == cut(rows, m)


def test_repeats_of_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert repeats_of(odd, 400) == cut(rows, 400)
    assert repeats.remove_repeats(empty).count() == 0


# ------------------------------------------------------------------ nearest neighbours

def test_recall_and_scores(sp):
    e = sp.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    got = QUERIES["op1_nearest"](sp, SF_SMALL).toPandas()
    x = np.stack(e.embedding).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for q in e.vec_id[e.vec_id % 50 == 0]:
        row = int(np.flatnonzero(e.vec_id == q)[0])
        s = u @ u[row]
        s[row] = -9
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and q not in set(mine.vec_id)
        assert np.allclose(mine.score, [s[e.vec_id == v][0] for v in mine.vec_id], atol=1e-12)
        hit += len(set(mine.vec_id) & set(e.vec_id.values[np.argsort(-s, kind="stable")[:5]]))
        total += 5
    assert hit >= 0.9 * total


def test_ties_bad_vectors_and_many_cells(sp):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(50)]  # one vector many times
    rows += [(5000, None), (5001, [0.0] * 6), (5002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5003, [float("nan")] * 6), (5004, [1.0, 2.0]), (None, [1.0] * 6), (1000, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    v = sp.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(v, v.where("vec_id in (1000, 1049, 5, 5000, 5001, 5003)"), cell_rows=40).toPandas()
    assert set(got.query_id) == {1000, 1049, 5}
    assert got[got.query_id == 1000].sort_values("rank").vec_id.tolist() == [1001, 1002, 1003, 1004, 1005]
    assert got[got.query_id == 1049].sort_values("rank").vec_id.tolist() == [1000, 1001, 1002, 1003, 1004]
    few = sp.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert neighbours.nearest(few, few).groupBy("query_id").count().where("count <> 2").count() == 0
    assert neighbours.nearest(v.limit(0), v).count() == 0
