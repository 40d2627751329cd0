"""Filter audit and spelling variants against plain brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import filter_audit as A
from ledgerline.llm import spelling as S
from ledgerline.llm.queries import ORACLES, QUERIES

from ..conftest import SF_SMALL
from ..oracle_compare import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fails(text):
    words = WORD.findall(text)
    capitals = sum("A" <= c <= "Z" for c in text)
    return (("A" if len(words) < 200 else "") + ("B" if 100 * len(set(words)) < 50 * len(words) else "")
            + ("C" if 100 * capitals > 2 * len(text) else "") + ("D" if re.search("[#$%&*|]", text) else ""))


def plain_audit(docs, labels):
    """docs: (id, text, part); labels: (id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for part in {p or "" for _, _, p in docs}:
        mine = [(plain_fails(t or "") + ("E" if i is not None and first[t or ""] < i else ""), i in good, i in toxic)
                for i, t, p in docs if (p or "") == part]
        steps, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                failing = sum(f in d[0] for d in mine)
                shapley[f] += len(gone)
                steps.append([part, "".join(order), k + 1, len(left), len(gone), failing - len(gone), sum(d[0] == f for d in mine),
                              sum(d[1] for d in gone), sum(d[2] for d in gone)])
        rows += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(rows)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_of_hand_made_rows(sp):
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", long, long + " #", long.upper(), "same " * 300, "SAME " * 300, "x\x1cy z", "A" * 10, long]
    rng = random.Random(3)
    docs = [(rng.choice([*range(40), None]), rng.choice(texts), rng.choice([None, "", "web", "news"])) for _ in range(300)]
    labels = [(rng.choice([*range(60), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    d = sp.createDataFrame([(*r, 1, 2, "z") for r in docs], "doc_id long, text string, source string, id int, mask int, digest string")
    lab = sp.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, id int")
    got = A.audit(d, lab)
    assert got.columns == AUDIT
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)
    assert A.audit(d.limit(0), lab).count() == 0
    only_docs = A.audit(d, lab.limit(0)).agg({"good_lost": "sum"}).first()[0]
    assert only_docs == 0


def test_audit_query_equals_its_sql(sp):
    assert "op11_filter_audit" in ORACLES
    assert compare(sp, "op11_filter_audit", SF_SMALL, duck(SF_SMALL))


def test_positional_counts_of_any_length():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000, 40_000):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        c = A.PositionalCount()
        for part in np.array_split(words, 3):
            c.add(part)
        assert c.counts().tolist() == [int((words >> i & 1).sum()) for i in range(32)]
        assert all(len(rows) <= 2 for rows in c.weights)


def test_words_of_long_texts_in_pieces(monkeypatch):
    rng = random.Random(4)
    for _ in range(50):
        t = "".join(rng.choice("ab \n\x0b\x1cé") for _ in range(rng.randint(0, 200))) + "c" * rng.randint(0, 60)
        want = (len(WORD.findall(t)), len(set(WORD.findall(t))))
        monkeypatch.setattr(A, "PIECE", rng.randint(1, 40))
        assert A.distinct_words(t.encode()) == want


def test_more_parts_than_a_task_holds(sp, monkeypatch):
    docs = sp.range(500).selectExpr("id as doc_id", "'a b' as text", "cast(id % 97 as string) as source")
    labels = sp.createDataFrame([], "doc_id long, quality int, toxic int")
    got = A.audit(docs, labels).where("filter_order = 'ABCDE' and step = 1").agg({"removed": "sum", "part": "count"}).first()
    assert got.asDict() == {"sum(removed)": 500, "count(part)": 97}


# ------------------------------------------------------------------ spelling variants

def near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = (x, y) if len(x) > len(y) else (y, x)
    return len(x) == len(y) + 1 and any(x[:i] + x[i + 1:] == y for i in range(len(x)))


def plain_vocabulary(docs):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def plain_variants(n):
    halves = defaultdict(set)  # any two near words share a half up to a shift of one
    for w in n:
        for i in range(len(w) + 1):
            halves[w[:i], w[i + 1:]].add(w)
            halves[w[:i], w[i:]].add(w)
    best, count = {}, {}
    for w in n:
        others = {y for i in range(len(w) + 1) for key in ((w[:i], w[i + 1:]), (w[:i], w[i:])) for y in halves[key] if near(w, y)}
        count[w] = len(others)
        if others:
            y = min(others, key=lambda y: (-n[y], y))
            if n[y] >= 5 * n[w]:
                best[w] = y
    out = []
    for w in n:
        root = w
        while root in best:
            root = best[root]
        form = best.get(w)
        out.append((w, form, root, n[w], count[w], n.get(form)))
    return sorted(out, key=str)


@pytest.mark.parametrize("depth,limit", [(3, 5000), (1, 3), (2, 1)])
def test_variants_of_made_up_words(sp, depth, limit):
    rng = random.Random(depth)
    base = ["aaaaaaaaaaaaaaaaaa", "banana", "bananas", "bananan", "ananas", "çàéèêëìî", "Ünderbar", "wordword", "wordwordword"]
    docs = []
    for i in range(60):
        words = []
        for _ in range(80):
            w = rng.choice(base)[:rng.choice([5, 6, 7, 30, 30])]
            k, how = rng.randrange(len(w)), rng.random()
            w = w[:k] + w[k + 1:] if how < .15 else w[:k] + rng.choice("abz") + w[k:] if how < .3 else w[:k] + "b" + w[k + 1:] if how < .4 else w
            words.append(w if rng.random() < .8 else w.upper())
        docs.append((rng.choice([i, None, 7]), rng.choice([" ", "1", "-"]).join(words)))
    docs += [(5, None), (6, ""), (None, "x" * 40), *[(k, "banana " * 400) for k in range(10)]]
    df = sp.createDataFrame([(*d, 1, "w") for d in docs], "doc_id long, text string, n int, word string")
    got = sorted((tuple(r) for r in S.variants(df, depth=depth, limit=limit).collect()), key=str)
    assert got == plain_variants(plain_vocabulary(docs))
    assert any(r[1] for r in got) and any(r[2] not in (r[0], r[1]) for r in got), "no chain of forms in the fixture"
    assert S.variants(df.limit(0)).count() == 0


def test_no_hash_without_an_id(sp):
    """Runs that the hash of an id would cut stay whole where the id is null."""
    runs = [w for w in ("".join(p) for p in itertools.product("abc", repeat=7)) if zlib.crc32(f":{w}".encode()) % 199 == 0][:3]
    cut = next(w for w in ("".join(p) for p in itertools.product("abc", repeat=7)) if zlib.crc32(f"7:{w}".encode()) % 199 == 0)
    assert len(runs) == 3
    at = zlib.crc32(f"7:{cut}".encode()) % 7
    docs = sp.createDataFrame([(None, " ".join(runs * 5)), (7, " ".join([cut] * 5))], "doc_id long, text string")
    got = {r.word: r.n for r in S.vocabulary(docs).collect()}
    assert got == {**dict.fromkeys(runs, 5), cut[:at] + cut[at + 1:]: 5}


def test_variants_query_equals_brute_force(sp, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = QUERIES["op12_spelling"](sp, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_variants(plain_vocabulary(rows))


def test_acceptor_is_minimal_and_pairs_come_once():
    rng = random.Random(2)
    for t in range(120):
        words = {"".join(rng.choice("ab" if t % 2 else "abc") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 50))}
        a = S.Acceptor(sorted(words))
        pairs = [tuple(sorted(p)) for p in a.one_edit_pairs()]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {(x, y) for x, y in itertools.combinations(sorted(words), 2) if near(x, y)}
        live, stack = set(), [0]
        while stack:
            q = stack.pop()
            if q not in live:
                live.add(q)
                stack += a.arcs[q].values()
        rights = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
        assert len(live) == len(rights)


def test_roots_follow_long_chains(sp):
    links = sp.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    got = {r.word: r.root for r in S.roots(links, 5 * 5 ** 9).collect()}
    assert got == {f"w{i}": "w9" for i in range(9)}
    assert math.isclose(S.FORM_RATIO, 5)
