"""Byte-level BPE, word pieces: against the reference tokenizer library and plain greedy matching."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import byte_bpe as B
from ledgerline.llm import wordpieces as W
from ledgerline.llm.queries import MULTILINGUAL_BPE, QUERIES, vocabulary
from ledgerline.llm.textblock import utf8

from ..conftest import SF_SMALL

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
DATA = B.read_ranks(vocabulary(MULTILINGUAL_BPE))
RANKS = B.parse_ranks(DATA)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ours(texts):
    enc, _ = B.coders(DATA)
    flat, at = enc.encode(*utf8(pa.array(texts, pa.string())))
    return [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abcdehinorst's'\n  \t!.,09ſ\x1c"), st.characters(codec="utf-8")), max_size=40), max_size=8))
def test_ids_equal_the_library_and_decode_back(texts):
    _, dec = B.coders(DATA)
    got = ours(texts)
    assert got == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [dec.decode(np.array(g, np.uint32), chunk=3) for g in got] == texts


def test_pieces_of_the_vocabulary_glued_together():
    rng = random.Random(1)
    voc = list(RANKS)
    texts = [b"".join(rng.choice(voc) for _ in range(rng.randint(1, 6))).decode("utf8", "replace") for _ in range(3000)]
    assert ours(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_small_state_and_pair_limits_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(B, "MAX_STATES", 50)
    monkeypatch.setattr(B, "MAX_PAIRS", 20)
    fst = B.Transducer(RANKS)
    words = [w.encode() for w in ("thereafter", "andthereofthing", "querying", "été", "x" * 300, "thereupon")]
    for _ in range(3):
        for w in words:
            want = LIBRARY.encode_ordinary(w.decode())
            assert next(fst.encode_words([w])) == want


def test_invalid_utf8_survives_decoding():
    _, dec = B.coders(DATA)
    ids = np.array([RANKS[bytes([b])] for b in (0x41, 0xFF, 0xC3, 0x41, 0xC3, 0xA9)], np.uint32)
    assert dec.decode(ids, chunk=1).encode("utf-8", "surrogateescape") == bytes((0x41, 0xFF, 0xC3, 0x41, 0xC3, 0xA9))


def test_query_equals_the_library_on_the_whole_table(sp, docs):
    got = {r.doc_id: r for r in QUERIES["op6_byte_bpe"](sp, SF_SMALL).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = LIBRARY.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_odd_rows_and_empty_table(odd, empty):
    path = vocabulary(MULTILINGUAL_BPE)
    rows = B.encode_decode(odd.withColumnRenamed("score", "ids"), path).collect()
    assert len(rows) == odd.count()
    for r in rows:  # the computed column wins over one of the same name
        assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert B.encode_decode(empty, path).count() == 0


def greedy(word, voc, longest):
    n = i = 0
    while i < len(word):
        j = next((j for j in range(min(len(word), i + longest), i, -1) if word[i:j] in voc), None)
        if j is None:
            return 1
        n, i = n + 1, j
    return n


def greedy_wordpiece(word, voc, prefix=b"##"):
    n = i = 0
    while i < len(word):
        head = prefix if i else b""
        j = next((j for j in range(len(word), i, -1) if head + word[i:j] in voc), None)
        if j is None:
            return 1
        n, i = n + 1, j
    return n


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=4), max_size=8), st.sets(st.text("ab", min_size=1, max_size=4), max_size=8), st.text("ab", max_size=14))
def test_automaton_equals_greedy_matching(starts, inner, word):
    w = word.encode()
    voc = {p.encode() for p in starts}
    assert W.PieceCounter(voc).count(w) == (greedy(w, voc, 4) if w else 0)
    both = voc | {b"##" + p.encode() for p in inner}
    assert W.PieceCounter(both, b"##").count(w) == (greedy_wordpiece(w, both) if w else 0)


def test_counts_of_the_whole_table(sp, docs):
    regex = pytest.importorskip("regex")
    longest, memo = max(map(len, RANKS)), {}
    got = {r.doc_id: r for r in QUERIES["op3_wordpieces"](sp, SF_SMALL).collect()}
    for r in docs.select("doc_id", "text").collect():
        words = regex.findall(P.PATTERN, r.text or "")
        n = [memo.setdefault(w, greedy(w.encode(), RANKS, longest)) for w in words]
        assert (got[r.doc_id].n_words, got[r.doc_id].n_pieces, got[r.doc_id].max_pieces) == (len(words), sum(n), max(n, default=0))


def test_piece_counts_of_odd_rows(odd, empty):
    path = vocabulary(MULTILINGUAL_BPE)
    rows = W.count_pieces(odd, path).collect()
    assert len(rows) == odd.count() and all(r.n_pieces >= r.n_words for r in rows)
    assert all(r.n_words == 0 for r in rows if r.doc_id in (0, 1))
    assert W.count_pieces(empty, path).count() == 0
