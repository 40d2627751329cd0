"""Fingerprints that a fixed power-of-two modulus would confuse, in every operator that compares words by them."""

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import byte_bpe, decontam, neardup, textblock, wordpieces
from ledgerline.llm.queries import MULTILINGUAL_BPE, vocabulary

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


def twins(n):
    """Two different words of n letters whose polynomials agree modulo 2^64 for any odd base."""
    s = "a"
    while len(s) < n:
        s += s.translate({97: 98, 98: 97})
    return s, s.translate({97: 98, 98: 97})


SIZES = [1024, 2048, 4096]


@pytest.mark.parametrize("n", SIZES)
def test_span_hash_tells_them_apart(n):
    a, b = twins(n)
    buf = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    x, y, z = textblock.span_hash(textblock.prefix_sums(buf), np.array([0, n + 1, 2 * n + 2]), np.array([n, 2 * n + 1, 3 * n + 2]))
    assert x == z != y


def test_span_hash_of_every_window_is_distinct_and_place_free():
    rng = np.random.default_rng(5)
    buf = rng.integers(97, 123, 300_000).astype(np.uint8)
    at = np.arange(len(buf) - 24)
    assert len(np.unique(textblock.span_hash(textblock.prefix_sums(buf), at, at + 24))) == len(at)
    big = np.tile(buf, 60)  # longer than a slice, and than sums may grow without a remainder
    got = textblock.span_hash(textblock.prefix_sums(big), np.arange(60) * 300_000, np.arange(60) * 300_000 + 500)
    assert len(set(got.tolist())) == 1


def test_word_pieces_and_byte_bpe():
    path = vocabulary(MULTILINGUAL_BPE)
    data = byte_bpe.read_ranks(path)
    ranks = byte_bpe.parse_ranks(data)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    enc, dec = byte_bpe.coders(data)
    counter = wordpieces.PieceCounter(ranks)
    for n in SIZES:
        a, b = twins(n)
        text = f"{a}\n{b}\n{a}"
        flat, _ = enc.encode(*textblock.utf8(pa.array([text])))
        assert flat.tolist() == library.encode_ordinary(text) and dec.decode(flat) == text
    assert counter.count(twins(1024)[0].encode()) > 0


def test_word_piece_counts_of_a_table(sp):
    ranks = byte_bpe.parse_ranks(byte_bpe.read_ranks(vocabulary(MULTILINGUAL_BPE)))
    counter = wordpieces.PieceCounter(ranks)
    rows = [(n, "\n".join(twins(n))) for n in SIZES]
    got = {r.doc_id: r.n_pieces for r in wordpieces.count_pieces(sp.createDataFrame(rows, "doc_id long, text string").coalesce(1), vocabulary(MULTILINGUAL_BPE)).collect()}
    for n in SIZES:
        a, b = twins(n)
        alone = {r.doc_id: r.n_pieces for r in wordpieces.count_pieces(
            sp.createDataFrame([(0, f"{a}\nc"), (1, f"\n{b}"), (2, "\nc")], "doc_id long, text string").repartition(3, "doc_id"), vocabulary(MULTILINGUAL_BPE)).collect()}
        assert got[n] == alone[0] - alone[2] + alone[1]


def test_decontamination_and_near_duplicates(sp):
    for n in SIZES:
        a, b = twins(n)
        words = "one two three four five six seven eight nine"
        docs = sp.createDataFrame([(1, f"{words} {b}"), (2, f"{words} {a}")], "doc_id long, text string")
        found = {r.doc_id: r.n_hit for r in decontam.contamination(docs, sp.createDataFrame([(7, f"{words} {a}")], "item_id long, text string")).collect()}
        assert found == {1: 0, 2: 10}
        pair = sp.createDataFrame([(1, f"x {a} y"), (2, f"x {b} y")], "doc_id long, text string")
        assert all(r.kept for r in neardup.near_duplicates(pair, words=2).collect())


def test_rows_of_one_id_are_judged_by_their_own_text(sp):
    base = {k: [f"{k}{i}" for i in range(60)] for k in "ABCD"}
    text = {k: " ".join(w) for k, w in base.items()}
    near = {k: " ".join(w[:-1] + ["z"]) for k, w in base.items()}
    rows = [(1, text["A"]), (1, text["B"]), (2, near["B"]), (3, near["A"]), (5, text["C"]), (5, text["D"]), (5, text["D"]), (None, text["A"]), (None, text["A"])]
    df = sp.createDataFrame([(*r, "s", i) for i, r in enumerate(rows)], "doc_id long, text string, th string, n int").repartition(4)
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df, words=2).collect()), key=str)
    assert found == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (5, 5, True), (5, 5, True), (5, 5, True),
                            (None, None, True), (None, None, True)], key=str)
    left = neardup.drop_near_duplicates(df, words=2)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, text["A"]), (1, text["B"]), (5, text["C"]), (5, text["D"]), (None, text["A"]), (None, text["A"])], key=str)


def test_a_text_longer_than_a_slice(sp):
    long = " ".join(f"w{i % 9973}" for i in range(200_000))
    assert len(long) > textblock.SLICE_BYTES
    df = sp.createDataFrame([(1, long), (2, long + " tail"), (3, "short text here")], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in neardup.near_duplicates(df, words=2).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True)}


def test_spans_of_a_text_full_of_secrets_are_merged_in_linear_time():
    import time

    from ledgerline.llm import secrets

    def seconds(n):
        text = " ".join(f"password=abcdef{i:06d} Zx9QwErTy8UiOp7AsDfG{i:05d}" for i in range(n))
        t0 = time.process_time()
        got = secrets._scan(pa.array([text]))
        assert len(got[1][0]) == n and len(got[3][0]) == n
        for s, e in zip(got[3][0], got[4][0]):
            assert not text[s:e].startswith("password")
        return time.process_time() - t0
    seconds(200)
    assert seconds(12_000) < 12 * seconds(3_000)
