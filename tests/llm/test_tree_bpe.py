"""BPE by tree concatenation against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import tree_bpe as T
from ledgerline.llm.queries import QUERIES, WORD_BPE, vocabulary

from ..conftest import SF_SMALL
from .conftest import ODD

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary(WORD_BPE)
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def enc():
    return T.encoder(T.read_model(PATH))


def check(enc, texts):
    for t, want in zip(texts, LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        packed = enc.encode(t)
        assert np.frombuffer(packed, "<i4").tolist() == want.ids, repr(t)[:200]
        assert enc.decode(packed) == LIBRARY.decode(want.ids, skip_special_tokens=False)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abcdehinorst's'ΑΣς  \n\t!.,09ſ\x1c\x85İ"), st.characters(codec="utf-8")), max_size=40), max_size=8))
def test_any_text(enc, texts):
    check(enc, texts)


def test_special_tokens_and_normalisation(enc):
    check(enc, [*ODD, "<|endoftext|>", "a<|startoftext|>b<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext|", "é <|endoftext|>́e",
                "ΑΣ ΣΑΣ", "İSTANBUL", "ﬁ ǅ ²½", "ՠ a՘b \U0001e900", "𝒜𝒷𝒸" * 40])


def test_long_unsplit_text(enc):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdeinorst") for _ in range(rng.choice([33, 64, 65, 66, 500, 4000]))) for _ in range(150)]
    texts += [rng.choice(["a", "ab", "the", "ing", "ha", "é", "日", "=", "-="]) * rng.choice([40, 100, 1000, 3333]) + rng.choice(["", "x", "b"]) for _ in range(100)]
    pieces = [t.replace("</w>", "") for t in LIBRARY.get_vocab()]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(5, 200))) for _ in range(400)]
    before = enc.merger.n_grown
    check(enc, texts)
    assert enc.merger.n_grown > before, "no window grew"


def test_a_text_of_over_a_megabyte(enc):
    rng = random.Random(6)
    check(enc, ["".join(rng.choice("abcdefghij") for _ in range(1_100_000)), "word " * 250_000])


def test_small_store_does_not_change_ids(enc, monkeypatch):
    monkeypatch.setattr(T, "MAX_WORDS", 3)
    rng = random.Random(7)
    check(enc, [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "x" * 90, "<|endoftext|>", "epsilon"]) for _ in range(30)) for _ in range(60)])


def test_plain_and_queued_merging_agree(enc):
    rng = random.Random(8)
    for _ in range(200):
        s = [rng.choice(enc.inner[97:102]) for _ in range(rng.randint(1, 60))]
        assert enc.merger.plain(s) == enc.merger._queued(s)
        assert enc.merger.symbols(enc.merger.plain(s)) == s


def test_odd_rows_empty_table_and_clashing_columns(sp, odd, empty):
    odd = odd.withColumnRenamed("score", "ids").withColumnRenamed("lang", "decoded")
    got = T.encode_decode(odd, PATH)
    assert got.columns == ["doc_id", "text", "source", "n_chars", "ids", "decoded"]
    want = sorted((r.doc_id is None, r.doc_id, LIBRARY.encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect())
    assert sorted((r.doc_id is None, r.doc_id, r.ids) for r in got.collect()) == want
    assert T.encode_decode(empty, PATH).count() == 0


def test_query_equals_the_library_on_the_whole_table(sp, docs):
    got = {r.doc_id: r for r in QUERIES["op13_tree_bpe"](sp, SF_SMALL).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
