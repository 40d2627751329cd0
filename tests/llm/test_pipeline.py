"""The pipeline against its stages done by brute force on the same rows."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as cp  # noqa: E402

from ledgerline.llm import quality, secrets  # noqa: E402

from ..conftest import SF_SMALL  # noqa: E402
from .test_similar import components  # noqa: E402
from .test_text import base, contamination  # noqa: E402
from .test_tokens import LIBRARY  # noqa: E402


def test_stages_and_run_against_brute_force(sp, docs, tmp_path):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "byte_bpe"]
    got = {r.doc_id: r for r in cp.run(sp, SF_SMALL).collect()}
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    scores = {r.doc_id: r.score for r in quality.classify(docs, sp.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()}
    left = [(i, t) for i, t in sorted(rows.items()) if scores[i] >= quality.THRESHOLD]
    group = components(left, 5)
    left = [(i, t) for i, t in left if group[i][1] == i]
    items = [(r.item_id, r.text) for r in sp.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    dirty = {r[0] for r in contamination(left, items) if r[-1]}
    left = [(i, t) for i, t in left if i not in dirty]
    assert 0 < len(left) < len(rows) and set(got) == {i for i, _ in left}
    for i, t in left:
        text, at = [], 0
        for s, _, _, e in base(t or ""):
            if e > at:
                text += [t[at:max(s, at)], secrets.MARK if s >= at else ""]
                at = e
        text.append((t or "")[at:])
        ids = LIBRARY.encode_ordinary("".join(text))
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].n_tokens == len(ids)


def test_decontaminate_judges_each_row_by_its_text(sp, tmp_path):
    passage = " ".join(f"w{i}" for i in range(12))
    sp.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"x {passage}"), (None, "clean"), (1, f"y {passage}"), (1, "clean too"), (2, None), (None, None)]
    df = sp.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in cp.decontaminate(sp, df, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(None, "clean"), (1, "clean too"), (2, None), (None, None)], key=str)


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_stages_take_odd_rows_and_keep_the_columns(sp, odd, empty, table, tmp_path):
    df = (odd if table == "odd" else empty).drop("score")
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(sp, df, SF_SMALL)
        if k < len(cp.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        out.write.parquet(str(tmp_path / name))
        df = sp.read.parquet(str(tmp_path / name))
