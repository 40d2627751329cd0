import pytest

from ledgerline.llm.queries import ship

from ..conftest import SF_SMALL


@pytest.fixture(scope="session")
def sp(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def docs(sp):
    return sp.read.parquet(f"{SF_SMALL}/documents.parquet")


#: Texts that any operator on texts must take: null, empty, blanks, symbols,
#: other scripts, a long one, and rows that repeat.
ODD = [None, "", " ", "\n\t ", "a", "A b", "!!!", "été Straße", "日本語 テスト", "x" * 5000, "word " * 3000, "a b c d e f g h i j k", "a b c d e f g h i j k"]


@pytest.fixture(scope="session")
def odd(sp):
    rows = [(i, t, "zz", "s", 7, 1.5) for i, t in enumerate(ODD)] + [(None, "no id", "en", None, None, None), (3, "\n\t ", "zz", "s", 7, 1.5)]
    return sp.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
