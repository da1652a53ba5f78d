import pytest

from adspindle.llm.ship import ship_package
from adspindle.sources.workspace import Workspace

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture()
def make_docs(spark):
    """Documents from texts, or from (doc_id, text, lang, source); with columns whose names clash."""

    def make(rows, stored=None):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            doc_id, text, lang, source = (*row, "en", "a")[:4] if len(row) == 2 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text), 1.5, "x"))
        df = spark.createDataFrame(full, f"{DOCS}, score double, n_words string")
        if stored is None:
            return df
        df.coalesce(3).write.parquet(str(stored))
        return spark.read.parquet(str(stored))

    return make


@pytest.fixture()
def ws(spark):
    return Workspace(spark, "llm-test")


ODD_TEXTS = [
    None, "", " ", "\n\n \t", "one", "one two", "a b c", "A B C", "a b c", "x" * 5000, "word " * 3000,
    "é ü ſ   ·", "a\x0bb\x0cc\r\nd", "日本 語", "\x1c \x85 \x00", "the cat sat\non the mat\non the mat\n",
]


@pytest.fixture()
def odd_texts():
    return ODD_TEXTS
