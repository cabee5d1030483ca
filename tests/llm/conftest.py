import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_texts import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators produce or use inside, on the input with other meanings.
CLASHES = "n_words string, hits string, items string, spans string, row string, ids long, n long, g long, keep int, score string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts, with all columns of the table and clashing ones beside."""
    def build(texts, ids=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, langs[k] if langs else "en", "s", len(t or "")) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
        df = spark.createDataFrame(rows, SCHEMA)
        for name, kind in (c.split() for c in CLASHES.split(", ")):
            df = df.selectExpr("*", f"cast(null as {kind}) as {name}")
        return df
    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, white space, a very long text, ties and repeats."""
    long = prose(1, 20_000) + "\n" + "x" * 50_000
    return [None, "", " \t\n", long, "Zwei wörter", "Zwei wörter", prose(2, 30), prose(2, 30), "日本語 テキスト é", "+++@@@..", "7"]
