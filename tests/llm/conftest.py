import pytest

from lexloom.llm.queries import byte_vocabulary

ODD_TEXTS = [None, "", " ", "\n\n", "a", "Ünïcödé 日本語 text", "one two three four five six", "one two three four five six", "x" * 5000, "word " * 20_000, "<|endoftext|> and more", "  two  spaces \t\n tab", "💩!!! 'quoted' don't"]


@pytest.fixture(scope="session")
def vocabulary_path():
    return byte_vocabulary()


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, odd texts, repeated rows, and columns whose names operators use themselves."""
    rows = [(k, t, ["en", "fr", None][k % 3], f"s{k % 2}", k, "row", 0.5, "id") for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[6], (None, "no id here", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, score double, id string")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
