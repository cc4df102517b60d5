import pytest

EDGES = [None, "", " ", "\n", "one", "two words", "a b c d", "a b c d e", "Tab\tand\x0bother\x0cspaces\r\nhere", "x" * 30000, "é　ü ñ 中文 😀 " * 50, "word " * 3000, "Same text twice here, friends.", "Same text twice here, friends."]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns that operators use as names themselves."""
    rows = [(None if i == 3 else min(i, 11), t, "zz", 7, "tile", 1.0, "k") for i, t in enumerate(EDGES)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, offset long, tile string, score double, sequence_id string")
