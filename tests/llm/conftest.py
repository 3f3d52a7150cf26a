import pytest

LINES = [
    "The quick brown fox jumps over the lazy dog near the old stone bridge today. It was seen by many people who had come to look at the river.",
    "A small boat went down the stream with three men and a barrel of salted fish. None of them knew where the water would carry them that night.",
    "In the morning the market opened and traders shouted the price of wool and grain. Children ran between the stalls until the bells rang at noon.",
]


@pytest.fixture(scope="session")
def table(spark):
    """Rows with NULLs, empty and very long texts, repeats, ties, and extra columns whose names clash with those of results."""

    def make(texts, ids=None):
        rows = [(i, t, "en", "src", 7, -1, "x", 0.5) for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, digest int, fingerprint string, score double")

    return make


@pytest.fixture(scope="session")
def odd_texts():
    return [None, "", " \n\t", "one", LINES[0], LINES[0], " ".join(LINES) * 40, "é日本😀 ́x", "x" * 5000, LINES[1]]
