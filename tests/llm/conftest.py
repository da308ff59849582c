import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` rows."""

    def make(rows):
        full = [(*row, *("en", "host")[len(row) - 2 :])[:4] for row in rows]
        return spark.createDataFrame([(*row, len(row[1] or "")) for row in full], DOCS)

    return make


PROSE = "the quick brown fox jumps over the lazy dog while seven other animals look on in calm surprise"


@pytest.fixture
def prose():
    """Different texts of many words, by number."""

    def make(number, words=120):
        pool = PROSE.split()
        return " ".join(f"{pool[(number * 7 + i * 5) % len(pool)]}{(number * 31 + i * i) % 97}" for i in range(words))

    return make
