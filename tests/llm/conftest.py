import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of the given texts, with extra columns whose names clash with results."""

    def make(texts, ids=None, langs=None):
        ids = ids or range(len(texts))
        langs = langs or ["en"] * len(texts)
        rows = [(i, t, g, "s", len(t or ""), "x", 7) for i, t, g in zip(ids, texts, langs)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, score string, fingerprint int",
        ).repartition(3)

    return make
