import pytest


@pytest.fixture
def docs_of(spark):
    """Documents from texts; ids count from 0, languages and sources are given or null."""

    def build(texts, langs=None, sources=None, ids=None):
        rows = [
            (
                ids[n] if ids else n,
                text,
                langs[n] if langs else None,
                sources[n] if sources else None,
                len(text) if text is not None else None,
            )
            for n, text in enumerate(texts)
        ]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long"
        )

    return build
