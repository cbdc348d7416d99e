import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from texts or (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = []
        for n, row in enumerate(rows):
            own = row if isinstance(row, tuple) else (n, row)
            doc_id, text, lang, source = (*own, *("en", "src0")[len(own) - 2 :])[:4] if len(own) < 4 else own
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCS)

    return make


#: Columns that an operator might use for itself: an input may have them too.
CLASHING = ["row", "block", "shard", "kind", "place", "start", "end", "length", "hash", "label", "h1", "h2", "drop", "keeper", "bits", "node", "root",
            "host", "score", "held_out", "n_words", "hits", "items", "counts", "of_doc", "payload", "scope", "base", "salt", "u", "v", "low", "at", "mask", "value"]


@pytest.fixture(scope="session")
def widened():
    """The same rows with many further columns."""
    from pyspark.sql import functions as F

    return lambda df: df.select("*", *(F.lit(n).alias(c) for n, c in enumerate(CLASHING)))
