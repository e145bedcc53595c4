import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs or (doc_id, text, lang, source) rows."""

    def make(*rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "src0")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd(docs):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with those that operators use."""
    from pyspark.sql import functions as F

    long = " ".join(f"word{k % 997}" for k in range(30_000))
    rows = [(None, None, None, None), (1, None, None, None), (2, "", "en", "b"), (3, " \n\t ", "xx", "a"), (4, "one", "en", None), (4, "one", "en", None), (5, long, "de", "a"), (6, long + " more", "de", "a"), (None, "lost words", "en", "a"), (7, "one", "en", "b")]
    frame = docs(*rows)
    for name in ("id", "tag", "fp", "name", "span", "spans", "hashes", "pattern", "size", "copies", "taken", "row_key", "n_words", "component_id", "key", "words", "start", "_id", "_kept", "_row", "_bad", "hash"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


@pytest.fixture
def empty(docs, spark):
    return spark.createDataFrame([], DOCS)
