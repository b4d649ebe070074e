import brute
import pytest


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts with null and repeated ids, and columns that have the names of results."""
    texts = brute.odd_texts()
    ids = [None if i == 4 else 7 if i == 8 else i for i in range(len(texts))]
    rows = [(d, t, "xx" if i % 3 else None, i, -1.0, "b") for i, (d, t) in enumerate(zip(ids, texts, strict=True))]
    names = "doc_id long, text string, lang string, n_words long, score double, block string"
    return spark.createDataFrame(rows, names).repartition(3), ids, texts
