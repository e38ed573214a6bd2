"""Rows of documents for the tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """(doc_id, text) or (doc_id, text, lang, source) rows as documents."""
    full = [(*r, *([None] * (4 - len(r)))) for r in rows]
    return spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in full], DOCS)
