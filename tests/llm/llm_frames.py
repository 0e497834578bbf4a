"""Small documents tables."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000 + "end."


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source) as a documents table."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


#: Nulls, empty, blank and very long texts, ties and repeated rows.
ODD_ROWS = [
    (1, None, None),
    (None, "a text without an id, and it has quite enough words to pass", "b"),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (5, "the same words again and again, here they stand twice over for all to see"),
    (5, "the same words again and again, here they stand twice over for all to see"),
    (6, "the same words again and again, here they stand twice over for all to see"),
    (7, "one"),
    (None, None, None),
]
