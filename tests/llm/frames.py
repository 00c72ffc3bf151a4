"""Small frames with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, *(None,) * (4 - len(row)))
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """Columns named like those the operators make or use inside."""
    for name in ("size", "row", "copy", "block", "place", "key", "id", "print", "score", "kind", "sequence_id", "_n"):
        df = df.withColumn(name, df["doc_id"])
    return df
