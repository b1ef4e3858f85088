"""Small tables with the awkward cases every corpus operator must take."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def awkward(spark, texts):
    """Texts with ids from 0, then NULL text, empty and blank text, a NULL id, a row twice, a text of 120,000 words."""
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    n = len(rows)
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s", 0), (n + 2, " \t\n", "en", "s", 3), (None, "no id here at all", "en", "s", 4)]
    rows += [(n + 3, "the very same row", "en", "s", 5)] * 2 + [(n + 4, "long text goes on " * 30_000, "en", "s", 6)]
    return spark.createDataFrame(rows, DOCS), rows


def clashing(docs):
    """The same table with columns of the names that operators use inside."""
    for name in ("row", "row_no", "ROW_NO_", "id", "fp", "bucket", "kept", "spans", "score", "offset"):
        docs = docs.withColumn(name, docs["lang"])
    return docs


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
