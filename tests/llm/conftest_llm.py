"""Helpers that the tests of the operators import."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, fp int, kind string"


def documents(spark, rows):
    """Rows (doc_id, text[, source]) as a documents table with columns whose names operators use inside."""
    full = [(d, t, "en", s[0] if s else "src0", None if t is None else len(t), 5, 6, "x") for d, t, *s in rows]
    return spark.createDataFrame(full, SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]
