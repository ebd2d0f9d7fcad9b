"""Rows that operators on documents must stand: nulls, odd texts, repeats, extra columns."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, row string, `key` int, "
    "print string, doc string, blob string, body string, spans int, size int, score string, block int, place int"
)
EXTRA = (1, "r", 2, "p", "d", "b", "y", 3, 4, "s", 5, 6)
LONG = "word number seven " * 60_000


def documents(spark, extra=()):
    """(doc_id, text, source) rows, with columns whose names clash with inner ones."""
    rows = [
        (None, "a text without an id", "s1"), (1, None, "s1"), (2, "", "s2"), (3, " \n\t ", None),
        (4, LONG, "s2"), (5, "twin text of five words", None), (5, "twin text of five words", None),
        (6, "twin text of five words", "s1"), (7, "***!!!###", "s3"), *extra,
    ]
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
