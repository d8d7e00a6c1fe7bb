"""Rows and comparisons that the tests of this folder share."""

LONG = "long Word, " * 3000


def same_rows(df, columns, rows):
    """Spark's rows and SQL's are the same, whatever the order of rows and columns."""
    assert sorted(df.columns) == sorted(columns)
    names = sorted(columns)

    def norm(values):
        return tuple(f"{v:.9g}" if isinstance(v, float) else repr(v) for v in values)

    got = sorted(norm(r[c] for c in names) for r in df.collect())
    want = sorted(norm(r[columns.index(c)] for c in names) for r in rows)
    assert got == want


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empty and very long texts, ties, repeated rows.
MESSY = [
    (1, "Same text Here", "en", "a", 14), (2, "same TEXT here", "en", "b", 14), (3, "same text here ", "en", "b", 15),
    (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \t\n ", "de", None, 4), (7, LONG, "de", "a", len(LONG)),
    (8, LONG.upper(), "de", "c", len(LONG)), (9, "É é É", "fr", "c", 5), (10, "é É É", "fr", "c", 5),
    (11, "one", "fr", "\U0001f600", 3), (11, "one", "fr", "\U0001f600", 3), (12, "two words", "fr", "～", 9),
    (None, "one", "en", "d", 3), (None, None, None, None, None), (13, "a b c d e f g h", "en", "a", 15),
    (14, "a b c d e f g h", "en", "b", 15), (15, "solo " * 40, "en", "z", 200),
]
