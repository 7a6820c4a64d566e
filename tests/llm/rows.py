"""Small tables with the cases that every operator must bear."""


LINE = "The river rose by four feet overnight and then fell again before the morning came. "


def documents(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    """Rows (doc_id, text, source), with extra columns whose names operators might want."""
    full = schema + ", size long, row_key string, fingerprint string, kept boolean, mix string, copy int, text_sha256 string"
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or ""), 7, "k", "f", None, "m", 1, "h") for i, t, s in rows], full)


AWKWARD = [
    (1, LINE * 8, "a"),
    (2, LINE * 8, "b"),                  # a copy
    (2, LINE * 8, "b"),                  # a repeated row
    (3, None, "a"),
    (4, "", None),
    (None, LINE * 8 + "extra words here", "c"),
    (5, " \n\t ", "c"),
    (6, "x", "a"),
    (7, "One " * 3000 + "long é 漢字 \U0001F600 tail", "b"),
    (8, (LINE * 8).upper(), "é"),
    (None, None, None),
]


def as_tuples(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


__all__ = ["AWKWARD", "LINE", "as_tuples", "documents"]
