"""Rows every operator must take: NULLs, empty and long texts, ties, repeats, clashing columns."""

EXTRA = "kept string, n_words string, _row string, _sha string, sequence_id string, class_id string, label string"


def edge_rows(spark, texts):
    """(doc_id, text) pairs as documents with NULLs elsewhere and columns that clash with outputs."""
    return spark.createDataFrame(
        [(i, t, None, None, None, *["x"] * 7) for i, t in texts],
        f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}",
    )


LONG = " ".join(f"word{i % 977}" for i in range(40_000))

EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (4, "two words"), (None, "one"), (None, None),
    (5, LONG), (6, LONG + " tail"), (7, "Ünïcödé 日本語 🎉 text"), (8, "x\n\n\nx\n"), (-9, "minus"),
]


def empty(spark):
    return edge_rows(spark, EDGE).limit(0)


def rows_of(df):
    return sorted(df.collect(), key=repr)
