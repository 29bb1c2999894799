"""Small frames with the cases every operator must bear."""

LONG = " ".join(f"word{i % 977}" for i in range(30_000))

# Null and empty texts, a null id, repeated rows, a very long text, ties.
TEXTS = [
    (1, "alpha beta gamma delta epsilon zeta"),
    (2, "alpha beta gamma delta epsilon zeta"),
    (2, "alpha beta gamma delta epsilon zeta"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, LONG),
    (None, "alpha beta gamma delta epsilon zeta"),
    (None, None),
    (7, "One\nTwo\none \n\n"),
    (8, "ünïcode ñ 日本 text"),
]

# Names that operators use inside.
CLASH = (
    "hash pos id mark n_lines n_dropped row_doc_id row_mark dropped_lines text_mark fp bucket words windows places score "
    "order toxicity_score gone_id host verdict label a b root node batch"
).split()


def documents(spark, rows=None, clash=True):
    rows = TEXTS if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame([(i, t, "en", None if i == 4 else "s", len(t or "")) for i, t in rows], schema)
    if clash:
        for name in CLASH:
            frame = frame.selectExpr("*", f"'x' as {name}")
    return frame
