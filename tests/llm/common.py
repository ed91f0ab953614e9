"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here to the old river bank"


def frame(spark, rows, parts=3):
    """Rows are (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def odd_rows():
    long = "\n".join(f"line {i} of a very long text with password: hunter{i}abcdef" for i in range(6000))
    return [
        (1, None),
        (2, ""),
        (3, "   \n\t "),
        (4, PROSE),
        (4, PROSE),
        (5, PROSE),
        (None, PROSE),
        (None, None),
        (6, long, None, None),
        (7, long + "!", "de", None),
        (8, "é" * 70_000),
        (9, "é" * 70_000),
        (10, "x"),
        (11, "A b\nA b\nc"),
    ]


#: Names that operators use inside.
CLASHING = ("id", "row", "x", "n", "fp", "size", "kept", "text_hash", "_row_id", "_row_null", "_row_hash", "_text", "kinds", "bitmap", "n_lines", "topic", "probability", "part", "_lang")


def clashing(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
