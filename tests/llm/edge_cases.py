"""Documents that every operator on texts must take: NULLs, empty and long texts, ties,
repeated rows, and extra columns whose names clash with those of the operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog and runs " * 4000
SHARED = "this line of text is held by several documents"

ROWS = [
    (0, "Alpha beta gamma delta.\n" + SHARED, "en", "s0", 10),
    (1, "Alpha beta gamma delta.\n" + SHARED, "en", "s0", 10),
    (2, SHARED + "  ", "en", None, None),
    (3, None, None, None, None),
    (4, "", "en", "s1", 0),
    (5, LONG, "en", "s0", len(LONG)),
    (6, " \t\n\x0b\x0c\r ", "en", "s1", 7),
    (7, "one", "en", "s0", 3),
    (7, "one", "en", "s0", 3),
    (8, "É ü 漢字 \U0001f600 <|endoftext|>  two  blanks", "fr", "s2", 30),
    (None, "a row without an id", "en", "s0", 20),
]

#: Names that operators use for their own columns.
CLASHES = ["a", "b", "w", "n", "copy", "rate", "shard", "slot", "label", "rep", "key", "k1", "_group", "fp", "word", "score"]


def documents(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


def rows_of(df, key=str):
    return sorted((tuple(r) for r in df.collect()), key=key)
