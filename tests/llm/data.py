"""Small tables with the hard cases that every operator must stand."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        T.StructField("place", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("row", T.StringType()),
        T.StructField("fp", T.LongType()),
    ]
)
PROSE = "the quick brown fox jumps over the lazy dog and runs into the deep dark wood where nobody has ever been before "
LONG = " ".join(f"word{i % 977} of text" for i in range(20_000))


def hard_rows():
    texts = [
        (0, PROSE * 1, "en", "a"),
        (1, PROSE * 1, "en", "a"),
        (2, None, "en", "a"),
        (3, "", "de", None),
        (4, "  \n\t \r\n", None, "b"),
        (5, LONG, "en", "a"),
        (6, "Übermäßig große Häuser stehen im Wald\nund noch ein Satz", "de", "b"),
        (7, "one", "en", "b"),
        (8, "one two", "en", "b"),
        (9, "\x00 nul \x0b tab <|endoftext|> end 漢字 😀", "en", None),
        (None, PROSE + "null id", "en", "a"),
        (None, None, None, None),
        (10, PROSE * 1, "en", "a"),
        (10, PROSE * 1, "en", "a"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "p", 1, 0.5, "r", 3) for i, t, lang, s in texts]


def hard(spark):
    return spark.createDataFrame(hard_rows(), DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain(spark, rows):
    """documents from (doc_id, text, source)."""
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
