"""Small tables with the cases that every operator has to bear."""

from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf.", "en", "a", 80),
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf.", "en", "a", 80),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away from the big bad wolf.", None, "a", 80),
    (3, None, "en", "b", None),
    (4, "", None, None, 0),
    (None, "no id here at all", "fr", "c", 17),
    (None, None, None, None, None),
    (5, "É é   İ ß", "fr", "b", 9),
    (6, "\t\n \x0b\x0c\r", "en", "b", 6),
    (7, "word " * 3000, "en", "a", 15000),
    (8, "x" * 40000, "en", "c", 40000),
    (9, "one two", "de", "c", 7),
]
# names that an operator may use inside
CLASH = ("id", "h", "key", "size", "kept", "digest", "__row", "rank", "u", "of", "host", "words", "text_sha256", "score", "data")


def odd_docs(spark: SparkSession, clash: bool = False, rows=ODD):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for i, c in enumerate(CLASH):
            df = df.selectExpr("*", f"{i} AS `{c}`")
    return df


def empty_docs(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
