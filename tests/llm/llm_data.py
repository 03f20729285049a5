"""Small inputs with nulls, empty and long texts, ties, repeated rows and clashing column names."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("id", "row", "key", "h", "score", "rank", "copies", "size", "__row", "__id", "__copies", "n_lines", "point",
            "license", "component_id")
LONG = "long words in a very long text. " * 20_000


def odd_docs(spark, clash=False):
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", "b", 43),
        (3, "", "en", "a", 0),
        (4, None, None, None, None),
        (5, "   \t\n ", "en", None, 6),
        (6, LONG, "en", "a", len(LONG)),
        (7, LONG + "x", "en", "c", None),
        (8, "Élan vital\r\nseconde ligne ΣΑΣ", "fr", "d", 5),
        (8, "Élan vital\r\nseconde ligne ΣΑΣ", "fr", "d", 5),
        (None, "no id", "en", "a", 5),
        (9, "THE quick Brown fox jumps over the lazy dog", "en", "b", 43),
        (10, "one", "de", "c", 3),
    ]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if clash:
        from pyspark.sql import functions as F
        for name in CLASHING:
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
