"""Small tables for the tests of the training-data operators."""

from pyspark.sql import functions as F

LONG = "Of the stone and river bend a quiet mill turned slowly under grey autumn light. " * 9


def odd(spark):
    """Documents with null columns, empty and long texts, ties, repeated rows, and columns named like inner ones."""
    near = LONG.replace("quiet", "silent", 1)
    rows = [(1, LONG, "en", "a"), (2, LONG, "en", "a"), (2, LONG, "en", "a"), (3, near, "en", None), (4, None, None, "a"),
            (5, "", "en", "b"), (None, LONG, "en", "b"), (None, None, None, None), (6, "one\ntwo\n\n one", "en", "b"),
            (7, "Straße GNU General Public License, İx 語 " * 3, "de", "c"), (8, "  \t\n ", "en", "c"),
            (10, "Three boats lay near the old harbor wall while gulls circled over nets left out to dry", "en", "c"),
            (9, "Released under the MIT License.\n" + "a b c d e f g h i j k l. " * 1500, "en", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("m", "row", "n", "host", "w", "rank", "k1", "hit", "blocks", "src", "u", "fp", "path"):
        df = df.withColumn(name, F.lit("x"))
    return df.withColumn("n_chars", F.length("text").cast("long"))


def empty(spark):
    return odd(spark).limit(0)


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
