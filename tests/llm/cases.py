"""Odd rows that every operator over documents has to take."""

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, fp string, _row int"
LONG = "Wort und Zahl 7 " * 4000

ODD = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 5, 0.0, "x", "y", 1),
    (2, None, "en", "a", 0, 0.0, None, None, None),
    (3, "", None, "a", 0, 0.0, "x", "y", 1),
    (4, " \t\n", "en", None, 3, 0.0, "x", "y", 1),
    (5, LONG, "de", "b", len(LONG), None, "x", "y", 1),
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 5, 0.0, "x", "y", 1),
    (None, "a row without an id is a row all the same", "en", "a", None, 0.0, "x", "y", 1),
    (6, "ONE two THREE four five six seven eight nine ten eleven", "en", "a", 5, 0.0, "x", "y", 1),
    (7, "emoji \U0001f600 and é and 中文 words here", None, None, None, None, None, None, None),
]


def stored(spark, tmp_path, rows, schema=DOCS, name="documents"):
    """Rows as a table in files, as operators get them."""
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def documents(spark, tmp_path, texts):
    rows = [(i, text, "en", f"s{i % 3}") for i, text in enumerate(texts)]
    return stored(spark, tmp_path, rows, "doc_id long, text string, lang string, source string")


def labels(spark, rows):
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]
    )
    return spark.createDataFrame(rows, schema)
