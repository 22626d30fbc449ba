"""A table with every awkward case, and helpers."""
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
PLAIN = " ".join(f"alpha{i} beta{i * 7}" for i in range(60))

ROWS = [
    (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "one", None, None, 3), (4, " \n\t\n ", "en", "s", 5),
    (5, LONG, "en", "s", len(LONG)), (6, PLAIN, "en", "s", len(PLAIN)), (6, PLAIN, "en", "s", len(PLAIN)),
    (7, PLAIN, "de", "t", None), (None, PLAIN + " tail", "de", "t", None), (None, None, None, None, None),
    (8, "a\n" * 3000, "en", "s", 6000), (9, "é👍 ñ\n" * 40, "fr", "s", 240),
]


def edge(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing(spark):
    """The same with extra columns named as the operators' own."""
    names = ("kept", "row", "cls", "words", "spans", "doc", "h", "line", "first", "rank", "id", "t", "_t", "bucket", "fold", "dir",
             "license", "score", "label", "a", "r", "severity")
    return edge(spark).select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def labels(spark, sf=SF):
    return spark.read.parquet(f"{sf}/labels.parquet")
