import pytest
from pyspark.sql import functions as F

ODD_TEXTS = [
    (1, "One two three four five six seven eight nine ten."),
    (2, "one  two three\tfour five six seven eight nine ten."),
    (3, None),
    (4, ""),
    (5, " \n\t\n "),
    (None, "A text whose row has no id, but some words and a line.\nAnother line of it."),
    (None, None),
    (6, "One two three four five six seven eight nine ten."),
    (6, "One two three four five six seven eight nine ten."),
    (7, "x"),
    (8, "12345 67890 --- ***"),
    (9, "né à l'école 漢字 😀 \u0000 ▁ <s> <|endoftext|>"),
    (10, "word " * 30000 + "end"),
    (11, "y" * 50000),
    (12, "\n".join(f"Line number {n % 7} of a text with lines that repeat." for n in range(400))),
    (13, "\n".join(f"Line number {n % 7} of a text with lines that repeat." for n in range(400))),
]
# Names that the operators use for columns of their own.
CLASHES = (
    "key text_key text_sha256 row node bucket group kept place spots ord id first best weight class_id held_out own_id own_id_key "
    "dropped n_dropped sim whole n_words n_removed kept_sha256 draw calibrates all piece length sequence_id"
).split()


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, repeated rows, ties, and extra columns with clashing names."""
    docs = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string").withColumn("lang", F.lit("en"))
    docs = docs.withColumns({"source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    return docs.withColumns({name: F.lit("clash") for name in CLASHES}).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
