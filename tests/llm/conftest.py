import pytest
from pyspark.sql import functions as F

LONG = "ein langes Wort und noch eins, " * 4000
CLASHING = (
    "score predicted label rest node bands class_id place log_weight key kept facts n_words ids "
    "length start sequence_id offset held_out row_id classes tail row_number mean"
).split()


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and very long texts, repeated rows, equal ids."""
    return [
        (1, "the cat sat on the mat and the dog sat on the log by the door of the old house"),
        (1, "the cat sat on the mat and the dog sat on the log by the door of the old house"),
        (1, "quite another text under the same number"),
        (2, None), (3, ""), (4, "   \n\t "), (None, "a text without a number of its own"),
        (None, None), (5, LONG), (6, "x" * 5000), (7, "Grüße \U0001f642 <|endoftext|> \x00 ok"),
    ]


@pytest.fixture
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string")
    return docs.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHING))


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
