import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i}" for i in range(120_000))
CLASHING = ["_key", "_text", "_digest", "_tag", "n", "fp", "sig", "token", "kept", "keep_id", "blob", "findings", "text0", "rank"]


@pytest.fixture
def make_docs(spark):
    """Documents (doc_id, text) with further columns whose names the operators use themselves."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.select("doc_id", "text", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)]).repartition(3)

    return make


@pytest.fixture
def edge_rows():
    """Nulls, empty and white-space texts, copies in another case, a repeated row, a very long text, other alphabets."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "One two three four five"), (5, "one TWO three four five"),
        (5, "one TWO three four five"), (6, LONG), (None, "a row without an id"), (7, "ÉTÉ été İ ſ K"),
        (8, "one"), (9, "漢字かな 🙂 x"), (10, "nul\x00 and \u2028 odd\xa0space <|endoftext|>"),
    ]
