import pytest
from pyspark.sql import functions as F

#: Rows that every operator has to bear: nulls, empty and odd texts, repeated rows, repeated and null ids.
ODD_TEXTS = [
    (1, None), (2, ""), (3, "   \n\t\n "), (4, "one"), (4, "one"), (4, "another text of the same id"), (None, "a text without an id"),
    (None, None), (5, "x" * 5_000), (6, "\n" * 2_000), (7, "ünïcödé 🙂 ▁ marks\x00 and   more"), (8, "a\r\nb\x0b\x0c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names operators may use themselves."""
    rows = spark.createDataFrame(ODD_TEXTS, "doc_id bigint, text string")
    clashing = ["words", "ids", "start", "k1", "fp", "n", "kind", "spans", "part", "win", "pos", "h"]
    return rows.withColumns({c: F.lit(c) for c in clashing}).withColumns({
        "lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint"),
    })


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
