import pytest

from tallylake.llm.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, special strings, and columns that bear the operators' names."""
    long = " ".join(f"word{i % 700}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, "  \n\t "), (4, "Hello world.\nHello world.\n  x"), (4, "Hello world.\nHello world.\n  x"),
        (5, "a\n <|endoftext|> b  <|endoftext|>"), (6, long), (7, long + " end"), (None, "Straße — naïve café 中文 \U0001F600"),
        (8, "aaaaaaaaaaaaaaaaaaaaaaaa" * 40), (9, "one two three"), (10, "ONE two  three"), (11, "x" * 3000 + " \r\n y"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr("doc_id", "text", "'mine' AS N_TOKENS", "1 AS token_ids", "2 AS node", "3 AS `a.b`")
