import pytest
from tallybrook.llm.queries import ready

TEXT = "doc_id long, text string, lang string, source string"

# NULLs, empty and odd texts, ties and repeated rows, a clashing column name.
ODD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \n\t ", "en", "a"),
    (4, "one", "xx", None),
    (4, "one", "xx", None),
    (5, "  two  spaces \n and\r\nfeeds\x0b \x1c end ", "en", "b"),
    (6, "日本語のテキスト。 Привет мир ▁x ▁ y", "en", "b"),
    (7, "<|endoftext|> <s> a<|endoftext|>b  <|endoftext|>", "en", "b"),
    (None, "text without an id", "en", "b"),
    (8, "x" * 30_000, "en", "b"),
    (9, "long " * 20_000, "en", "b"),
    (10, "12 34 !! ??", "en", "b"),
]


@pytest.fixture(scope="session")
def llm_spark(spark):
    return ready(spark)


@pytest.fixture(scope="session")
def odd(llm_spark):
    return llm_spark.createDataFrame(ODD, TEXT)


@pytest.fixture(scope="session")
def none(llm_spark):
    return llm_spark.createDataFrame([], TEXT)


@pytest.fixture(scope="session")
def documents(llm_spark):
    return llm_spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
