import pytest

#: Column names that operators use within; extra columns of these names must not disturb them.
CLASHES = ("h", "size", "start", "kept", "words", "ids", "removed", "spans", "target", "block", "n")


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): null, empty, blank, tiny, long, equal and repeated rows."""
    prose = "the cat sat on the mat and then it went to the door of the house"
    long_word = "abcdefghij" * 20_000
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one", "en", "b"),
        (5, prose, "en", "a"), (6, prose, "en", None), (7, prose, None, "b"), (8, prose + " again", "en", "a"),
        (9, long_word, "en", "a"), (10, (prose + ".\n") * 3000, "en", "a"), (11, "\n".join(["x y"] * 60), "en", "b"),
        (12, "日本語 のテキスト です", "ja", "c"), (13, "Ünïcödé — “quotes” 👩‍👩‍👧 é", "de", "c"), (14, "$$$ ### %%% ***", "en", "c"),
        (15, "der die das und ist nicht ein eine mit für auf", "de", "a"), (15, "der die das und ist nicht ein eine mit für auf", "de", "a"),
        (16, "<|endoftext|> a  b   c\r\n\r\n d", "en", "a"), (None, "no id here but some words to read", "en", "a"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F
    d = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string")
    return d.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    """(doc_id, text, lang, source) of the smallest documents table, all rows."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
