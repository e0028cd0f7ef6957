import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, block int, value string, spans string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows that every operator must survive: NULLs, empty and very long texts, repeated rows,
    odd characters, and extra columns whose names the operators use themselves."""
    long = "the of and " * 20_000
    rows = [(1, "The cat sat on the mat and the dog ran off to the far hill.", "en"), (2, None, "en"), (3, "", None),
            (4, "   \n\t ", "de"), (5, long, "en"), (6, "The cat sat on the mat and the dog ran off to the far hill.", "en"),
            (6, "The cat sat on the mat and the dog ran off to the far hill.", "en"), (None, "no id but some text here", "fr"),
            (7, "été 你好 \U0001f600 \x01 it's <|endoftext|>  x", "fr"), (8, "word", None), (9, "123 456", "de")]
    return spark.createDataFrame([(i, t, g, None, 0, 1, "v", "s") for i, t, g in rows], DOC)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
