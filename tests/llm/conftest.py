import pytest

ODD_TEXTS = [
    None,
    "",
    " ",
    "  \n\n  ",
    "one",
    "two words",
    "  lead and trail  ",
    "a\x1cb c\x1d d\x1f\x1f e",
    "don't  we'll\tI'd\n\nyou've   it's 1234 5.6e7",
    "nbsp here and　there   x",
    "é ́alone İstanbul ΣΑΣ ß ſ K   ok",
    "pre  <|endoftext|>  post<|startoftext|>\n<|endoftext|>",
    "emoji 😀😀 ퟿漢字かな交じり文",
    "ABC abc AbC abc",
    "x" * 3000,
    "same copy of a text that repeats",
    "same copy of a text that repeats",
    "word " * 5000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names clash with results."""
    rows = [(i, t, i, "x", None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", 1, "y", 2.0), (5, "two words", 0, "z", 1.0), (5, "two words", 0, "z", 1.0)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, n_tokens int, fingerprint string, score double"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
