import pytest

LONG = "word " * 40_000 + "x" * 50_000


@pytest.fixture
def odd_rows():
    """Null ids and texts, empty and long texts, repeated rows, bytes of several scripts."""
    near = " ".join(f"w{at}" for at in range(120))
    passage = "a passage of more than a hundred bytes that some of the texts have in common, äöü и 漢字, word for word " * 2
    return [
        (1, "One line\nCommon line \nthree", "a"), (2, "common line\n\nCOMMON LINE", "a"), (3, None, "b"), (4, "", None),
        (5, near, "a"), (6, near.replace("w60", "changed"), "a"), (7, near, "b"), (7, near, "b"), (8, LONG, "b"),
        (None, "a null id with some words of its own here", None), (None, "a null id with some words of its own here", "c"),
        (None, None, None), (9, f"before {passage} after", "c"), (10, f"other {passage}", "c"), (11, passage + passage, "c"),
        (12, "one two", "a"), (13, "One  TWO", "a"), (14, " \t\n ", "a"), (15, "Common line\n" + near.upper(), "a"),
    ]


@pytest.fixture
def odd_documents(spark, odd_rows):
    """The odd rows, with columns of names that the operators use themselves."""
    extra = ("id", "body", "row", "key", "size", "words", "high", "low", "kept", "kept_0", "own_0", "n_words", "range", "number", "failed")
    rows = [(doc_id, text, "en", source, len(text or ""), *("x" for _ in extra)) for doc_id, text, source in odd_rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{name} string" for name in extra)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)
