import pytest

#: Rows that every operator must take: nulls in each column, empty and blank texts, repeated rows, a long text, and
#: columns that are named like an operator's own.
EDGE = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, score double, node bigint, id string, t string"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
WORDS = " ".join(f"w{i}" for i in range(80))


@pytest.fixture(scope="session")
def edge(spark):
    rows = [
        (1, WORDS, "en", "a", 5, True, 0.5, 1, "x", "y"),
        (1, WORDS, "en", "a", 5, True, 0.5, 1, "x", "y"),
        (2, WORDS, None, None, None, None, None, None, None, None),
        (3, None, "en", "a", 0, False, 0.1, 2, "x", None),
        (4, "", "fr", "b", 0, None, None, 3, None, "z"),
        (5, " \n\t ", "fr", "b", 4, None, None, 3, None, "z"),
        (None, WORDS + " extra", "en", "b", 9, True, 0.2, 4, "q", "z"),
        (None, None, None, None, None, None, None, None, None, None),
        (6, LONG, "en", "c", len(LONG), True, 0.3, 5, "r", "z"),
        (7, "naïve Ünïcode 😀 текст", "fr", "c", 22, True, 0.3, 5, "r", "z"),
    ]
    return spark.createDataFrame(rows, EDGE).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], EDGE)
