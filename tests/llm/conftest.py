import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, version int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows, ties,
    and extra columns with names that operators use inside."""
    from touchline.llm.common import ship

    ship(spark)
    base = " ".join(f"word{i} alpha beta" for i in range(60))
    rows = [
        (1, base, "en", "a", 1, "x", 0),
        (1, base, "en", "a", 1, "x", 0),
        (2, base + " tail", None, None, None, None, None),
        (3, None, "en", "a", None, "x", 1),
        (4, "", "de", "b", 0, "", 2),
        (5, " \n\t ", "de", "b", 4, "y", 3),
        (None, base, "en", "a", 1, None, None),
        (6, "12345 !!! ???", "fr", "c", 5, "z", 4),
        (7, "Grün ist schön und die Straße ist lang.\n" * 3, "de", "b", 9, "q", 5),
        (8, "x" * 300_000, "en", "a", 300_000, "l", 6),
        (9, "one two", "en", "a", 7, "s", 7),
        (10, "one two", "en", "a", 7, "s", 7),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def prose(spark):
    """The first documents of the small test table."""
    from touchline.llm.common import table

    return table(spark, "/root/testdata/sf0.001", "documents")
