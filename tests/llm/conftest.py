import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string, size string, component string"
FOX = "the quick brown fox jumps over the lazy dog while seven green birds watch from an old stone wall near the river"


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra
    columns whose names operators use themselves."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    rows = [
        (1, FOX, "en", "a"), (2, FOX, "en", "a"), (3, FOX + " today", "en", "b"), (4, None, None, None), (5, "", "en", None), (6, " \t\n ", "en", "b"),
        (7, "one two", "fr", "a"), (8, "One  TWO", "fr", "a"), (9, long_text, "en", "c"), (9, long_text, "en", "c"), (10, "12 34 !!", None, "c"), (11, "élan " * 30, "fr", "b"),
    ]
    return spark.createDataFrame([(*r, 0, "x", "y", "z") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
