import pytest

COLS = "doc_id long, text string, lang string, source string, n_chars long, score string, rep string, k1 string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in all columns, empty and white-space texts, copies, repeated rows, one long
    text, and extra columns whose names the operators use themselves."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    same = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 4
    near = " ".join(f"n{i}" for i in range(200))
    rows = [(1, same, "en", "a"), (2, same, "en", "a"), (2, same, "en", "a"), (3, None, None, None), (4, "", "de", "b"), (5, " \t\n ", "de", None),
            (6, long, "en", "a"), (7, near, "en", "b"), (8, near + " tail", "en", "b"), (9, "One two", "en", "b"), (10, "one TWO", None, "b"),
            (11, "Ünïcödé – 漢字 😀 'll don't\r\n\x0b  x  ", "de", "c"), (None, "no id here", "en", "c"), (None, None, None, None)]
    return spark.createDataFrame([(*r, None, "x", "y", "z") for r in rows], COLS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLS)
