import pytest

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa quebec romeo sierra tango uniform victor whiskey xray yankee zulu".split()


@pytest.fixture
def documents(spark):
    """A frame like the table documents, with further columns whose names clash with internal ones."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", "y", 7) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, keep_id string, key string, _text long")

    return make


@pytest.fixture
def edge_cases():
    """Null and empty texts, white space only, repeated rows, a null key, ties and a very long text."""
    long = " ".join(WORDS[(i * i + i // 7) % 26] + str(i % 97) for i in range(30000))
    same = "one two three four five six seven eight nine ten"
    return [(1, None), (2, ""), (3, " \t\n"), (4, same), (4, same), (5, same), (None, same), (6, "a"), (7, "A"), (8, long), (9, long + " end"), (10, "é ü 漢字 \u00a0 x"), (11, "12345"), (12, same.replace(" ", "  "))]
