import pytest

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven calm otters watch from the quiet river bank"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with the names of results."""
    rows = [
        (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE.upper(), "en", "b"), (3, None, "en", "a"), (4, "", None, "a"),
        (5, " \t\n\x0b ", "de", None), (6, LONG, "en", "c"), (7, "ünï çødé 日本 😀 … ok", "fr", "c"), (None, PROSE + " end", None, None),
        (None, None, None, None), (8, "one", "en", "b"), (9, "a b c d", "es", "b"), (10, "a b c d", "es", "b"),
    ]
    held = [(*r, None if r[1] is None else len(r[1]), "mine", 7) for r in rows]
    return spark.createDataFrame(
        held, "doc_id long, text string, lang string, source string, n_chars long, score string, Shard int")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
