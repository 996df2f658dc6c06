import pytest

DOCUMENTS = ("doc_id long, text string, lang string, source string, n_chars long, "
             "size string, copies string, score string, kept string, class_id string, line string, rank int, id int, n_words int")
LONG = " ".join(f"word{i % 977} the of" for i in range(9000))


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like results."""
    prose = "the quick brown fox jumps over the lazy dog and then sits down of its own will in the sun\nsecond line of this text is here too"
    rows = [
        (1, prose, "en", "a", 5), (2, prose, "en", "a", 5), (2, prose, "en", "a", 5), (3, prose + " now", None, "b", None),
        (4, "", "en", None, 0), (5, None, None, None, None), (None, prose, "de", "b", 1), (None, None, None, None, None),
        (6, LONG, "en", "c", 9), (7, " \t\n\x0b\x0c\r ", "en", "c", 7), (8, "word", "en", "a", 4), (9, "é ü 漢字 \U0001f600", "fr", "a", 4),
        (10, LONG, "en", "c", 9),
    ]
    return spark.createDataFrame([r + ("s", "c", "x", "k", "q", "l", 1, 2, 3) for r in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.filter("false")
