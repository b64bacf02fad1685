import pytest


@pytest.fixture(scope="session")
def sf01():
    return "/root/testdata/sf0.01"


CLASHING = ("row bigint, text_key string, salt int, id string, key string, node int, bands int, block int, "
            "stratum string, score double, spans string, found_0 int, digest string, votes int, n_words int")

LONG = "\n".join(f"line {k} of a very long text with words w{k % 977} and v{k % 31}" for k in range(20_000))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, ties, repeated rows."""
    shared = "This very line stands in many documents and is long enough to count"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \t ", "en", None, 4), (4, "\n\n", None, "a", 2),
            (5, LONG, "en", "a", len(LONG)), (6, "one", "en", "a", 3), (6, "one", "en", "a", 3),
            (7, "same id", "en", "b", 7), (7, "other text of the same id", "de", "b", 25),
            (None, "no id here", "en", "b", 10), (None, None, None, None, None)]
    rows += [(k, f"{shared}\n own {k}", "en", "b", None) for k in range(10, 17)]
    rows += [(k, "exact copy of one text that is repeated here", "en", "c", None) for k in range(20, 24)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """``odd_rows`` with further columns whose names operators might use."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASHING
    n = len(CLASHING.split(","))
    return spark.createDataFrame([r + (None,) * n for r in odd_rows], schema)
