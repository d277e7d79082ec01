import pytest
from pyspark.sql import Row

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long_ = " ".join(f"word{i % 997} and" for i in range(12_000))
    same = "The very same sentence of some length stands in this document again. " * 9
    rows = [
        (1, None, None), (2, "", "a"), (None, "no id here", "a"), (3, " \t\n\r\x0b\x0c ", "b"),
        (4, "one", "a"), (5, "one", "a"), (5, "one", "a"), (6, same, None), (7, same, "a"), (8, same + "tail", "a"),
        (9, long_, "b"), (10, long_ + " end", "b"), (11, "aaaa" * 500, "c"), (12, "ÀÉ ß ſ İ 日本語 тест\n\n x", "c"),
        (13, "Line that is long enough to be counted\nunique words of thirteen here\n" + same, "a"),
        (14, "  line that IS long enough to be counted \nunique words of fourteen here", "a"),
        (15, "LINE THAT IS LONG ENOUGH TO BE COUNTED\t\nother words of fifteen here", "a"),
    ]
    schema = "doc_id long, text string, source string, fp long, __id string, bytes int, h string, id int, n_words int, word string, kept string"
    return spark.createDataFrame([Row(*r, 7, "x", 1, "y", 3, 4, "w", "k") for r in rows], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")


def texts(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]
