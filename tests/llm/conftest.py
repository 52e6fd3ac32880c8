import os

import pytest

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def documents(spark):
    rows = spark.read.parquet(os.path.join(SMALL, "documents.parquet"))
    return rows.cache()


def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and
    extra columns whose names the operators use themselves."""
    long_text = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.\n" * 12_000)
    rows = [(1, "one two three four five six", "en", "s1", 27), (2, "one two three four five six", "en", None, 27),
            (2, "one two three four five six", "en", None, 27), (3, None, None, None, None), (4, "", "en", "s2", 0),
            (None, "one two three four five six", "en", "s1", 27), (None, None, None, None, None), (5, " \t\n ", "en", "s2", 4),
            (6, long_text, "en", "s1", len(long_text)), (7, "word", "en", "", 4), (8, "word", "en", "s3", 4),
            (9, "mail a.b@c.example.orgé \U0001f600 x", "fr", "s1", 10)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ["_id", "_text", "_key", "_row", "label", "score", "key", "node", "size", "taken", "_score", "_bad_id", "_g_id"]
    frame = spark.createDataFrame(rows, schema)
    for c in extra:
        frame = frame.selectExpr("*", f"'{c}' as `{c}`")
    return frame


@pytest.fixture(scope="session")
def odd(spark):
    return awkward(spark).cache()


@pytest.fixture(scope="session")
def odd_rows(odd):
    return [tuple(r)[:5] for r in odd.collect()]


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("1 = 0")
