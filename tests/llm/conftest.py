import pytest

from quayside.session import build_session


@pytest.fixture(scope="session")
def spark():
    return build_session("local[*]", app_name="quayside-tests", shuffle_partitions=8)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, a clashing column name."""
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, "Some plain words, and more of them. " * 300, "x"),
        (4, "tie", "x"),
        (5, "tie", None),
        (5, "tie", None),
        (None, "no id \u2581 \u65e5\u672c <|endoftext|> don't\tI'M 3.5!", "y"),
        (7, " \n\u3000 ", "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
