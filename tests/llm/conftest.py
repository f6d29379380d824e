import pytest


@pytest.fixture(scope="session")
def spark():
    from corvane.session import local_session

    return local_session(4, shuffle_partitions=4)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those that operators add."""

    def build(rows, extra=True):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
        if extra:
            df = df.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1 AS item", "2 AS size", "3 AS key", "4 AS d", "5 AS line", "6 AS n_chars")
        return df

    return build
