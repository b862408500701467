"""Small inputs that every operator has to take."""

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       T.StructField("score", T.DoubleType()), T.StructField("row", T.StringType()), T.StructField("key", T.StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """Rows (doc_id, text) or (doc_id, text, source); the other columns have names that operators use themselves."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 0.5, "r", "k") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
