import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet consectetur. " * 4000

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def frame(spark, texts, ids=None):
    """A documents table of the given texts; some null columns."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "s", None if t is None else len(t))
            for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
