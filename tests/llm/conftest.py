import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, lang="en", ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, lang, "src0", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
