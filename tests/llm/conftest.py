import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
# every operator has to accept columns that are named like its own
CLASHING = ["key", "tkey", "raw", "n", "label", "words", "features", "score", "band", "_key", "_gone", "class"]


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def make(spark):
    def rows(pairs):
        return spark.createDataFrame(pairs, DOCS)
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows, clashing column names."""
    long_text = " ".join(f"word{i % 977} other{i % 89}" for i in range(20_000))
    passage = " ".join(f"p{i}" for i in range(60))
    pairs = [(1, None), (None, "alpha beta"), (None, None), (2, ""), (3, long_text), (3, long_text), (4, long_text),
             (5, "same id one"), (5, "same id two"), (6, f"x y\n{passage}\nz"), (7, f"{passage}\nq r"), (8, "   \n\n \t"),
             (9, "Kİ ß \U0001f600 é"), (10, "a" * 5000)]
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in CLASHING]
    return spark.createDataFrame([(*p, *("clash" if i % 2 else None for i in range(len(CLASHING)))) for p in pairs], T.StructType(fields))


@pytest.fixture(scope="session")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)
