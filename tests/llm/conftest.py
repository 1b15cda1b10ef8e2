import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket long, fp long, rank long, toxic int"


@pytest.fixture(scope="session")
def corpus(spark):
    """The smallest documents table with awkward rows: nulls, empty and repeated rows, a long text, and columns of names the operators use."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name in ("bucket", "fp", "rank"):
        docs = docs.withColumn(name, F.lit(1).cast("long"))
    docs = docs.withColumn("toxic", F.lit(None).cast("int"))
    long_text = "the quick brown fox jumps over the lazy dog " * 3000
    extra = [
        (100_000, None, None, None, None), (100_001, "", "en", "x", 0), (100_002, "...", None, "x", 3), (100_003, "one", "en", "x", 3),
        (100_004, long_text, "en", "x", len(long_text)), (None, "row without an id", "en", "x", 17), (100_003, "one", "en", "x", 3), (100_005, "a\n\n a \nb" + "ß" * 70, "de", "x", 9),
    ]
    return docs.unionByName(spark.createDataFrame([(*r, 1, 1, 1, None) for r in extra], SCHEMA)).cache()


@pytest.fixture(scope="session")
def rows(corpus):
    return [(r.doc_id, r.text) for r in corpus.collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
