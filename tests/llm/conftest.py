import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vireo.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4, app_name="vireo-llm-tests",
                  extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s
    if SparkSession.getActiveSession() is not None:
        s.stop()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and blank texts, repeated rows, ties, one
    long text, and extra columns with the names used inside."""
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
    same = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [(1, same, "en", "a", 1), (2, same, "en", "a", 1), (2, same, "en", "a", 1), (3, None, None, None, None),
            (4, "", "en", "b", 0), (5, " \t\n ", "de", "b", 3), (None, same + " nu", "en", None, 1), (None, None, None, "a", None),
            (6, long_text, "en", "a", len(long_text)), (7, same.replace(" ", "  "), "en", "c", 1), (8, "é\U0001F600 12 34", "fr", "c", 6),
            (9, "one\ntwo lines of text that are long enough\none", "en", "c", 9)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F
    for c in ("batch", "key", "digest", "id", "u", "v", "size", "grp", "rest", "n", "__x", "line", "rk"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
