import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a table of documents from (doc_id, text) with a language, a host and a column that clashes with results."""

    def make(rows, lang="en", source="s"):
        frame = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
        return frame.select("doc_id", "text", F.lit(lang).alias("lang"), F.lit(source).alias("source"), F.lit("x").alias("kept"))

    return make
