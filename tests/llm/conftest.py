import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def docs_of():
    """documents-like rows with an extra column of a clashing name."""

    def make(spark: SparkSession, rows, clash: str = "ids"):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), "kept") for i, t in rows],
            f"doc_id long, text string, lang string, source string, n_chars long, {clash} string",
        )

    return make

