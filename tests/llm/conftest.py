import pytest
from pyspark.sql import types as T

from foliospark.llm.common import table
from odd_rows import ODD

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size string, token_ids string, keep string, _source string, score string"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang, source) as a table with further columns whose names the operators use themselves."""

    def make(rows):
        table(spark, "/root/testdata/sf0.001", "documents")  # so that tasks find the package
        full = [(*r, len(r[1] or ""), "s", "t", "k", "x", "y") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return make


@pytest.fixture
def odd(documents):
    return documents(ODD)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCUMENTS))
