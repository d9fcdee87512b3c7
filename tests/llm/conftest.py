import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from costmart.llm.common import prepare

#: Column names that operators use inside must not disturb them.
CLASHING = ("row", "text_key", "n", "node", "gone", "score", "shard", "c_id", "lines", "posterior")


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def make_docs(llm):
    """documents-like rows from (doc_id, text) pairs, with columns of clashing names."""
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                         StructField("source", StringType()), StructField("n_chars", LongType()),
                         *(StructField(c, IntegerType()) for c in CLASHING)])

    def make(rows, partitions=3):
        full = [(i, t, None, "src0", None if t is None else len(t), *range(len(CLASHING))) for i, t in rows]
        return llm.createDataFrame(full, schema).repartition(partitions) if full else llm.createDataFrame([], schema)

    return make


LONG = "word " * 30_000
ODD = [(1, None), (2, ""), (3, " \n\t\n "), (4, "a"), (5, LONG), (5, LONG), (None, "no id here"), (None, None), (6, "é漢字🙂 ß\x1c\x85 x"),
       (7, "x" * 40_000), (8, "1" * 40_000), (9, "a@" * 3000), (10, "line\nline\nline\nline\nline\nline")]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
