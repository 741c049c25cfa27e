import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)`` tuples."""

    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCUMENTS)
        for name, value in (extra or {}).items():
            frame = frame.withColumn(name, value)
        return frame.repartition(3)

    return make
