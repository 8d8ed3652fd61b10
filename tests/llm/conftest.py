import zlib

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
def make_docs(spark):
    """Documents from texts (or (doc_id, text, lang, source) tuples); clashing extra columns on request."""

    def make(rows, extra=()):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (i, row)
            row = (*row, *(None,) * (4 - len(row)))
            full.append((*row[:4], None if row[1] is None else len(row[1])))
        df = spark.createDataFrame(full, DOCUMENTS).repartition(3)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


def crc(text: str) -> int:
    return zlib.crc32(text.encode())
