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

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, source="s"):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else source, len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls, empty and very long texts, repeated rows, equal ids, and columns whose names operators use inside."""
    long = " ".join(f"word{k % 977}x{k // 977}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, "  \n\t "), (None, "a b c d e f g"), (5, "a b c"), (5, "a b c"), (5, "x y z"), (6, long)]
    frame = documents(rows + [(7, "É   ß\u0000 <|endoftext|> two  spaces\r\nthree\fend "), (8, "w " * 50)])
    from pyspark.sql import functions as F

    for name in ("size", "key", "node", "rules", "block", "part", "component", "shard", "features", "label", "word", "score"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
