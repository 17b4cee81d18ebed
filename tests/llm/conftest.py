import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
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
    def make(rows):
        full = [(i, t, *(more or ("en", "src0"))[:2], len(t or "")) for i, t, *more in [(r[0], r[1], *r[2:]) for r in rows] for more in [tuple(more)]]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    rows = [
        (1, "Alpha beta gamma delta epsilon\nA shared line of text\nzeta eta theta iota kappa"),
        (2, "alpha beta gamma delta epsilon\n  a SHARED line of text\t\nlambda mu nu xi omicron pi"),
        (2, "alpha beta gamma delta epsilon\n  a SHARED line of text\t\nlambda mu nu xi omicron pi"),
        (3, None),
        (4, ""),
        (5, "  \n\t\n "),
        (6, long),
        (7, long + " tail"),
        (None, "no id here, only words and more words"),
        (None, "a shared line of text"),
        (8, "12345 67890"),
        (9, "Ünïcode TEXT Straße É x"),
    ]
    docs = make_docs(rows)
    from pyspark.sql import functions as F

    return docs.withColumn("source", F.when(F.col("doc_id") == 4, None).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 3)))


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture
def with_clashes():
    """Adds columns under names that the operators could use themselves."""
    from pyspark.sql import functions as F

    def add(docs):
        names = ["id", "digest", "owner", "h1", "size", "weight", "u", "fp", "key", "shard", "slot", "score", "piece", "length", "marks", "copies", "label"]
        return docs.select("*", *[F.lit(f"x{i}").alias(n) for i, n in enumerate(names)])

    return add
