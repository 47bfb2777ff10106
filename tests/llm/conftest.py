import pytest

from samples import texts


@pytest.fixture(scope="session")
def rows():
    out = [(k * 3 + 1, t) for k, t in enumerate(texts())]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Documents with further columns, among them names that the operators use inside."""
    from sluice.llm.registry import ship

    ship(spark)
    given = [(i, t, "en" if i % 2 else None, "src0", len(t or ""), "clash", 1) for i, t in rows]
    return spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long, spans string, block int").repartition(5)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def repeated(docs):
    """Repeated rows, and a row without an id."""
    from pyspark.sql import functions as F

    return docs.union(docs).union(docs.where("text is not null").limit(1).withColumn("doc_id", F.lit(None).cast("long")))
