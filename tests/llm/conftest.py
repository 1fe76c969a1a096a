import pytest

from assayline.llm.tables import ship


@pytest.fixture(scope="package", autouse=True)
def shipped(spark):
    ship(spark)


# A null, an empty, a blank and a long text, ties, repeated rows, a null id beside a large one.
EDGE = [
    (None, None),
    (1, None),
    (2, ""),
    (3, "  \n "),
    (4, "one two three four five six"),
    (4, "one two three four five six"),
    (5, "one two three four five six"),
    (2**60 + 1, "Ünïcode 漢字 😀 mail a.b@c.de +1 (017) 555-7713"),
    (7, "word " * 20_000),
    (8, "x" * 50_000),
]


@pytest.fixture(scope="package")
def edge_docs(spark):
    """The edge rows among columns whose names an operator may use itself."""
    extra = "text as key, doc_id as length, text as _key, text as words, doc_id as label"
    frame = spark.createDataFrame(EDGE, "doc_id long, text string").repartition(3)
    return frame.selectExpr("doc_id", "text", "'en' as lang", extra.split(", ")[0], *extra.split(", ")[1:])


@pytest.fixture(scope="package")
def no_docs(edge_docs):
    return edge_docs.where("false")
