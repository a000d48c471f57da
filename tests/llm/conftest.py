import pytest

from tidemill.session import ship

CLASHING = "score label features raw _row _end _part size key shard n root cid sig term copies _h1 _h2 m _size _doc".split()


@pytest.fixture(scope="session")
def spark(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and blank texts, ties, repeated rows, one long text, clashing columns."""
    long = "lorem ipsum dolor sit amet consectetur " * 3000
    prose = "one two three four five six seven eight nine ten eleven twelve " * 9
    rows = [
        (1, prose, "a"), (2, prose, "a"), (3, None, "a"), (4, "", None), (5, " \t\n ", None), (6, "word", "b"),
        (7, "word", "b"), (7, "word", "b"), (None, "no id here at all", "c"), (None, None, None), (8, long, "b"),
        (9, "ñandú déjà 漢字 😀 x", "c"), (10, prose + "tail", "a"), (11, "Word", "c"), (11, "other text", None),
    ]
    extra = ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame([(*r, *[0] * len(CLASHING)) for r in rows], f"doc_id long, text string, source string, {extra}")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
