import pytest
from pyspark.sql import Row

#: Columns that operators use inside, as columns of the input.
CLASHING = [
    "print", "hash", "stratum", "lot", "block", "epoch", "position", "n_tokens", "found", "shard",
    "rank", "tokens", "segment", "key", "keys", "n", "rows", "slot", "shards", "root", "e", "lines",
]

LONG = " ".join(f"word{i % 997} and{i}" for i in range(30_000))

ROWS = [
    (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "a"),
    (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "a"),
    (2, "One two three four five six seven eight nine ten eleven twelve.", "en", None),
    (None, "A line that is long enough\nA line that is long enough", None, "b"),
    (None, None, "en", "b"),
    (3, None, None, None),
    (4, "", "de", "b"),
    (5, " \t\n \n", "de", "b"),
    (6, "12 34 !!! ###", "de", "a"),
    (7, LONG, "en", "a"),
    (8, "ÉCOLE Ünïcode ñandú ☃ été", "fr", "c"),
    (9, "  A LINE THAT IS LONG ENOUGH \r\nshort", "en", "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, repeated rows, extra columns."""
    docs = spark.createDataFrame(
        [Row(*r, *([7] * len(CLASHING))) for r in ROWS],
        "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` int" for c in CLASHING),
    )
    return docs.repartition(3, "text")


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
