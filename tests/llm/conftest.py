import random

import pytest

from loanscope.llm.queries import importable


@pytest.fixture(autouse=True)
def reachable(spark):
    importable(spark)


#: Names that operators use themselves, as further columns of a table.
CLASHING = ["version", "rep", "root", "key", "bands", "place", "content", "block", "shard", "size"]


@pytest.fixture
def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows, ties, one id with two texts; odd columns."""
    draw = random.Random(11)
    long = "\n".join(" ".join(draw.choice(["lorem", "ipsum", "Dolor"]) + str(draw.randint(0, 9999)) for _ in range(40)) for _ in range(2000))
    some = "\n".join(" ".join(f"w{draw.randint(0, 500)}" for _ in range(20)) for _ in range(8))
    rows = [
        (1, some), (1, some), (2, None), (3, ""), (4, " \n\t \n"), (5, long), (6, long + "\nend of it"),
        (7, "one"), (8, "one"), (None, some), (None, None), (9, "üñí " * 30), (9, "another text of nine"),
        (10, some.upper()), (11, "<|endoftext|> aあb \U0001f600"), (-5, some + "\nmore words here"),
    ]
    rows = [(*r, *(f"{c}{i}" for c in CLASHING)) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING))


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
