import random

import pytest

WORDS = "the of and tion in ha er on thing land water stone river light house garden summer winter letter market".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(300)) * (draw.random() < 0.7) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Plain texts, copies, near copies, shared passages, blanks, nulls and one very long text."""
    shared = prose(99, 60)
    rows = [(i, prose(i, 20 + 7 * i)) for i in range(40)]
    rows += [(100 + i, prose(3, 41)) for i in range(5)]
    rows += [(200 + i, prose(200 + i, 10) + "\n" + shared + "\t" + prose(300 + i, 12)) for i in range(6)]
    rows += [(300, prose(20, 160) + " end"), (301, prose(20, 160) + " END"), (302, None), (303, ""), (304, " \t\n ")]
    rows += [(305, "Ünï çode Été 日本   x"), (306, "same " * 50), (307, prose(77, 30_000)), (308, "a b"), (309, "A  B")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(4)


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated rows, and columns named as the operators name theirs."""
    rows = [(None, "one two three", 1, "x"), (7, None, 2, None), (7, "one two three", 3, "y"), (7, "one two three", 3, "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, word string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
