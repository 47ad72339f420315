import pytest

from errlens.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def package_on_executors(spark):
    ship(spark)


WORDS = ("the of and to in for on with as by at from this that was were been have has had not but all any can "
         "may one two out up down over under again then once here there when where why how both each few more").split()


def prose(seed: int, n: int) -> str:
    """Invented prose, the same for the same seed."""
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "ing", "ed", "ly", "er"]) for _ in range(n))


# Columns that clash with names used inside the operators.
CLASH = "doc_id long, text string, id string, ID long, h int, salt int, t string, size int, x0 string, spans int, Text string"


def documents(spark, rows):
    """A documents frame with clashing extra columns; rows are (doc_id, text)."""
    data = [(i, t, "x", 1, 2, 3, "y", 4, "z", 5, "other") for i, t in rows]
    return spark.createDataFrame(data, CLASH)


CASES = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (None, "a"), (5, "a b"), (5, "a b"), (6, "a  b\n"), (6, "other"),
         (7, None), (8, "é ü 日本語 🙂"), (9, "x" * 5000), (10, prose(1, 300)), (11, prose(1, 300)), (12, prose(2, 3000))]
