import random

import pytest

SYL = ["th", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "ea", "é", "ü"]


def words(rng, n):
    return ["".join(rng.choice(SYL) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng, n):
    return " ".join(words(rng, n))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, empties, ties, repeats, copies, a long text."""
    rng = random.Random(3)
    base = prose(rng, 200)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, None), (None, base), (4, base), (5, base), (5, base), (6, base + " tail"), (7, "one"), (8, "one two"), (9, "ONE two Three")]
    rows += [(10 + i, prose(rng, rng.randint(3, 300))) for i in range(40)]
    rows += [(60 + i, base[:600] + prose(rng, 40)) for i in range(5)]
    rows += [(70, prose(rng, 30_000)), (71, "a " * 3000), (72, "\n".join(["same line here"] * 60))]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The rows with columns whose names the operators use themselves."""
    clash = ["fp", "n_words", "kept", "spans", "slot", "block", "g", "row", "name", "open", "m", "e", "low", "bytes", "n_replaced"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash)
    rows = [(d, t, "en", "s0", None if t is None else len(t), *["x"] * len(clash)) for d, t in edge_rows]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
