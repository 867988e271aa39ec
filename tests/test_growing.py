"""The closure kept batch by batch against the closure of everything."""

import random

import pytest

from threadloom.operators import growing, threads

SCHEMA = "id string, parent_id string"


def forest(rng, n):
    rows = [(f"p{i}", None if rng.random() < 0.15 else f"p{rng.randint(max(0, i - 9), i - 1)}" if i and rng.random() < 0.9 else f"missing{i % 5}") for i in range(n)]
    rows += [("x", "y"), ("y", "z"), ("z", "x"), ("under", "x"), ("self", "self"), ("below", "self")]
    return rows + [(f"deep{i}", f"deep{i - 1}" if i else None) for i in range(70)]


def triples(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_the_whole(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = forest(rng, 150)
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(1, len(rows)), 2))
    folder = f"{tmp_path}/state"
    seen = []
    for part in (rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]):
        batch = part + rng.sample(seen, min(5, len(seen)))  # some come again
        growing.extend(spark.createDataFrame(batch + [(None, "p1")], SCHEMA), folder)
        seen += part
        assert triples(growing.closure(spark, folder)) == triples(threads.closure(spark.createDataFrame(seen, SCHEMA)))
    assert growing.versions(spark, folder) == [1, 2, 3]
    before = triples(growing.closure(spark, folder))
    growing.compact(spark, folder)
    assert growing.versions(spark, folder) == [4] and triples(growing.closure(spark, folder)) == before


def test_only_what_changes_is_written(spark, tmp_path):
    folder = f"{tmp_path}/state"
    rows = [(f"{t}-{i}", f"{t}-{i - 1}" if i else ("late" if t == "t3" else None)) for t in ("t1", "t2", "t3") for i in range(6)]
    growing.extend(spark.createDataFrame(rows, SCHEMA), folder)
    changed = growing.extend(spark.createDataFrame([("new", "t1-5"), ("late", None)], SCHEMA), folder)
    assert {r["id"]: (r["top"], r["steps"]) for r in changed.collect()} == {"new": ("t1-0", 6), "late": ("late", 0)} | {f"t3-{i}": ("late", i + 1) for i in range(6)}
    assert growing.extend(spark.createDataFrame([("new", "t2-0")], SCHEMA), folder).count() == 0  # known already
    assert growing.extend(spark.createDataFrame([], SCHEMA), folder).count() == 0
