import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from threadloom.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def slow_targets(sizes, weights=(1, 2, 3), share=1.0, most=3):
    """Reshares in rounds, as said."""
    names = sorted(sizes, key=lambda s: (s is None, [] if s is None else [ord(c) for c in s]))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = sum(sizes.values()) * share, {}
    while free := [s for s in names if s not in full]:
        unit = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * unit >= most * sizes[s]]
        if not over:
            return full | {s: w[s] * unit for s in free}
        full |= {s: most * sizes[s] for s in over}
        left = max(0, left - sum(most * sizes[s] for s in over))
    return full


def slow_rates(sizes, target, most=3):
    """Halving on the tilt of one source."""
    x = np.array(sizes, float)
    if target >= most * x.sum():
        return np.full(len(x), most)
    z = x / max(1.0, x.mean())
    lo, hi = -1e4, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        with np.errstate(over="ignore"):
            lo, hi = (mid, hi) if (x * np.minimum(most, np.exp(mid * z))).sum() < target else (lo, mid)
    return np.minimum(most, np.exp(lo * z))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        source = rng.choice(["a", "b", "B", "é", "😀", "￿", None, "hot", "hot", "hot", "hot"])
        rows.append((i, prose(rng, rng.choice([rng.randint(1, 30), rng.randint(20, 200)])), source))
    return rows + [(2000, None, "a"), (2001, "", "b"), (2002, " \n", "void"), (None, "one two", "a"), (None, "one two", "a"), (2003, prose(rng, 2), "small"), (2004, prose(rng, 4), "tiny"), (2005, prose(rng, 5000), "hot")]


def test_targets_rates_and_copies(spark, corpus):
    got = mixing.mix(spark.createDataFrame(corpus, SCHEMA).repartition(3)).collect()
    assert len(got) == len(corpus)
    assert sorted(repr((r["doc_id"], r["size"], r["source"])) for r in got) == sorted(repr((d, size(t), s)) for d, t, s in corpus)
    sizes = {}
    for _, t, s in corpus:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = slow_targets(sizes)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]}
        assert all(math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9) for r in own), s
        rates = slow_rates([r["size"] for r in own], want[s])
        assert all(math.isclose(r["rate"], x, rel_tol=1e-3, abs_tol=1e-6) for r, x in zip(own, rates, strict=True) if r["size"]), s
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - want[s]) <= max(1.0, 0.01 * want[s]), (s, taken, want[s])
        assert abs(sum(r["rate"] * r["size"] for r in own) - want[s]) <= 0.26 + 1e-6 * want[s]
    assert all(0 <= r["copies"] <= 3 and r["copies"] == int(r["copies"]) for r in got)
    near = [abs(r["copies"] - r["rate"]) for r in got if r["size"]]
    assert sum(x >= 1 for x in near) <= 3 * len(sizes)  # but for the mended ones


def test_reruns_and_layouts_agree(spark, corpus):
    seen = []
    for n, parts in ((1, "4"), (7, "9")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        seen.append(sorted(repr((r["doc_id"], r["size"], r["target"], r["copies"])) for r in mixing.mix(spark.createDataFrame(corpus, SCHEMA).repartition(n)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


def test_a_hot_cell_and_equal_rows(spark):
    same = spark.range(30_000).selectExpr("id AS doc_id", "'one two three' AS text", "'hot' AS source")
    equal = spark.range(20_000).selectExpr("-1L AS doc_id", "'four five six' AS text", "'hot' AS source")
    rest = spark.range(3000).selectExpr("id + 100000 AS doc_id", "repeat('w ', 1 + id % 9) AS text", "'b' AS source")
    got = mixing.mix(same.union(equal).union(rest).repartition(3))
    sums = {r["source"]: r for r in got.groupBy("source").agg(F.sum(F.expr("copies * size")).alias("taken"), F.first("target").alias("target"), F.count("*").alias("n"), F.max("copies").alias("most")).collect()}
    assert {s: r["n"] for s, r in sums.items()} == {"hot": 50_000, "b": 3000}
    for r in sums.values():
        assert abs(r["taken"] - r["target"]) <= 3 and r["most"] <= 3
    kinds = {tuple(r) for r in got.where("source = 'hot'").groupBy("copies").count().collect()}
    n_extra = dict(kinds)
    assert sum(n_extra.values()) == 50_000 and len(kinds) == 2


def test_records_are_repeated_whole(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA).selectExpr("*", "1 AS size", "'x' AS copies", "map('a', 1) AS rate", "named_struct('b', 2) AS record", "doc_id AS digest")
    mixed = mixing.mix(docs)
    out = mixing.repeated(mixed)
    assert out.columns == docs.columns
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]
    want = {repr((r["doc_id"], r["record"]["text"])): 0 for r in mixed.collect()}
    for r in mixed.collect():
        want[repr((r["doc_id"], r["record"]["text"]))] += r["copies"]
    have = {}
    for r in out.collect():
        have[repr((r["doc_id"], r["text"]))] = have.get(repr((r["doc_id"], r["text"])), 0) + 1
    assert have == {k: v for k, v in want.items() if v}


def test_bounds_and_shares(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 5 + i % 40), s) for i, s in enumerate(["big"] * 400 + ["little"] * 5 + ["z"] * 100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    for percent, weights in ((250.0, (1, 9, 3)), (10.0, (5,))):
        want = slow_targets(sizes, weights, percent / 100)
        got = mixing.mix(docs, weights, percent).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.expr("copies * size")).alias("n"), F.max("copies").alias("most")).collect()
        for r in got:
            assert math.isclose(r["t"], want[r["source"]], rel_tol=1e-9) and abs(r["n"] - r["t"]) <= max(2, 0.01 * r["t"]) and r["most"] <= 3


def test_edges_and_plan(spark, edge, nothing):
    assert mixing.mix(nothing).count() == 0
    got = mixing.mix(edge)
    assert got.count() == edge.count() and got.where("copies is null").count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], SCHEMA)
    assert [(r["size"], r["target"]) for r in mixing.mix(empty).collect()] == [(0, 0.0)] * 2
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", got._jdf.queryExecution().executedPlan().toString())


def test_word_counts(spark):
    texts = [None, "", " ", "a", " a", "a ", "\x0b a\x0c\rb \n", "a\x1cb", "a b", " ", "x" * 1_000_000, " " * 1_000_000, "a " * 300_000, "\n" * 500_000 + "a"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.word_count(F.col("text")).alias("n")).collect()
    assert [r["n"] for r in got] == [size(t) for t in texts]
