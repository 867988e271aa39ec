"""The stage's fingerprint tiles and its crowds, held to brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tests.llm.test_jaccard import edited, run, slow_kept
from threadloom.llm import jaccard, simhash


def test_tiles_link_near_fingerprints_by_a_forest(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(12)}
    rows = [(i, f - (1 << 64) if f >> 63 else f, 100) for i, f in enumerate(sorted(fps))]
    rows += [(1000 + i, rows[i][1], 90) for i in range(9)]  # other sets of equal fingerprints
    by = {s: f % (1 << 64) for s, f, _ in rows}
    got = [(r["su"], r["sv"]) for r in jaccard.tiled(spark.createDataFrame(rows, "set_id long, fp long, n int")).collect()]
    assert all((by[u] ^ by[v]).bit_count() <= jaccard.RADIUS for u, v in got)

    def groups(pairs):
        root = {s: s for s in by}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for u, v in pairs:
            root[find(u)] = find(v)
        return {frozenset(s for s in by if find(s) == r) for r in {find(s) for s in by}}

    ids = list(by)
    assert groups(got) == groups([(u, v) for u in ids for v in ids if (by[u] ^ by[v]).bit_count() <= jaccard.RADIUS])
    assert len(got) == len(by) - len(groups(got))
    left = np.array(sorted(fps), np.uint64)
    u, v = simhash._forest(left[::2].tobytes(), left[1::2].tobytes(), 3, direct=True)
    assert len(u) and (np.bitwise_count(u ^ v) <= 3).all()


def test_crowd_that_is_somewhat_alike_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(12)
    base = prose(rng, 150)
    rows = [(i, edited(rng, base, rng.randint(4, 9))) for i in range(150)]
    tables = {}

    def counted(df, tag):
        out = written(df, tag)
        tables.setdefault(tag, []).append(out)
        return out

    written = jaccard.written
    monkeypatch.setattr(jaccard, "written", counted)
    monkeypatch.setattr(jaccard, "CROWD", 1)
    want = slow_kept(rows)
    assert run(spark, rows) == want
    early, crowd = tables["jaccard-early"][0], tables["jaccard-pairs"][-1]
    met = early.alias("a").join(early.alias("b"), "h").where("a.set_id < b.set_id and a.group != b.group").select("a.set_id", "b.set_id").distinct().count()
    assert crowd.count() < met / 4 and crowd.where(F.col("sure")).count() == crowd.count()
    monkeypatch.setattr(jaccard, "CARRIED", 0)  # sets too large to go along
    assert run(spark, rows) == want
    assert len(tables["jaccard-near"]) == 2  # fingerprints meet first
