import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from threadloom.llm import simhash

COLS = ["doc_id", "fp", "component_id"]


def slow_hash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(pairs, radius=3):
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if bin(a ^ b).count("1") <= radius:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return sorted(((d, f, least.get(find(f))) for d, f in pairs), key=repr)


def rows(df):
    return sorted(((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in df.select(*COLS).collect()), key=repr)


def test_fingerprints_match_definition(edge_rows):
    for _, t in edge_rows:
        assert simhash.simhash64(t) == slow_hash(t)


def test_components_match_all_pairs(edge, edge_rows):
    want = slow_components([(d, slow_hash(t)) for d, t in edge_rows])
    assert rows(simhash.near_duplicates(edge)) == want
    assert rows(simhash.near_duplicates(edge, block_rows=7)) == want  # many blocks, same result


def test_links_over_blocks_find_chains(spark):
    rng = random.Random(1)
    fps = []
    for _ in range(60):  # chains of single-bit steps and of three-bit steps
        f = rng.getrandbits(64)
        for step in range(rng.randint(1, 12)):
            fps.append(f)
            for b in rng.sample(range(64), rng.choice([1, 3, 4])):
                f ^= 1 << b
    pairs = list(enumerate(fps))
    signed = [(d, f - (1 << 64) if f >> 63 else f) for d, f in pairs]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    kinds = df.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    comp = {r["node"]: r["root"] for r in simhash.components(simhash.links(kinds.select("fp"), 3, 50)).collect()}
    want = slow_components(pairs)
    least = {}
    for d, f in signed:
        r = comp.get(f, f)
        least[r] = min(d, least.get(r, d))
    assert sorted(((d, f & (2**64 - 1), least[comp.get(f, f)]) for d, f in signed), key=repr) == want


def test_large_tiles_are_compared_in_parts():
    fps = np.array([1 << i for i in range(64)] + [3 << i for i in range(63)], np.uint64)
    t = simhash._Tiles(fps)
    got = {tuple(sorted((int(t.fps[a]), int(t.fps[b])))) for x, y in simhash._near_pairs(t, t, True, 3, budget=16) for a, b in zip(x, y, strict=True) if a != b}
    want = {tuple(sorted((int(a), int(b)))) for i, a in enumerate(fps) for b in fps[i + 1 :] if bin(int(a) ^ int(b)).count("1") <= 3}
    assert got == want


def test_empty(nothing):
    assert simhash.near_duplicates(nothing).count() == 0


def test_hot_copies_and_order(spark):
    rng = random.Random(5)
    one = prose(rng, 60)
    data = [(i, one if i % 3 else prose(rng, 60)) for i in range(300, 0, -1)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df.repartition(7)).collect()}
    assert all(out[i] == (1 if i % 3 else i) for i in out)
