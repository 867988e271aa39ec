import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import prose
from threadloom.llm import resampling

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text, n=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def slow(rows, target, buckets=10_000, n=1, least=20, percent=10):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    own = [(d, *grams(t, n)) for d, t in rows]
    s, t = Counter(bucket(g) for _, _, gs in own for g in gs), Counter(bucket(g) for x in target for g in grams(x, n)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for d, words, gs in own:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain(bucket(g)) for g in gs)
        out.append([d, len(words), len(gs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    drawn = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for i, r in enumerate(drawn[: percent * len(drawn) // 100]):
        r[5] = i + 1
    return sorted(map(repr, map(tuple, out)))


@pytest.mark.parametrize("n,buckets,percent", [(1, 10_000, 10), (2, 97, 50), (3, 1000, 100)])
def test_every_row_against_the_definition(spark, edge, edge_rows, n, buckets, percent):
    rng = random.Random(8)
    target = [prose(rng, 50), None, "", edge_rows[5][1], "ÀÉ naïve İ K"]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, item_id long")
    got = resampling.resample(edge, rows, buckets=buckets, ngram=n, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == slow(edge_rows, target, buckets, n, percent=percent)


def test_slices_do_not_matter():
    rng = random.Random(9)
    text = (prose(rng, 3000) + " " + "x" * 5000 + "; É" + prose(rng, 50)).encode()
    for n in (1, 2, 4):
        want = Counter(zlib.crc32(g.encode()) % 500 for g in grams(text.decode(), n)[1])
        for size in (1, 7, 300, 4096, 1 << 20):
            words, where, counts = resampling.row_of(text, resampling._Buckets(500), n, size)
            assert dict(zip(where.tolist(), counts.tolist(), strict=True)) == want and words == len(grams(text.decode())[0])


def test_blocks_are_the_matrix(spark, edge, edge_rows):
    blocks = resampling.csr_blocks(edge, "t", buckets=50)
    rows = [(d, r["indices"][a:b], r["counts"][a:b]) for r in blocks.collect() for d, a, b in zip(r["doc_id"], r["indptr"], r["indptr"][1:], strict=False)]
    want = [(d, *zip(*sorted(Counter(zlib.crc32(g.encode()) % 50 for g in grams(t)[1]).items()), strict=True)) if grams(t)[1] else (d, (), ()) for d, t in edge_rows]
    assert sorted(map(repr, rows)) == sorted(repr((d, list(i), list(c))) for d, i, c in want)
    total = np.zeros(50, np.int64)
    for _, i, c in want:
        np.add.at(total, np.array(i, int), np.array(c, int))
    assert resampling.column_sums(blocks, 50).tolist() == total.tolist()


def test_it_draws_what_is_like_the_target(spark):
    rng = random.Random(4)
    near, far = [f"n{i}" for i in range(200)], [f"f{i}" for i in range(200)]
    docs = [(i, " ".join(rng.choice(near if i % 10 == 0 else far) for _ in range(60))) for i in range(500)]
    target = spark.createDataFrame([(" ".join(rng.choice(near) for _ in range(300)),)], "text string")
    got = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"), target).where("rank is not null").collect()
    assert {r["doc_id"] for r in got} == set(range(0, 500, 10)) and sorted(r["rank"] for r in got) == list(range(1, 51))


def test_repeated_rows_are_ranked_over_many_tasks(spark):
    docs = spark.range(5000).selectExpr("CASE WHEN id < 4000 THEN 1L ELSE id END AS doc_id", "repeat('same word ', 15) AS text")
    got = resampling.resample(docs, docs.limit(3), percent=90).toPandas()
    assert sorted(got["rank"].dropna().astype(int)) == list(range(1, 4501)) and got["weight"].nunique() == 1
    best = got.dropna().sort_values("rank")["score"]
    assert (best.diff().dropna() <= 0).all() and got["score"][got["rank"].isna()].max() <= best.min()


def test_empty_tables(spark, nothing):
    assert resampling.resample(nothing, nothing).count() == 0
    docs = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert [r["rank"] for r in resampling.resample(docs, nothing, percent=100).collect()] == [1]
