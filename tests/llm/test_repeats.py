import hashlib
import random
from collections import Counter

import pytest

from tests.llm.conftest import prose
from threadloom.llm import repeats


def slow(rows, length):
    lines = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in lines for i in range(len(b) - length + 1))
    out = []
    for d, b in lines:
        gone = repeats.merged([(i, i + length) for i in range(len(b) - length + 1) if seen[b[i : i + length]] > 1])
        left, at = b"", 0
        for x, y in gone:
            left, at = left + b[at:x], y
        left += b[at:]
        out.append((d, len(b), len(b) - len(left), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def fast(df, cover):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in repeats.remove_repeats(df, cover).collect()), key=repr)


def planted(seed, n=60):
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(20, 160)) for _ in range(6)]
    rows = []
    for i in range(n):
        t = prose(rng, rng.randint(0, 150))
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            at = rng.randint(0, len(t))
            t = t[:at] + p[a : a + rng.randint(50, 900)] + t[at:]
        rows.append((i, t))
    for i in range(20):  # copies, near copies with edits
        t = rows[rng.randrange(n)][1]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(t))
            t = t[:at] + rng.choice(["", "x", "yz é "]) + t[at + rng.randint(0, 2) :]
        rows.append((100 + i, t))
    return rows + [(200, "ab" * 700), (201, "a" * 1500), (202, "a" * 399), (203, "b" * 400), (204, "c" * 401), (None, rows[0][1]), (5, rows[5][1]), (205, None), (206, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = planted(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert fast(df, repeats.Cover()) == slow(rows, 400)


def test_other_covers(spark):
    rows = planted(3, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for cover in (repeats.Cover(60, 40, 8, 5), repeats.Cover(100, 10, 4, 16), repeats.Cover(50, 43, 8, 50)):
        assert fast(df, cover) == slow(rows, cover.length)


def test_slices_of_long_texts_agree(spark, monkeypatch):
    rng = random.Random(4)
    import numpy as np

    buf = np.frombuffer(prose(rng, 9000).encode(), np.uint8)
    whole = repeats.samples(buf, np.array([0]), np.array([len(buf)]), repeats.Cover())
    monkeypatch.setattr(repeats, "_SLICE", 1000)
    cut = repeats.samples(buf, np.array([0]), np.array([len(buf)]), repeats.Cover())
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))


def test_edges(edge, edge_rows, nothing):
    assert fast(edge, repeats.Cover()) == slow(edge_rows, 400)
    assert repeats.remove_repeats(nothing).count() == 0


def test_kept_bytes_are_given(spark):
    df = spark.createDataFrame([(1, "x" * 500), (2, "hello")], "doc_id long, text string")
    out = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(df).collect()}
    assert out == {1: b"", 2: b"hello"}
