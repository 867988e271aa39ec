"""Distances whose texts are compressed once a part, cut into pieces."""

import random
import zlib

from threadloom.operators import similarity

SCHEMA = "user string, id long, text string"


def test_pieces_keep_the_stream_and_parts_bound_the_work(spark, monkeypatch):
    monkeypatch.setattr(similarity, "CHUNK", 50)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
    rows = [(f"u{u}", rng.choice([None, *range(9)]), " ".join(rng.choices(words, k=rng.randrange(40)))) for u in range(12) for _ in range(30 if u == 3 else 8)]
    rows += [("u0", 4, None), ("empty", 1, ""), ("empty", 2, None), ("ß", 1, "ü" * 300), ("ß", 1, "ä")]
    users = sorted({r[0] for r in rows})
    whole = {u: " ".join(t or "" for _, _, t in sorted((r for r in rows if r[0] == u), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))).encode() for u in users}
    size = lambda x: len(zlib.compress(x, 9))
    met = [(a, b) for a in users for b in users if a < b]
    pairs = spark.createDataFrame(met, "a string, b string")
    got = {(r["a"], r["b"]): r["distance"] for r in similarity.distances(spark.createDataFrame(rows, SCHEMA).repartition(7), pairs).collect()}
    assert set(got) == set(met)
    for a, b in met:
        x, y, xy = size(whole[a]), size(whole[b]), size(whole[a] + b" " + whole[b])
        assert got[a, b] == min(1.0, max(0.0, (xy - min(x, y)) / max(x, y)))

    sizes = {u: len(t) + 1 for u, t in whole.items()}
    plan = [tuple(r) for r in similarity.dealt(pairs, spark.createDataFrame(list(sizes.items()), "user string, size long")).collect()]
    assert sorted((a, b) for a, _, b in plan if b) == met
    assert {a for a, _, _ in plan} == set(users)  # each is compressed alone somewhere
    behind = sum(sizes[b] for _, b in met)
    # before, both texts of each pair went through two compressors
    assert sum(sizes[a] for a, _ in {p[:2] for p in plan}) + behind <= 2 * behind + sum(sizes.values()) < 2 * sum(sizes[a] + sizes[b] for a, b in met)
