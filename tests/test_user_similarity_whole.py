"""All similar users are found: without a word in common, of equal texts, of equal words, of any size."""

import random
import zlib

from threadloom.operators import similarity

SCHEMA = "user string, id long, text string"


def size(text):
    return len(zlib.compress(text.encode(), 9))


def distance(x, y):
    cx, cy = size(x), size(y)
    return min(1.0, max(0.0, (size(x + " " + y) - min(cx, cy)) / max(cx, cy)))


def test_no_similar_pair_is_left_out(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(400)]
    rows = [(f"s{i}", k, w) for i in range(8) for k, w in enumerate(words[40 * i : 40 * i + 2])]  # no word in common
    rows += [(f"{u}copy", k, t) for u in "ahzt" for k, t in enumerate(("one text of many", "and the other"))]  # before and behind the others
    rows += [(f"e{i}", k, " ".join(rng.sample(words[:50], 50))) for i in range(5) for k in range(2)]  # equal words, other texts
    rows += [(u, k, "".join(rng.choice("abcdefghijklmnop \n") for _ in range(40_000))) for u in ("big", "large") for k in range(2)]
    whole = {}
    for u, _, t in sorted(rows):
        whole[u] = f"{whole[u]} {t}" if u in whole else t
    want = {(a, b): distance(whole[a], whole[b]) for a in whole for b in whole if a < b}
    posts = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for threshold in (0.5, 0.9):
        got = [tuple(r) for r in similarity.user_similarity(posts, threshold=threshold).collect()]
        near = {p: d for p, d in want.items() if d <= threshold}
        assert len(got) == 2 * len(near) and {(a, b): d for a, b, d, _ in got if a < b} == near
        assert {(b, a): d for a, b, d, _ in got if a > b} == near and all(s == 1 - d for *_, d, s in got)
        assert len(near) > 6


def test_pairs_left_out_are_surely_apart_and_copies_are_compared_once(spark):
    classes = spark.createDataFrame([("a", "z", 1000, 900), ("b", "b", 100, 2), ("c", "c", 950, 800)], "first string, last string, own long, sure long")
    # a is alike itself and last; 900 of a and 100 in b: at least 0.8 apart
    assert {tuple(r) for r in similarity.possible_pairs(classes, 0.7).collect()} == {("a", "a"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", "a")}
    assert {tuple(r) for r in similarity.possible_pairs(classes, 0.8).collect()} == {("a", "a"), ("a", "b"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", "a")}
    rows = [("v", 1, "x" * 9), ("v", 2, None), ("u", 5, "x" * 9), ("u", 5, None), ("w", 1, "ä"), ("w", 2, "x")]
    texts = {r["user"]: r for r in similarity.whole_texts(similarity.chunks(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert {u: r["own"] for u, r in texts.items()} == {"v": size("x" * 9 + " "), "u": size(" " + "x" * 9), "w": size("ä x")}
    assert all(r["sure"] <= r["own"] for r in texts.values()) and len({bytes(r["digest"]) for r in texts.values()}) == 3
