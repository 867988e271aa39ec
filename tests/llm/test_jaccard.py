import random

from tests.llm.conftest import prose, words
from threadloom.llm import jaccard


def slow_set(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_kept(rows):
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first = {}
    for i in order:
        first.setdefault(find(i), rows[i])
    return sorted(first.values(), key=repr)


def edited(rng, t, n):
    w = t.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = words(rng, 1)[0] + "x"
    return " ".join(w)


def run(spark, rows, parts=3):
    out = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts))
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


def test_similar_texts_match_brute_force(spark):
    rng = random.Random(4)
    rows, line = [], prose(rng, 40)
    for g in range(60):
        base = prose(rng, rng.randint(20, 250)) + (" " + line if g % 3 == 0 else "")
        rows.append((len(rows), base))
        for _ in range(rng.randint(0, 4)):
            rows.append((len(rows), edited(rng, base, rng.randint(1, max(1, len(base.split()) // 30)))))
    rows += [(900, None), (901, ""), (902, "one"), (903, "One"), (904, "one two")]
    assert run(spark, rows) == slow_kept(rows)


def test_large_group_and_order_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(6)
    base = prose(rng, 120)
    rows = [(i, edited(rng, base, rng.randint(0, 5)) if i % 2 else prose(rng, 60) + " " + base[:200]) for i in range(160)]
    want = slow_kept(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(jaccard, "ORDER_SHARE", 0.0)
    monkeypatch.setattr(jaccard, "CROWD", 1)  # all that is open is compared in the order of exact counts
    assert run(spark, rows) == want


def test_rows_without_or_with_equal_ids(spark, edge, nothing):
    rng = random.Random(8)
    a, b, c = (prose(rng, 60) for _ in range(3))
    assert run(spark, [(3, a), (5, a), (5, b), (7, b), (None, b), (None, c), (None, c)]) == sorted([(3, a), (5, b), (None, c)], key=repr)
    assert jaccard.keep_one(edge).columns == edge.columns
    assert jaccard.keep_one(nothing).count() == 0


def test_maps_and_clashing_names_stay(spark):
    rng = random.Random(9)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a, {"k": "v"}, 5, [{"x": 1}]), (1, a, {"k": "w"}, 6, None), (2, a, None, 7, []), (3, b, {}, 8, None), (None, b, {"z": "z"}, 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, set_id map<string,string>, high int, r array<map<string,int>>")
    got = jaccard.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["set_id"], r["high"]) for r in got.collect()) == [(1, {"k": "w"}, 6), (3, {}, 8)]
