import random
import re

from tests.llm.conftest import prose, words
from threadloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(t):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))


def slow(docs, items):
    wins = {}
    for i, t in items:
        w = cut(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1) if w else ():
            wins.setdefault(tuple(w[a : a + k]), set()).add(i)
    sizes = {len(x) for x in wins}
    out = []
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if (i := wins.get(tuple(w[a : a + k]))) is not None:
                    hit.update(range(a, a + k))
                    found |= i
        out.append((d, len(w), len(hit), sorted(x for x in found if x is not None)))
    return sorted(out, key=repr)


def fast(df):
    return sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in df.collect()), key=repr)


def planted(seed=4):
    rng = random.Random(seed)
    few = words(rng, 12)  # a small vocabulary makes many chance matches
    items = [(i, " ".join(rng.choice(few) for _ in range(rng.randint(8, 30)))) for i in range(8)]
    items += [(20, prose(rng, 40)), (21, "Short item Here."), (22, "one"), (23, ""), (24, None), (None, prose(rng, 15)), (25, "same " * 30), (26, items[0][1]), (20, items[1][1])]
    docs = []
    for i in range(60):
        w = [rng.choice(few) for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            src = cut(items[rng.randrange(len(items))][1]) or ["x"]
            a = rng.randrange(len(src))
            at = rng.randint(0, len(w))
            w[at:at] = src[a : a + rng.randint(5, 25)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w)))
    docs += [(90, "same " * 100), (91, "a short ITEM here, one"), (None, items[8][1]), (92, None), (92, None), (93, prose(rng, 20_000) + " " + items[8][1])]
    return docs, items


def test_matches_brute_force(spark):
    for seed in (4, 5):
        docs, items = planted(seed)
        d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        b = spark.createDataFrame(items, "item_id long, text string")
        want = slow(docs, items)
        assert fast(decontaminate.contamination(d, b)) == want
        assert fast(decontaminate.contamination(d, b, block_bytes=200)) == want  # many blocks


def test_other_settings_keep_the_guarantee(spark):
    docs, items = planted(6)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for k in (1, 3, 10):
        assert fast(decontaminate.contamination(d, b, k=k)) == slow(docs, items)


def test_keeps_clean_and_edges(spark, edge, nothing):
    b = spark.createDataFrame([(1, "completely different words that never occur in any of those texts here"), (2, None)], "item_id long, text string")
    kept = decontaminate.keep_clean(edge, b)
    assert kept.count() == edge.count() and kept.columns == edge.columns
    assert decontaminate.digest(decontaminate.contamination(nothing, b)).count() == 0
    assert decontaminate.contamination(edge, b.where("false")).where("size(spans) > 0").count() == 0
    hit = spark.createDataFrame([(1, "same line here same line here same line here same")], "item_id long, text string")
    assert 72 not in [r["doc_id"] for r in decontaminate.keep_clean(edge, hit).collect()]


def test_joins_give_what_the_index_gives(spark, edge, nothing, monkeypatch):
    docs, items = planted(7)
    docs += [(200 + i % 3, docs[0][1]) for i in range(40)]  # a group of copies
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = slow(docs, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)  # both joins shuffled
    for k in (3, 10):
        assert fast(decontaminate.contamination(d, b, k=k, block_bytes=1)) == want
    none = decontaminate.contamination(nothing, b, block_bytes=1)
    assert none.columns == decontaminate.contamination(nothing, b).columns and none.count() == 0
    hit = spark.createDataFrame([(1, "same line here same line here same line here same"), (None, "one")], "item_id long, text string")
    kept = decontaminate.keep_clean(edge, hit, block_bytes=1)
    assert kept.columns == edge.columns
    assert sorted(map(repr, kept.select("doc_id").collect())) == sorted(map(repr, decontaminate.keep_clean(edge, hit).select("doc_id").collect()))
