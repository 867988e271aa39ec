import random
import re

import numpy as np

from tests.llm.conftest import prose
from threadloom.llm import quality


def slow(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    on = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(grams) < 2000 else None
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, on


def test_statistics_match_definition(edge_rows):
    for d, t in edge_rows + [(0, "a b c a b c d"), (0, "a a a a a"), (0, "x\x0by\x1cz q"), (0, "A\na\nA\n \n \n")]:
        s = quality.statistics_of(d, t)
        n, chars, symbols, dup, on = slow(t)
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines) == (n, chars, symbols, dup)
        if on is not None:
            assert s.n_repeat_words == len(on)


def make(spark, n=600):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = prose(rng, rng.randint(60, 200)).split()
        docs.append((i, " ".join(x + "!!" if bad and i % 8 else x.upper() + " |" if bad else x for x in w)))
        if i % 3:
            labels.append((i, 0 if bad else 1, 0))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learned_list_separates(spark):
    docs, labels = make(spark)
    out = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    assert all(out[i] == (i % 4 != 0) for i in out)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(600) if i % 4]


def test_rules_are_conditionals_in_order(spark):
    docs, labels = make(spark)
    rules = quality.fit(quality.document_statistics(docs), labels)
    assert rules and all(r.precision >= 0.9 and r.conditions for r in rules)
    assert "CASE WHEN" in str(quality.verdict(rules)) or "WHEN" in str(quality.verdict(rules)).upper()


def test_no_rule_from_noise():
    rng = np.random.default_rng(1)
    assert quality.learn(rng.random((800, len(quality.FEATURES))), rng.random(800) < 0.2) == []


def test_bound_holds_and_no_labels_keep_all(spark):
    docs, labels = make(spark, 200)
    assert quality.fit(quality.document_statistics(docs), labels, label_rows=5) == []
    none = labels.where("false")
    assert quality.judge(docs, none).where("kept").count() == 200


def test_edges(edge, nothing, spark):
    labels = spark.createDataFrame([(4, 0, 0), (4, 1, 0), (None, 0, 0), (10, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.judge(edge, labels)
    assert out.count() == edge.count()
    assert out.where("n_words < 50 and not base_failed").count() == 0
    assert out.where("doc_id = 71 and base_failed").count() == 1
    assert quality.keep_good(edge, labels).columns == edge.columns
    assert quality.judge(nothing, labels).count() == 0
