import random

import pytest

from threadloom.llm import repeats, suffix_array


@pytest.mark.parametrize("text", ["b", "banana", "mississippi$", "aaaaaaaaaa", "abcabcabcabca", None])
def test_ranks_match_sorting(spark, text):
    if text is None:
        rng = random.Random(1)
        text = "".join(rng.choice("ab") for _ in range(130))
    n = len(text)
    df = spark.createDataFrame([(i, ord(c)) for i, c in enumerate(text)], "pos long, sym long")
    got = {r["pos"]: r["rank"] for r in suffix_array.suffix_ranks(df, n).collect()}
    assert got == {p: i for i, p in enumerate(sorted(range(n), key=lambda p: text[p:]))}


def test_repeated_windows_equal_those_of_the_cover(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("abcd") for _ in range(90))
    rows = [(1, base), (2, "x" + base[10:60] + "y"), (3, "é" * 20), (4, None), (5, "abab" * 8), (6, base[:30])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in suffix_array.repeated_windows(df, 16).collect():
        got.setdefault(r["doc_id"], []).append((r["at"], r["at"] + 16))
    spans = {d: repeats.merged(s) for d, s in got.items()}
    want = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in repeats.remove_repeats(df, repeats.Cover(16, 10, 4, 4)).collect()}
    assert spans == {d: s for d, s in want.items() if s} and spans
