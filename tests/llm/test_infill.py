import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from threadloom.llm import infill

UNITS = {"line": r"[^\n]*\n|[^\n]+", "char": r"(?s)."}


def slow(doc_id, text, unit="line", rate=100, spm=50, seed=7):
    """Straight from the definition, over a list of units."""
    text = text or ""
    units = re.findall(UNITS[unit], text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(["a", "\n", "é", "中", "😀", " ", "\r", "\0"]), max_size=60), st.integers(1, 7), st.integers(1, 9), st.sampled_from(["line", "char"]))
def test_checkpoints_and_cuts(text, stride, block, unit):
    data = text.encode()
    index = infill.checkpoints(data, unit, stride, block)
    units = re.findall(UNITS[unit], text)
    assert (index.n_units, index.n_chars) == (len(units), len(text))
    assert len(index.units) <= 2 + len(units) // stride + len(data) // block + 1
    for n in range(len(units) + 1):
        head = "".join(units[:n])
        assert infill.cut(data, index, n, unit) == (len(head.encode()), len(head))


def test_checkpoints_are_sparse():
    data = "é line\n".encode() * 100_000
    index = infill.checkpoints(data)
    assert index.n_units == 100_000 and index.n_chars == 700_000
    assert len(index.units) <= 100_000 // infill.STRIDE + len(data) // infill.BLOCK + 3
    assert all(b - a <= infill.STRIDE for a, b in zip(index.units, index.units[1:], strict=False))


@pytest.mark.parametrize("unit", ["line", "char"])
def test_every_row_against_the_definition(spark, edge, edge_rows, unit):
    rule = infill.Rule(unit=unit, rate=80, spm=40)
    got = infill.fill_in_middle(edge, rule).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((repr((d, *slow(d, t, unit, 80, 40), t or "")) for d, t in edge_rows))
    assert sorted(repr(tuple(r)) for r in got) == want
    assert {"plain", "psm", "spm"} <= {r["form"] for r in got}


def test_sentinels_in_texts_and_long_units(spark):
    rng = random.Random(1)
    texts = ["<P>", "a <S> b", "x\n<M", "<<S\n>P>\nS>", "\n" * 1_000_000, "w" * 1_000_000, prose(rng, 20_000).replace(" ", "\n"), "é\n" * 50_000, "<P\n" * 1000 + ">", "\n", "\r\n"]
    rows = [(i + 100 * k, t) for k in range(4) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = infill.fill_in_middle(docs).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[0]) == sorted(((d, *slow(d, t), t) for d, t in rows), key=lambda r: r[0])


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'80FF0A41C3' AS STRING) AS text")
    r = infill.fill_in_middle(docs).select("n", "form", F.hex(infill.restored(F.col("output"), F.col("form")).cast("binary")).alias("x")).first()
    assert r["n"] == 2 and r["form"] != "plain" and r["x"] == "80FF0A41C3"


def test_empty_table_and_settings(spark, nothing):
    assert infill.fill_in_middle(nothing).count() == 0
    for marks in (("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("", "b", "c")):
        with pytest.raises(ValueError):
            infill.fill_in_middle(nothing, infill.Rule(marks=infill.Sentinels(*marks)))
    with pytest.raises(ValueError):
        infill.fill_in_middle(nothing, infill.Rule(unit="page"))
    assert not re.search("Exchange", infill.fill_in_middle(nothing)._jdf.queryExecution().executedPlan().toString())
