import random

from tests.llm.conftest import prose
from threadloom.llm import decontaminate, quality


def test_a_bad_row_takes_no_other_row_with_it(spark):
    rng = random.Random(2)
    good = [prose(rng, 80) for _ in range(3)]
    passage = prose(rng, 20)
    rows = [(None, good[0]), (None, "too short"), (None, None), (7, good[1]), (7, "too short"), (8, good[2]), (None, f"{good[0]} {passage}"), (8, f"{good[2]} {passage}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    left = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    sane = [r for r in rows if r[1] and len(r[1].split()) > 50]
    assert left(quality.keep_good(docs, labels)) == sorted(sane, key=repr)
    want = sorted([r for r in rows if not (r[1] and passage in r[1])], key=repr)
    assert left(decontaminate.keep_clean(docs, items)) == want
    assert left(decontaminate.keep_clean(docs, items.union(spark.createDataFrame([(2, prose(rng, 30))], items.schema)), block_bytes=50)) == want
