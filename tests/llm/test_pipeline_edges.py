"""Every stage on odd columns, repeated rows, hostile texts and no rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(31)
    path = str(tmp_path_factory.mktemp("edges"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(rng, 30)), (2, None), (3, "short one")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_odd_columns(spark, tables):
    rng = random.Random(32)
    base = [prose(rng, 90) for _ in range(20)]
    rows = [(i, t, {"k": str(i)}, (i, "x"), [{"a": i}]) for i, t in enumerate(base)]
    rows += [rows[3], rows[3][:2] + ({"k": "other"}, None, None), (None, base[5], None, None, None), (None, None, {}, (1, None), []), (7, "", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang map<string,string>, mark struct<doc_id:int,text:string>, kept array<map<string,int>>")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert 0 < out.count() <= docs.count(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tables).where("start = 0").count() == docs.count()


def test_no_rows_through_all_stages(spark, tables, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        assert docs.count() == 0, name


def test_hostile_texts_through_all_stages(spark, tables):
    n = 200_000
    texts = [x * (n // len(x)) for x in ("\n", " ", "<a", "a", "7", "a b ", "mit license\n\n", "x@y.de ", "\x00", "é", "😀 ", "Mr. ", "#")]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        assert out.select(F.count("*")).first()[0] >= 0, name
