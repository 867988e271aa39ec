import random
import sys
from pathlib import Path

import pytest

from tests.llm.conftest import prose, words
from tests.llm.test_decontaminate import slow as contaminated
from tests.llm.test_simhash import slow_components, slow_hash
from threadloom.llm import packing, pii, quality

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    bench = [(i, prose(rng, 30)) for i in range(5)]
    docs, labels = [], []
    for i in range(240):
        t = prose(rng, rng.randint(60, 160))
        if i % 10 == 0:
            t = " ".join(w + "##" for w in t.split())
        elif i % 10 == 1 and i > 10:
            t = docs[i - 4][1]
        elif i % 10 == 2:
            t = f"{t} {bench[i % 5][1]} {t[:50]}"
        elif i % 10 == 3:
            t += f" mail me at joe{i}@corp{i % 3}.com"
        docs.append((i, t, "en", "s", len(t)))
        if i % 3:
            labels.append((i, 0 if i % 10 == 0 else 1, 0))
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert words is not None
    return str(path), docs, bench


def test_stages_match_brute_force(spark, tables):
    path, docs, bench = tables
    left = {d: t for d, t, *_ in docs}
    df = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, path)
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        got = {r["doc_id"]: r["text"] for r in df.collect()}
        if name == "quality_rules":
            want = {d: t for d, t in left.items() if d % 10 and quality.statistics_of(d, t).n_words >= 50}
        elif name == "near_dedup":
            keep = {d for d, _, c in slow_components([(d, slow_hash(t)) for d, t in left.items()]) if d == c}
            want = {d: t for d, t in left.items() if d in keep}
        elif name == "decontamination":
            bad = {d for d, _, n, _ in contaminated(list(left.items()), bench) if n}
            want = {d: t for d, t in left.items() if d not in bad}
        else:
            assert set(got) == set(left)
            for d, t in left.items():
                assert ("@" in t) == ("@" in got[d]) and (got[d] != t) == ("@" in t) and ".com" not in got[d].replace(".example.com", "")
            want = got
        assert got == want, name
        left = got
        df = spark.createDataFrame(df.collect(), df.schema)
    pieces = packing.pack(df)
    want = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in pieces.collect())
    full = corpus_pipeline.run(spark, path)
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in full.collect()) == want
    assert pii is not None and corpus_pipeline.ORACLE_SQL is None
