"""The pipeline on a small table, and every registered query on the smallest given tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from talkloom.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.test_operators import SCHEMA, prose

SF = "/root/testdata/sf0.001"


def test_each_decision_takes_effect(spark, tmp_path):
    item = prose(900, 30)
    rows = [(k, prose(k, 60), "xx") for k in range(20)]
    near = rows[3][1].split()
    near[30] = "changed"
    rows += [(100, rows[2][1], "xx"), (101, " ".join(near), "xx"), (102, prose(901, 20) + " " + item, None), (103, None, "xx"), (104, "12 34", None), (None, prose(950, 40), "xx"), (0, prose(951, 40), "xx")]
    spark.createDataFrame([(i, t, lang, "s", 1, "extra") for i, t, lang in rows], SCHEMA + ", score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
        left.append(docs.count())
    assert left == [25, 24, 23, 22]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({(r.doc_id is None, r.doc_id) for r in packed.collect()}, key=str) == sorted({(i is None, i) for i, *_ in rows if i not in (100, 101, 102, 103, 104)}, key=str)


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(got, connect(SF), ORACLES[name]) == ""
    else:
        assert got.count() > 0
