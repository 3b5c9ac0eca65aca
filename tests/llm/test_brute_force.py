"""Queries without SQL on small written tables, against plain versions of them."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from talkloom.llm import decontaminate, toxicity_knn
from talkloom.llm.queries import QUERIES
from talkloom.llm.textbytes import Words, text_buffer
from tests.llm.test_operators import key, nearest_stretch, prose


def held_out(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 3 == 1


def test_op1_toxicity(spark, tmp_path):
    rng = random.Random(31)
    rows, labels = [(None, "vile words"), (9000, None), (9001, "")], []
    for k in range(400):
        words = prose(k, 40, 3000).split()
        if k % 4 == 0:
            for at in rng.sample(range(40), 2):
                words[at] = rng.choice(["Vile,", "awful!", "nasty", "foul"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op1_toxicity"](spark, str(tmp_path)).collect()
    text, toxic = dict(rows), dict(labels)
    known = [k for k in toxic if not held_out(k)]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    index = toxicity_knn.fit(docs, spark.createDataFrame([(k, text[k], toxic[k]) for k in known], "id long, text string, label int"))

    def dense(t):
        data, off = text_buffer(pa.array([t], pa.string()))
        _, where, times = index.terms.counts(Words(data, off))
        out = np.zeros(len(index.idf))
        out[where] = (1 + np.log(times)) * index.idf[where]
        return out / max(np.linalg.norm(out), 1e-15)

    examples = np.array([dense(text[k]) for k in known])
    assert sorted(key((r.doc_id, r.held_out)) for r in got) == sorted(key((i, held_out(i))) for i, _ in rows)
    for r in got:
        cosines = sorted((c for c in examples @ dense(text[r.doc_id]) if c > 1e-12), reverse=True)[: toxicity_knn.EVIDENCE]
        assert [e.cosine for e in r.evidence] == pytest.approx(cosines, abs=1e-8)
        assert all(e.label == toxic[int(e.example)] for e in r.evidence)
        assert r.predicted == (r.score >= 0.7)
        if r.doc_id in toxic:
            assert r.predicted == toxic[r.doc_id]


def test_op3_decontamination(spark, tmp_path):
    rng = random.Random(32)
    items = [(k, prose(4000 + k, n, 300)) for k, n in enumerate([3, 5, 8, 16, 24, 33, 50])] + [(90, None), (91, "")]
    rows = [(900, None), (901, "")]
    for k in range(42):
        words = items[k % 7][1].split()
        for _ in range(rng.randrange(len(words) // 3 + 1)):  # within the limit of edits, at it and beyond
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = rng.choice([[], ["edited"]])
        rows.append((k, f"{prose(k, 30, 300)} {' '.join(words)} {prose(100 + k, 30, 300)}"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = []
    for i, t in rows:
        for k, item in items[:7]:
            edits = nearest_stretch(item.split(), (t or "").split())
            if edits <= int(decontaminate.EDITS * len(item.split())):
                want.append((i, k, edits))
    got = QUERIES["op3_decontamination"](spark, str(tmp_path)).collect()
    assert 10 < len(want) and sorted((r.doc_id, r.item_id, r.edits) for r in got) == sorted(want)


def test_op8_language_id(spark, tmp_path):
    words = {"aa": "the of and with", "bb": "der die und nicht", "cc": "que los para una"}
    rng = random.Random(33)
    rows = [(3 * k + j, " ".join(rng.choice(words[lang].split()) for _ in range(30)), lang) for k in range(60) for j, lang in enumerate(words)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 34 ...", None), (None, "the and of with the", "cc")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op8_language_id"](spark, str(tmp_path)).collect()
    want = [(i, held_out(i), {1000: "und", 1001: "und", 1002: "und", None: "aa"}.get(i, lang)) for i, _, lang in rows]
    assert sorted(key((r.doc_id, r.held_out, r.lang_pred)) for r in got) == sorted(map(key, want))
    assert all(0 <= r.score <= 1 for r in got)
