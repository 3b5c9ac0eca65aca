import json

import pytest
from pyspark.sql import functions as F

from talkloom.operators.terms import TermMatcher
from talkloom.plans.chain import run_all
from talkloom.plans.store import export_csv, read_master
from talkloom.schemas import LANGUAGE, STANDARDIZED
from talkloom.sources.tables import read_table
from tests.conftest import RUN_TS, metrics_of, rows_of


def test_all_stages(spark, store, tmp_path):
    comments = json.dumps([{"id": "c1", "text": "AI triage at the hospital", "replies": [{"id": "r1", "text": "no thanks"}]}])
    landed = spark.createDataFrame(
        [("reddit", "keyword", "p1", "AI in a hospital near you", "", [0]), ("reddit", "keyword", "p2", "hospital food", comments, [1])],
        "platform string, collection_method string, id string, text string, comments_json string, row_ord array<bigint>",
    )

    def classifier(requests):
        ids = {r.batch_id: [i["row_id"] for i in json.loads(r.prompt.split("Rows:\n")[1])] for r in requests.collect()}
        rows = [(b, "ok", json.dumps({"results": [{"row_id": i, "model_classification": "valid_ai_healthcare"} for i in keys]}), "{}") for b, keys in ids.items()]
        return spark.createDataFrame(rows, "batch_id string, status string, body string, usage string")

    def scorer(texts):
        return texts.select("row_key", F.lit("en").alias("code"), F.lit(0.95).alias("score"))

    done = run_all(
        spark, store, "r1", RUN_TS, TermMatcher.build(["ai"], ["hospital"]), "model-x", landed, classifier=classifier, scorer=scorer
    )
    assert list(done) == ["extraction", "preprocessing", "classification", "language_detection"]
    assert metrics_of(done["preprocessing"])[("new_rows_added", "")] == 4
    assert metrics_of(done["classification"])[("model_classification_distribution", "invalid_neither")] == 1
    language = read_master(spark, store, "language_detection", LANGUAGE)
    assert rows_of(language, "id", "language_label") == [("c1", "english"), ("p1", "english")]
    export_csv(read_master(spark, store, "standardized", STANDARDIZED), str(tmp_path / "csv"), STANDARDIZED.fieldNames())
    assert rows_of(read_table(spark, str(tmp_path / "csv"), STANDARDIZED, "csv"), "id") == [("c1",), ("p1",), ("p2",), ("r1",)]
    again = run_all(spark, store, "r2", RUN_TS, TermMatcher.build(["ai"], ["hospital"]), "model-x", landed, classifier=classifier, scorer=scorer)
    assert metrics_of(again["extraction"])[("new_rows_added", "")] == 0
    assert metrics_of(again["language_detection"])[("new_rows_processed", "")] == 0
    with pytest.raises(ValueError, match="unknown stages"):
        run_all(spark, store, "r", RUN_TS, None, "m", stages=["x"])
