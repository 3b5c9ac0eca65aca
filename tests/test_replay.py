"""Commits that are cut short and repeated; batches that were answered twice."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from talkloom.operators.batches import join_responses
from talkloom.plans import classification, store as stores
from talkloom.plans.classification import collect_classification, run_classification
from talkloom.plans.language import run_language
from talkloom.plans.store import commit_stage, read_master
from talkloom.schemas import CLASSIFICATION
from tests.conftest import RUN_TS, metrics_of, rows_of
from tests.test_stages import MATCHER, MODEL, PRICES, standardized

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("record_key", "platform", "id", "associated_id", "label")])


def rows(spark, *keys):
    data = [(k, "reddit", k, k, "valid" if k < "c" else "other", [i]) for i, k in enumerate(keys)]
    return spark.createDataFrame(data, "record_key string, platform string, id string, associated_id string, label string, row_ord array<long>")


def commit(frame, store, run_id):
    return commit_stage(frame, store, "classification", "all", SCHEMA, run_id, "2026-01-01T00:00:00Z", valid_table="valid", valid_filter=F.col("label") == "valid")


def valid_keys(spark, store):
    return sorted(r["record_key"] for r in spark.read.parquet(store.master("valid")).collect())


def test_valid_only_rows_survive_a_crash_after_the_master(spark, store, monkeypatch):
    def crash(*args):
        raise RuntimeError("driver lost")

    for run, replay in (("one", "one"), ("two", "three")):
        monkeypatch.setattr(stores, "write_valid", crash)
        with pytest.raises(RuntimeError):
            commit(rows(spark, f"a{run}", f"z{run}"), store, run)
        monkeypatch.undo()
        commit(rows(spark, "a").limit(0), store, replay)
    assert valid_keys(spark, store) == ["aone", "atwo"]


def test_two_answers_to_one_batch_give_each_row_once(spark):
    candidates = spark.createDataFrame([("b1", "r1"), ("b1", "r2")], "batch_id string, row_id string")
    answer = '{"results": [{"row_id": "r1", "model_classification": "x"}]}'
    responses = spark.createDataFrame([("b1", "error", ""), ("b1", "ok", answer), ("b1", "ok", answer)], "batch_id string, status string, body string")
    joined = join_responses(candidates, responses)
    assert joined.count() == 2 and joined.filter("failed").count() == 0


def two_candidates(spark):
    return standardized(spark, {"id": "a", "text": "AI hospital"}, {"id": "b", "text": "AI in a hospital"}, {"id": "n", "text": "none"})


def labelled(spark, store):
    rows = read_master(spark, store, "classification_all", CLASSIFICATION).filter("model_used <> 'rules_terms_filter'")
    return rows_of(rows, "id", "model_classification")


def classify(spark, store, run_id, rows, labeller=None, **more):
    return metrics_of(run_classification(spark, store, run_id, RUN_TS, MATCHER, MODEL, rows, labeller=labeller, **more))


def counting_labeller(calls):
    """Says ``unsure`` to all; every evaluation of a batch adds to ``calls``."""

    def label(requests):
        def answers(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    calls.add(1)
                    ids = [r["row_id"] for r in json.loads(row["prompt"].split("Rows:\n")[1])]
                    body = json.dumps({"results": [{"row_id": i, "model_classification": "unsure"} for i in ids]})
                    yield pa.RecordBatch.from_pylist([{"batch_id": row["batch_id"], "status": "ok", "body": body, "usage": '{"input_tokens": 5}'}])

        return requests.mapInArrow(answers, "batch_id string, status string, body string, usage string")

    return label


def test_a_repeated_run_keeps_what_waits_and_a_labeller_takes_it_once(spark, store):
    calls = spark.sparkContext.accumulator(0)
    rows = two_candidates(spark)
    for _ in range(2):
        classify(spark, store, "daily", rows, batch_size=1)
    waiting = spark.read.parquet(f"{store.root}/requests/classification/candidates")
    assert rows_of(waiting, "id") == [("a",), ("b",)]
    assert spark.read.parquet(f"{store.root}/requests/classification/prompts").count() == 2
    more = rows.unionByName(standardized(spark, {"id": "c", "text": "AI hospital c"}))
    prices = spark.createDataFrame([(MODEL, 1.0, 0.1, 2.0)], PRICES)
    stats = classify(spark, store, "daily", more, counting_labeller(calls), batch_size=1, prices=prices)
    assert stats[("rows_sent_to_gpt", "")] == 3 and calls.value == 3
    assert labelled(spark, store) == [(x, "unsure") for x in "abc"]
    assert spark.read.json(store.snapshot("classification", "daily", "cost")).first().input_tokens == 15
    stats = classify(spark, store, "next", more, counting_labeller(calls))
    assert stats[("rows_sent_to_gpt", "")] == 0 and calls.value == 3


def test_batches_of_a_failed_labeller_are_offered_again(spark, store):
    def fails(requests):
        raise RuntimeError("service down")

    rows = two_candidates(spark)
    with pytest.raises(RuntimeError):
        classify(spark, store, "one", rows, fails)
    classify(spark, store, "two", rows, counting_labeller(spark.sparkContext.accumulator(0)))
    assert labelled(spark, store) == [("a", "unsure"), ("b", "unsure")]


def test_an_answer_whose_run_was_lost_is_used_and_not_asked_for_again(spark, store, monkeypatch):
    def crash(*args, **kwargs):
        raise RuntimeError("driver lost")

    calls = spark.sparkContext.accumulator(0)
    rows = two_candidates(spark)
    monkeypatch.setattr(classification, "commit_rows", crash)
    with pytest.raises(RuntimeError):
        classify(spark, store, "one", rows, counting_labeller(calls))
    monkeypatch.undo()
    classify(spark, store, "two", rows, counting_labeller(calls))
    assert calls.value == 1 and labelled(spark, store) == [("a", "unsure"), ("b", "unsure")]


def test_force_labels_anew(spark, store):
    calls = spark.sparkContext.accumulator(0)
    rows = two_candidates(spark)
    classify(spark, store, "one", rows, counting_labeller(calls))
    stats = classify(spark, store, "two", rows, counting_labeller(calls), force=True)
    assert stats[("rows_sent_to_gpt", "")] == 2 and calls.value == 2


def test_language_batches_wait_for_a_labeller(spark, store):
    rows = standardized(spark, {"id": "m1", "text": "long enough text"})
    calls = spark.sparkContext.accumulator(0)
    for _ in range(2):
        run_language(spark, store, "daily", RUN_TS, MODEL, rows)
    stats = metrics_of(run_language(spark, store, "later", RUN_TS, MODEL, rows, labeller=counting_labeller(calls)))
    assert stats[("rows_sent_to_gpt", "")] == 1 and calls.value == 1
    stats = metrics_of(run_language(spark, store, "last", RUN_TS, MODEL, rows, labeller=counting_labeller(calls)))
    assert stats[("new_rows_processed", "")] == 0 and calls.value == 1


def test_a_forced_run_without_a_labeller_keeps_what_it_asks_for(spark, store):
    """Rows that are committed already wait again, until their own batch is answered; collecting writes a summary."""
    rows = two_candidates(spark)
    classify(spark, store, "one", rows, counting_labeller(spark.sparkContext.accumulator(0)))
    for run in ("two", "three"):
        classify(spark, store, run, rows, force=True)
    queue = classification.label_queue(spark, store)
    answer = counting_labeller(spark.sparkContext.accumulator(0))(spark.read.parquet(queue.path("prompts", "two")))
    for run, new in (("four", 2), ("five", 0)):
        collect_classification(spark, store, run, RUN_TS, MODEL, answer)
        summary = metrics_of(spark.read.json(store.snapshot("classification", run, "summary")))
        assert summary[("new_rows_processed", "")] == new and summary[("input_rows", "")] == (4 if new else 2)
        assert len(labelled(spark, store)) == 4
    stats = classify(spark, store, "six", rows, counting_labeller(spark.sparkContext.accumulator(0)))
    assert stats[("rows_sent_to_gpt", "")] == 2 and len(labelled(spark, store)) == 6  # what run three asked for


def test_answers_to_forced_rows_count_from_the_snapshot_on(spark, store, monkeypatch):
    def crash(*args, **kwargs):
        raise RuntimeError("driver lost")

    rows = two_candidates(spark)
    classify(spark, store, "one", rows, counting_labeller(spark.sparkContext.accumulator(0)))
    classify(spark, store, "two", rows, force=True)
    queue = classification.label_queue(spark, store)
    answer = counting_labeller(spark.sparkContext.accumulator(0))(spark.read.parquet(queue.path("prompts", "two")))
    for step in ("write_snapshot", "finish"):  # lost before and after the snapshot
        monkeypatch.setattr(stores, step, crash)
        with pytest.raises(RuntimeError):
            collect_classification(spark, store, "three", RUN_TS, MODEL, answer)
        monkeypatch.undo()
    collect_classification(spark, store, "three", RUN_TS, MODEL, answer)
    assert len(labelled(spark, store)) == 4
