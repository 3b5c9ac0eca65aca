"""Streams of all four stages, cut short at every step of a commit and started again."""

import pytest
from pyspark.sql import functions as F

from talkloom.plans import commits
from talkloom.plans.commits import CommitLog
from talkloom.plans.store import read_master, read_snapshots, read_state, stage_schema
from talkloom.plans import classification, extraction, language, preprocessing
from talkloom.schemas import CLASSIFICATION, EXTRACTION, STANDARDIZED
from talkloom.streaming.runner import read_landing, stream_classification, stream_extraction, stream_language, stream_preprocessing
from tests.conftest import RUN_TS, rows_of
from tests.test_stages import MATCHER, MODEL, extraction as extraction_rows, standardized

VALID = {"provided_classification_label": "valid_ai_healthcare"}
POSTS = [{"platform": "reddit", "id": str(k), "text": f"text {k}"} for k in range(3)] + [{"platform": "reddit", "id": "1", "text": "again"}]
ROWS = [{"id": "a", "text": "none of it", **VALID}, {"id": "b", "text": "hospital only"}, {"id": "a", "text": "again"}]


def classified(spark):
    rows = standardized(spark, *[{"id": k, "text": "t", "provided_language_label": "french"} for k in "aba"])
    missing = [F.lit("").alias(c) for c in CLASSIFICATION.fieldNames() if c not in rows.columns]
    return rows.select("*", *missing).select(*CLASSIFICATION.fieldNames(), "row_ord", "run_id")


STAGES = {
    "extraction": (extraction.SINK, EXTRACTION, lambda s: extraction_rows(s, *POSTS).withColumn("run_id", F.lit("")), lambda *a: stream_extraction(*a), 3),
    "preprocessing": (preprocessing.SINK, EXTRACTION, lambda s: extraction_rows(s, *POSTS).withColumn("run_id", F.lit("")), lambda *a: stream_preprocessing(*a), 3),
    "classification": (classification.SINK, STANDARDIZED, lambda s: standardized(s, *ROWS), lambda s, st, r, t, *a: stream_classification(s, st, r, t, MATCHER, MODEL, *a), 2),
    "language": (language.SINK, CLASSIFICATION, classified, lambda s, st, r, t, *a: stream_language(s, st, r, t, MODEL, *a), 2),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_a_stream_writes_each_row_once_wherever_it_is_cut_short(spark, store, tmp_path, monkeypatch, name):
    sink, schema, make, stream, wanted = STAGES[name]
    landing = str(tmp_path / "landing")
    make(spark).coalesce(1).write.parquet(landing)
    mark, cut, ran = commits.Commit.mark, set(), []

    def crash_once(self, step):
        if step not in cut:
            cut.add(step)
            raise RuntimeError(f"driver lost before {step}")
        mark(self, step)

    monkeypatch.setattr(commits.Commit, "mark", crash_once)
    failed = 0
    while True:
        source = read_landing(spark, landing, schema=stage_schema(schema))
        query = stream(spark, store, "s", RUN_TS, source, str(tmp_path / "checkpoint"))
        try:
            query.awaitTermination(300)
            break
        except Exception as lost:  # noqa: BLE001
            assert "driver lost before" in str(lost)
            failed += 1
    steps = {"snapshot", "master", "state", "done"} | ({"valid"} if sink.valid_table else set())
    assert cut == steps and failed == len(steps)
    run = "s-000000"
    ids = rows_of(read_master(spark, store, sink.table, sink.schema), "id")
    assert len(ids) == wanted == len(set(ids))
    assert rows_of(read_snapshots(spark, store, sink, run), "id") == ids
    assert read_state(spark, store, sink.stage).count() == wanted
    if sink.valid_table:
        assert rows_of(read_master(spark, store, sink.valid_table, sink.schema), "id") == [("a",)]
    log = CommitLog(spark, store.root, sink.stage)
    assert log.left_open() == [] and log.attempts(run) == [0] and log.through(run)


def test_a_repeated_run_id_keeps_the_snapshot_of_its_first_attempt(spark, store):
    from talkloom.plans.preprocessing import run_preprocessing

    first = extraction_rows(spark, {"platform": "reddit", "id": "1", "text": "a"})
    more = extraction_rows(spark, {"platform": "reddit", "id": "1", "text": "a"}, {"platform": "reddit", "id": "2", "text": "b"})
    run_preprocessing(spark, store, "daily run/1", RUN_TS, first, summarize=False)
    run_preprocessing(spark, store, "daily run/1", RUN_TS, more, summarize=False)
    sink = preprocessing.SINK
    assert rows_of(spark.read.parquet(store.snapshot(sink.stage, "daily run/1", sink.table)), "id") == [("1",)]
    assert rows_of(read_snapshots(spark, store, sink, "daily run/1"), "id") == [("1",), ("2",)]
    assert rows_of(read_master(spark, store, sink.table, STANDARDIZED), "id") == [("1",), ("2",)]
    assert read_state(spark, store, sink.stage).count() == 2
