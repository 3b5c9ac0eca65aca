"""Landings driven by a job table: limits per job, comments by the job that came first."""

import json

import pytest
from pyspark.sql import functions as F

from talkloom.plans.extraction import run_jobs
from talkloom.plans.store import read_master
from talkloom.schemas import EXTRACTION, QUARANTINE
from talkloom.sources.jobs import build_jobs
from talkloom.sources.landing import comment_limit, fetched_comments, limited_results, result_limit, with_job_id
from talkloom.sources.payloads import REDDIT_COMMENTS, REDDIT_POST, TWEET
from tests.conftest import RUN_TS, metrics_of, rows_of

JOBS = "platform string, collection_method string, ids array<string>, subreddit string, keyword string, `limit` int, include_comments boolean, comment_limit int, part long, job_ord array<long>"


def jobs_of(spark, *rows):
    return spark.createDataFrame([(p, m, ids, None, word, n, c, cn, 0, o) for p, m, ids, word, n, c, cn, o in rows], JOBS)


def answers_of(spark, schema, *rows):
    return spark.createDataFrame(rows, f"job_id string, pos long, id string").select("job_id", "pos", F.from_json(F.to_json(F.struct("id")), schema).alias("p")).select("job_id", "pos", "p.*")


@pytest.fixture
def jobs(spark):
    return jobs_of(
        spark,
        ("reddit", "targeted_id", ["a", "z"], None, None, True, 2, [0, 0]),
        ("reddit", "keyword", None, "one", 2, True, 1, [2, 5]),
        ("reddit", "keyword", None, "all", None, False, 3, [2, 6]),
        ("reddit", "keyword", None, "none", 0, True, None, [2, 7]),
        ("twitter", "keyword", None, "one", 3, True, 0, [2, 5]),
    )


@pytest.fixture
def answers(spark):
    posts = [("reddit:0.0", 9, "a"), ("reddit:0.0", 4, "b"), ("reddit:2.5", 30, "c"), ("reddit:2.5", 10, "a"), ("reddit:2.5", 20, "d"), ("reddit:2.5", 20, "e")]
    posts += [("reddit:2.6", k, f"x{k}") for k in range(5)] + [("reddit:2.6", 9, "d"), ("reddit:2.7", 0, "never"), ("reddit:9.9", 0, "of no job")]
    talk = [("twitter:2.5", k, f"t{k:02d}") for k in range(40)]
    return {"reddit": answers_of(spark, REDDIT_POST, *posts), "twitter": answers_of(spark, TWEET, *talk)}


def test_each_job_has_its_own_limit(spark, jobs, answers):
    found = limited_results(answers["reddit"], jobs.filter("platform = 'reddit'"))
    got = {}
    for r in found.collect():
        got.setdefault(r.job_id, set()).add(r.id)
    # gaps in positions do not count, ties go by id, lists have no limit
    assert got == {"reddit:0.0": {"a", "b"}, "reddit:2.5": {"a", "d"}, "reddit:2.6": {"x0", "x1", "x2", "x3", "x4", "d"}}


def test_group_limit_lies_below_the_exchange(spark, jobs, answers):
    limited = jobs.filter("platform = 'twitter'")
    plan = limited_results(answers["twitter"], limited)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(job_id") :]
    assert "WindowGroupLimit" in below


def test_limits_of_the_platforms(spark):
    cases = [("reddit", 7), ("youtube", 70), ("youtube", 7), ("twitter", 3), ("twitter", 300), ("forum", -1), ("twitter", None)]
    df = spark.createDataFrame(cases, "platform string, `limit` int").select(result_limit().alias("n"))
    assert [r.n for r in df.collect()] == [7, 50, 7, 10, 100, 0, None]
    one = spark.createDataFrame([(None,), (500,), (3,)], "comment_limit int")
    read = lambda platform: [r.n for r in one.select(comment_limit(platform).alias("n")).collect()]
    assert (read("reddit"), read("youtube"), read("twitter")) == ([None, 500, 3], [100, 100, 3], [10, 100, 3])


def test_run_jobs(spark, store, jobs, answers):
    threads = spark.createDataFrame(
        [(i, [(f"{i}{k}", "body") for k in range(5)], "ok", "", "") for i in ("a", "b", "d", "x0")] + [("x1", None, "error", "E", "gone"), ("d2", None, "ok", "", "")],
        "source_id string, comments array<struct<id:string,body:string>>, status string, error_type string, message string",
    )
    filled = threads.withColumn("comments", F.from_json(F.to_json("comments"), REDDIT_COMMENTS.split("comments ")[1]))
    errors = spark.createDataFrame([("reddit:2.7", "Timeout", "slow")], "job_id string, error_type string, message string")
    summary = metrics_of(run_jobs(spark, store, "r", RUN_TS, jobs, answers, {"reddit": filled}, errors))
    master = read_master(spark, store, "extraction_raw", EXTRACTION)
    got = {r.id: (r.collection_method, json.loads(r.metadata_json).get("query"), [c["id"] for c in json.loads(r.comments_json)]) for r in master.collect() if r.platform == "reddit"}
    assert got["a"] == ("targeted_id", None, ["a0", "a1"])  # the list came first, with its own comment limit
    assert got["d"] == ("keyword", "one", ["d0"]) and got["x0"] == ("keyword", "all", [])
    assert sorted(got) == ["a", "b", "d", "x0", "x1", "x2", "x3", "x4"]
    assert rows_of(master.filter("platform = 'twitter'"), "id") == [(f"t{k:02d}",) for k in range(10)]
    assert summary["configured_jobs", ""] == 5 and summary["errors", ""] == 1
    assert summary["output_rows", ""] == 18 and summary["skipped_existing_rows", ""] == 2
    failed = spark.read.schema(QUARANTINE).parquet(store.quarantine())
    assert rows_of(failed, "platform", "collection_method", "id_or_query", "error_type") == [("reddit", "keyword", "none", "Timeout")]
    again = metrics_of(run_jobs(spark, store, "r2", RUN_TS, jobs, answers, {"reddit": filled}))
    assert again["output_rows", ""] == 0 and master.count() == 18


def test_failed_fetches_of_one_platform(spark):
    rows = spark.createDataFrame([("reddit", "a", True, 1), ("twitter", "b", True, 2), ("reddit", "c", False, 1)], "platform string, id string, include_comments boolean, comment_limit int")
    good = spark.createDataFrame([("a", [("1", "x")]), ("c", [("2", "x")])], "source_id string, comments array<struct<id:string,body:string>>")
    good = good.withColumn("comments", F.from_json(F.to_json("comments"), REDDIT_COMMENTS.split("comments ")[1]))
    bad = spark.createDataFrame([("b", None, "error", "E", "m")], "source_id string, data array<struct<id:string,text:string,author_id:string,created_at:string>>, status string, error_type string, message string")
    assert rows_of(fetched_comments(rows, {"reddit": good, "twitter": bad}), "platform", "source_id", "status") == [("reddit", "a", "ok"), ("twitter", "b", "error")]


def test_jobs_from_lists_have_ids_of_their_own(spark):
    values = spark.createDataFrame([([k], f"v{k}") for k in range(3)], "pos array<bigint>, value string")
    jobs = with_job_id(build_jobs({"reddit": values}, values, values))
    assert jobs.count() == jobs.select("job_id").distinct().count() == 1 + 9 + 9


def test_no_answers(spark, store, jobs):
    empty = answers_of(spark, REDDIT_POST, ("reddit:2.5", 0, "a")).limit(0)
    assert metrics_of(run_jobs(spark, store, "r", RUN_TS, jobs, {"reddit": empty}))["output_rows", ""] == 0
    with pytest.raises(ValueError, match="no payload transform"):
        run_jobs(spark, store, "r", RUN_TS, jobs, {"unknown": empty})
