"""What jobs bring: search answers cut to the limit of their own job, and comment lists cut to the
limit of the job that brought the row first.

Limits come from the job table, so they differ from key to key. An answer names its job by
``job_id``; the place inside the job is a rank, since positions may have gaps. Before its exchange
a job sends the rows up to the largest limit of all jobs from each task, so a job that holds a third of all
answers does not cross it whole; after it, rank and the job's own limit meet in one partition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from talkloom.schemas import QUARANTINE_COLUMNS, ROW_ORD
from talkloom.sources.payloads import REGISTRY, first_results

# --- fixed values: results a search returns at least and at most, comments a fetch returns at most and if unlimited ---
RESULT_RANGE = {"youtube": (0, 50), "twitter": (10, 100)}
COMMENT_PAGE = {"youtube": (100, 100), "twitter": (100, 10)}
# --- end of fixed values ---

TARGETED = "0"
_FROM_JOB = ("collection_method", "query", "searched_subreddit", "job_ord", "include_comments", "comment_limit")


def with_job_id(jobs: DataFrame) -> DataFrame:
    """Jobs with ``job_id``: platform, kind (0 for id lists) and place, which tells all rows of ``build_jobs`` apart."""
    return jobs.withColumn("job_id", F.concat("platform", F.lit(":"), F.array_join(F.col("job_ord").cast("array<string>"), ".")))


def _is_targeted(job_id: str = "job_id") -> Column:
    return F.regexp_extract(job_id, "^[^:]*:([0-9]+)", 1) == TARGETED


def result_limit(platform: Column | str = "platform", limit: Column | str = "limit") -> Column:
    """Results a job may bring; null is all of them."""
    name, own = (F.col(c) if isinstance(c, str) else c for c in (platform, limit))
    value = own
    for known, (least, most) in RESULT_RANGE.items():
        value = F.when((name == known) & own.isNotNull(), F.least(F.greatest(own, F.lit(least)), F.lit(most))).otherwise(value)
    return F.greatest(value, F.when(own.isNotNull(), F.lit(0)))


def comment_limit(platform: str, limit: Column | str = "comment_limit") -> Column:
    """Comments of a row that are kept; null is all of them."""
    own = F.col(limit) if isinstance(limit, str) else limit
    if platform not in COMMENT_PAGE:
        return own
    most, unlimited = COMMENT_PAGE[platform]
    return F.least(F.coalesce(own, F.lit(unlimited)), F.lit(most))


def limited_results(answers: DataFrame, jobs: DataFrame) -> DataFrame:
    """``answers(job_id, pos, id, ...)`` within the limits of their jobs, with what rows take from a job.

    Id lists have no limit. Results at one place are ordered by id. Answers to no job are left out.
    """
    jobs = jobs if "job_id" in jobs.columns else with_job_id(jobs)
    wanted = jobs.select(
        "job_id",
        "collection_method",
        F.when(F.col("collection_method") != "targeted_id", F.col("keyword")).alias("query"),
        F.col("subreddit").alias("searched_subreddit"),
        "job_ord",
        "include_comments",
        "comment_limit",
        result_limit().alias("_limit"),
    )
    answers = answers.drop(*[c for c in _FROM_JOB if c in answers.columns])
    largest = wanted.filter(~_is_targeted()).agg(F.max("_limit")).first()[0]
    place = F.row_number().over(Window.partitionBy("job_id").orderBy("pos", "id"))
    found = answers.filter(~_is_targeted()).withColumn("_place", place)
    if wanted.filter(~_is_targeted() & F.col("_limit").isNull()).isEmpty():
        found = first_results(found, F.lit((largest or 0) + 1), "_place")  # becomes a group limit below the exchange
    own = F.coalesce(F.col("_limit") + 1, F.col("_place") + 1)
    searched = first_results(found.join(wanted, "job_id"), own, "_place").drop("_place")
    listed = answers.filter(_is_targeted()).join(wanted, "job_id")
    return searched.unionByName(listed).drop("_limit")


def job_rows(jobs: DataFrame, answers: Mapping[str, DataFrame], run_ts: str, registry=None) -> DataFrame:
    """Extraction rows of all answers in job order, with ``include_comments`` and ``comment_limit`` of their job."""
    registry = registry or REGISTRY
    unknown = sorted(set(answers) - set(registry))
    if unknown or not answers:
        raise ValueError(f"no payload transform for platforms: {', '.join(unknown) or 'none given'}")
    jobs = with_job_id(jobs)
    rows = None
    for platform, found in sorted(answers.items()):
        part = registry[platform][0](limited_results(found, jobs.filter(F.col("platform") == platform)), run_ts)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    order = F.concat("job_ord", F.array(F.col("pos").cast("bigint")))
    return rows.withColumn(ROW_ORD, order).drop("job_ord", "pos")


def fetched_comments(rows: DataFrame, threads: Mapping[str, DataFrame], registry=None) -> DataFrame:
    """Comment lists of the ``rows`` that ask for them, each cut to its own limit.

    ``threads`` holds a payload table per platform (``source_id`` and what the platform's transform reads; with
    ``status``, ``error_type`` and ``message`` where fetches may have failed).
    """
    registry = registry or REGISTRY
    asked = rows.filter("include_comments").select("platform", F.col("id").alias("source_id"), "comment_limit")
    lists = None
    for platform, found in sorted(threads.items()):
        own = asked.filter(F.col("platform") == platform).select("source_id", comment_limit(platform).alias("comment_limit"))
        part = registry[platform][1](found.join(own, "source_id"), F.col("comment_limit"))
        lists = part if lists is None else lists.unionByName(part, allowMissingColumns=True)
    if lists is None:
        raise ValueError("no comment threads given")
    if "status" in lists.columns:  # of some platforms
        lists = lists.withColumn("status", F.coalesce("status", F.lit("ok")))
        for name in ("error_type", "message"):
            lists = lists if name in lists.columns else lists.withColumn(name, F.lit(""))
    return lists


def job_failures(jobs: DataFrame, errors: DataFrame, stage: str, run_ts: str) -> DataFrame:
    """Quarantine rows of jobs that failed as a whole: ``errors(job_id, error_type, message)``."""
    named = F.coalesce(F.when(F.col("keyword") != "", F.col("keyword")), F.array_join("ids", ","), F.lit(""))
    hit = with_job_id(jobs).join(errors, "job_id")
    return hit.withColumns({"failed_at_utc": F.lit(run_ts), "stage": F.lit(stage), "id_or_query": named}).select(*QUARANTINE_COLUMNS)
