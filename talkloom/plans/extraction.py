"""Landed payload rows and uploads to the extraction table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from talkloom.functions.keys import extraction_key
from talkloom.functions.text import blank_if_null, null_if_blank
from talkloom.operators.dedup import first_wins, relevant_history, skip_seen
from talkloom.operators.summaries import counts, difference, distributions, platform_count, union_metrics
from talkloom.plans.store import Sink, Store, commit_rows, quarantine, read_master, read_state, recover, write_summary
from talkloom.schemas import EXTRACTION, EXTRACTION_COLUMNS, QUARANTINE_COLUMNS, ROW_ORD
from talkloom.session import prepare_session, settle
from talkloom.sources.landing import fetched_comments, job_failures, job_rows
from talkloom.sources.tables import conform, extraction_seen
from talkloom.sources.uploads import list_files, read_records, upload_counts, upload_items, upload_rows, with_upload_order

STAGE = "extraction"
TABLE = "extraction_raw"
SINK = Sink(STAGE, TABLE, EXTRACTION, key=extraction_key, partition_by="platform")


def conform_extraction(rows: DataFrame) -> DataFrame:
    """The thirteen columns; blank comment lists and metadata become empty JSON."""
    extra = [c for c in rows.columns if c not in EXTRACTION_COLUMNS]
    fallback = {"comments_json": "[]", "metadata_json": "{}"}

    def pick(name: str):
        value = blank_if_null(name) if name in rows.columns else F.lit("")
        if name in fallback:
            value = F.coalesce(null_if_blank(value), F.lit(fallback[name]))
        return value.alias(name)

    return rows.select(*[pick(c) for c in EXTRACTION_COLUMNS], *extra)


def first_landings(landed: DataFrame) -> DataFrame:
    """First landing of every (platform, id) in job order."""
    keyed = conform_extraction(landed).withColumn("record_key", extraction_key())
    return first_wins(keyed, "record_key", [ROW_ORD])


def select_new_rows(landed: DataFrame, seen: DataFrame | None) -> DataFrame:
    return skip_seen(first_landings(landed), seen)


def attach_comments(rows: DataFrame, comments: DataFrame) -> DataFrame:
    """Comment lists fetched for the rows; a failed or missing fetch leaves ``[]``.

    ``comments(platform, source_id, comments_json[, status])`` has one row per item.
    """
    status = F.col("status") if "status" in comments.columns else F.lit("ok")
    fetched = comments.filter(status == "ok").select(
        F.col("platform").alias("_p"), F.col("source_id").alias("_s"), F.col("comments_json").alias("_c")
    )
    joined = rows.join(fetched, (F.col("platform") == F.col("_p")) & (F.col("id") == F.col("_s")), "left")
    return joined.withColumn(
        "comments_json", F.coalesce(null_if_blank("_c"), F.col("comments_json"))
    ).drop("_p", "_s", "_c")


def comment_errors(rows: DataFrame, comments: DataFrame, run_ts: str) -> DataFrame:
    """Quarantine rows of comment fetches that failed for the given rows."""
    failed = comments.filter("status <> 'ok'").select(
        F.col("platform").alias("_p"), F.col("source_id").alias("_s"), "error_type", "message"
    )
    hit = rows.join(failed, (F.col("platform") == F.col("_p")) & (F.col("id") == F.col("_s")))
    return hit.select(
        F.lit(run_ts).alias("failed_at_utc"),
        F.lit(STAGE).alias("stage"),
        "platform",
        "collection_method",
        F.col("id").alias("id_or_query"),
        "error_type",
        "message",
    ).select(*QUARANTINE_COLUMNS)


def run_extraction(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    landed: DataFrame,
    comments: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    job_errors: DataFrame | None = None,
    jobs: DataFrame | None = None,
    force: bool = False,
) -> DataFrame:
    """Commit landed rows (extraction columns and ``row_ord``); returns the summary rows.

    ``comments`` are lists fetched beforehand, or a function that gives them for the rows found new.
    """
    prepare_session(spark)
    recover(spark, store, SINK)
    rows = settle(first_landings(landed))  # landed payloads are parsed once
    seen = None
    if not force:
        seen = extraction_seen(read_master(spark, store, TABLE, EXTRACTION), read_state(spark, store, STAGE))
        seen = relevant_history(seen, rows.select("record_key"))
    rows = skip_seen(rows, seen)
    if callable(comments):
        rows = settle(rows)  # the fetch and the commit read the same choice
        comments = settle(comments(rows))
    if comments is not None:
        rows = attach_comments(rows, comments)
    written = commit_rows(rows, store, SINK, run_id, run_ts)
    errors = job_errors
    if comments is not None and "status" in comments.columns:
        failed = comment_errors(written, comments, run_ts)
        errors = failed if errors is None else conform(errors, QUARANTINE_COLUMNS).unionByName(failed)
    if errors is not None:
        quarantine(errors, store)
    return write_summary(extraction_summary(landed, written, jobs, errors), store, STAGE, run_id)


def run_jobs(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    jobs: DataFrame,
    answers: Mapping[str, DataFrame],
    threads: Mapping[str, DataFrame] | None = None,
    errors: DataFrame | None = None,
    registry=None,
    force: bool = False,
) -> DataFrame:
    """Extraction driven by the job table: landed answers per platform, cut to the limits of their jobs.

    Comment lists are made for new rows alone, and only where the job that brought a row first asks
    for them. ``errors(job_id, error_type, message)`` names jobs that failed as a whole.
    """
    landed = job_rows(jobs, answers, run_ts, registry)
    comments = None if threads is None else lambda rows: fetched_comments(rows, threads, registry)
    failed = None if errors is None else job_failures(jobs, errors, STAGE, run_ts)
    return run_extraction(spark, store, run_id, run_ts, landed, comments, failed, jobs, force)


def extraction_summary(
    landed: DataFrame, new_rows: DataFrame, jobs: DataFrame | None = None, errors: DataFrame | None = None
) -> DataFrame:
    """Skipped and duplicate rows are the same number: both count every landing not kept."""
    total = counts(landed, {"_landed": F.count(F.lit(1))})
    done = counts(
        new_rows,
        {
            "output_rows": F.count(F.lit(1)),
            "new_rows_added": F.count(F.lit(1)),
            "num_platforms": platform_count(),
        },
    )
    both = union_metrics(total, done)
    parts = [
        done,
        difference(both, "skipped_existing_rows", "_landed", "output_rows"),
        difference(both, "duplicate_rows_skipped", "_landed", "output_rows"),
    ]
    if jobs is not None:
        # A long id list spans several rows of one job.
        parts.append(counts(jobs, {"configured_jobs": F.count_if(F.col("part") == 0)}))
    if errors is not None:
        parts.append(counts(errors, {"errors": F.count(F.lit(1))}))
    spread = distributions(
        new_rows,
        {"platform_distribution": "platform", "collection_method_distribution": "collection_method"},
    )
    return union_metrics(*parts, spread)


def run_upload(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    folder: str,
    output: str | None = None,
) -> DataFrame:
    """Normalize a folder of uploads: chosen output, run copy and both summaries."""
    prepare_session(spark)
    items = settle(upload_items(read_records(spark, folder)))  # rows and counters read it
    files = list_files(spark, folder)
    rows = with_upload_order(upload_rows(items, run_ts), files).select(*EXTRACTION_COLUMNS, ROW_ORD)
    copy = store.snapshot("manual", run_id, "manual_extraction_raw")
    rows.write.mode("overwrite").parquet(copy)
    output = output or f"{store.root}/manual/manual_extraction_raw"
    spark.read.parquet(copy).write.mode("overwrite").parquet(output)
    summary = write_summary(upload_counts(items, files), store, "manual", run_id)
    summary.write.mode("overwrite").json(f"{output}_summary")
    return summary
