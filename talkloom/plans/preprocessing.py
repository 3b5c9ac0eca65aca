"""Extraction rows to standardized rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from talkloom.operators.dedup import first_rows, relevant_history, skip_seen
from talkloom.operators.standardize import standardize, standardize_counts
from talkloom.operators.summaries import counts, difference, distributions, platform_count, union_metrics
from talkloom.plans.store import (
    ORDER,
    Sink,
    Store,
    commit_rows,
    mark_consumed,
    ordered_source,
    read_master,
    read_state,
    recover,
    unread_runs,
    write_summary,
)
from talkloom.schemas import EXTRACTION, STANDARDIZED
from talkloom.session import prepare_session, settle
from talkloom.sources.tables import seen_keys

STAGE = "preprocessing"
TABLE = "standardized"
SINK = Sink(STAGE, TABLE, STANDARDIZED)


def run_preprocessing(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    source: DataFrame | None = None,
    force: bool = False,
    limit: int | None = None,
    summarize: bool = True,
) -> DataFrame | None:
    """Standardize what was not seen yet; returns the summary rows.

    Without ``source`` the input is the extraction master, less the runs that are known
    to be through; its counters then cover the rows that were read.
    """
    prepare_session(spark)
    recover(spark, store, SINK)
    sizes = None
    if source is None:
        master = read_master(spark, store, "extraction_raw", EXTRACTION)
        if not force and limit is None:
            source, sizes = unread_runs(spark, store, STAGE, master)
        else:
            source = master
    raw = first_rows(ordered_source(source), limit, ORDER)
    # Parsed and cleaned once; sizing the keys, the anti-join and the counters read it.
    rows = settle(standardize(raw))
    seen = None
    if not force:
        seen = seen_keys(read_master(spark, store, TABLE, STANDARDIZED), read_state(spark, store, STAGE))
        seen = relevant_history(seen, rows.select("record_key"))
    written = commit_rows(skip_seen(rows, seen), store, SINK, run_id, run_ts)
    if sizes is not None:
        mark_consumed(sizes, store, STAGE)
    if not summarize:
        return None
    return write_summary(preprocessing_summary(raw, written, rows), store, STAGE, run_id)


def preprocessing_summary(raw: DataFrame, new_rows: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Counters of the transform (before skip-seen) and of the rows that were added."""
    transform = standardize_counts(raw, kept)
    added = counts(new_rows, {"new_rows_added": F.count(F.lit(1)), "num_platforms": platform_count()})
    both = union_metrics(transform, added)
    skipped = difference(both, "skipped_existing_rows", "output_rows", "new_rows_added")
    spread = distributions(
        new_rows,
        {
            "platform_distribution": "platform",
            "collection_method_distribution": "collection_method",
            "category_distribution": "category",
        },
    )
    return union_metrics(both, skipped, spread)
