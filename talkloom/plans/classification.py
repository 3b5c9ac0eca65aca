"""Standardized rows to classified rows.

A run routes every new row, commits the rows that rules or provided labels decide, and
leaves the rest as candidates plus a request table. Rows of a batch are committed once
its response is there: by a run with a ``labeller``, which takes all that waits, or by
``collect_classification``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from talkloom.functions.keys import row_key
from talkloom.operators.batches import (
    CLASSIFICATION_ANSWER,
    CLASSIFICATION_INSTRUCTIONS,
    failed_rows,
    join_responses,
    response_usage,
)
from talkloom.operators.dedup import drop_repeats, first_rows, relevant_history, skip_seen
from talkloom.operators.routing import decided_rows, label_candidates, route_rows
from talkloom.operators.summaries import (
    counts,
    difference,
    distributions,
    platform_count,
    price_usage,
    sum_usage,
    union_metrics,
)
from talkloom.operators.terms import TermMatcher
from talkloom.plans.labelling import Labeller, LabelQueue
from talkloom.plans.store import (
    ORDER,
    Sink,
    Store,
    commit_rows,
    mark_consumed,
    ordered_source,
    quarantine,
    read_master,
    read_state,
    recover,
    unread_runs,
    write_summary,
)
from talkloom.schemas import CLASSIFICATION, ROW_ORD, STANDARDIZED, VALID_AI_HEALTHCARE
from talkloom.session import prepare_session
from talkloom.sources.tables import read_table, seen_keys

STAGE = "classification"
TABLE = "classification_all"
VALID_TABLE = "classification_valid_only"
BATCH_SIZE = 30


def is_valid() -> Column:
    return F.col("model_classification") == VALID_AI_HEALTHCARE


SINK = Sink(STAGE, TABLE, CLASSIFICATION, valid_table=VALID_TABLE, valid=is_valid)

_ROUTED = T.StructType(
    CLASSIFICATION.fields
    + [T.StructField(ROW_ORD, T.ArrayType(T.LongType())), T.StructField("record_key", T.StringType())]
    + [T.StructField("route", T.StringType())]
)
_CANDIDATE = T.StructType(
    CLASSIFICATION.fields[:8]
    + [T.StructField("available_terms", T.StringType()), T.StructField(ROW_ORD, T.ArrayType(T.LongType()))]
    + [T.StructField("record_key", T.StringType()), T.StructField("row_id", T.StringType())]
    + [T.StructField("batch_id", T.StringType()), T.StructField("ord", T.IntegerType())]
    + [T.StructField("forced", T.StringType())]
)


def select_new(rows: DataFrame, seen: DataFrame | None) -> DataFrame:
    """First row of every key, then the ones not seen.

    Repeats and history are looked up with scans of the key columns alone.
    """
    rows = ordered_source(rows).withColumn("record_key", row_key())
    if seen is not None:
        seen = relevant_history(seen, rows.select("record_key"))
    return skip_seen(drop_repeats(rows, "record_key", ORDER), seen)


def stage_input(
    spark: SparkSession,
    store: Store,
    stage: str,
    master: DataFrame,
    source: DataFrame | None,
    limit: int | None,
    force: bool,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(all input rows, those to look at, sizes of the runs among them).

    Without a source of its own, a stage reads the master before it and leaves out the
    runs it is through with; the counters still speak of the whole input.
    """
    rows = first_rows(ordered_source(source if source is not None else master), limit, ORDER)
    if source is not None or limit is not None or force:
        return rows, rows, None
    unread, sizes = unread_runs(spark, store, stage, master)
    return rows, unread, sizes


def label_queue(spark: SparkSession, store: Store) -> LabelQueue:
    return LabelQueue(spark, store, STAGE, _CANDIDATE, CLASSIFICATION_INSTRUCTIONS, CLASSIFICATION_ANSWER)


def committed_keys(spark: SparkSession, store: Store) -> DataFrame:
    return seen_keys(read_master(spark, store, TABLE, CLASSIFICATION), read_state(spark, store, STAGE))


def run_classification(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    matcher: TermMatcher,
    model: str,
    source: DataFrame | None = None,
    labeller: Labeller | None = None,
    batch_size: int = BATCH_SIZE,
    prefilter_only: bool = False,
    force: bool = False,
    limit: int | None = None,
    prices: DataFrame | None = None,
) -> DataFrame:
    """Route, request and commit; returns the summary rows."""
    prepare_session(spark)
    recover(spark, store, SINK)
    master = read_master(spark, store, "standardized", STANDARDIZED)
    rows, unread, sizes = stage_input(spark, store, STAGE, master, source, limit, force)
    queue = label_queue(spark, store)
    # Rows that wait for a response are not routed or requested anew.
    seen = None if force else committed_keys(spark, store).unionByName(queue.candidates().select("record_key"))
    routed = route_rows(select_new(unread, seen), matcher, prefilter_only)
    work = store.snapshot(STAGE, run_id, "routed")
    # Texts are scanned for terms once; both branches read the written routes.
    routed.select(*_ROUTED.fieldNames()[:8], "available_terms", "model_used", "model_classification", ROW_ORD, "record_key", "route").write.mode(
        "overwrite"
    ).partitionBy("route").parquet(work)
    routed = read_routed(spark, store, run_id)
    decided = decided_rows(routed, run_ts)
    outputs, usage, sent = decided, None, None
    if not prefilter_only:
        own = queue.put(routed.filter("route = 'batch'"), run_id, batch_size, force)
        if labeller is not None:
            sent = own if force else queue.waiting(committed_keys(spark, store))
            usage = response_usage(queue.ask(sent, labeller, run_id), model)
            responses = queue.responses(sent)
            queue.settle(sent, responses, run_id)
            outputs = decided.select(*CLASSIFICATION.fieldNames(), ROW_ORD).unionByName(
                label_candidates(sent, responses, model, run_ts).select(*CLASSIFICATION.fieldNames(), ROW_ORD)
            )
            quarantine(failed_rows(join_responses(sent, responses), STAGE, run_ts), store)
    written = commit_rows(outputs, store, SINK, run_id, run_ts)
    if sizes is not None:
        mark_consumed(sizes, store, STAGE)
    if usage is not None and prices is not None:
        write_summary(price_usage(sum_usage(usage), prices), store, STAGE, run_id, "cost")
    if prefilter_only:
        summary = prefilter_summary(rows, routed)
    else:
        summary = classification_summary(rows, routed, written, sent)
    return write_summary(summary, store, STAGE, run_id)


def collect_classification(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    model: str,
    responses: DataFrame,
    prices: DataFrame | None = None,
) -> DataFrame:
    """Commit the candidates, of any earlier run, whose batch now has a response, and summarize them: what waited is the input."""
    prepare_session(spark)
    recover(spark, store, SINK)
    queue = label_queue(spark, store)
    new = queue.keep(responses, run_id)
    waiting = queue.waiting(committed_keys(spark, store))
    answers = queue.responses(waiting)
    queue.settle(waiting, answers, run_id)
    quarantine(failed_rows(join_responses(waiting, answers), STAGE, run_ts), store)
    written = commit_rows(label_candidates(waiting, answers, model, run_ts), store, SINK, run_id, run_ts)
    if prices is not None:
        write_summary(price_usage(sum_usage(response_usage(new, model)), prices), store, STAGE, run_id, "cost")
    write_summary(classification_summary(waiting, waiting, written, queue.answered(waiting, answers)), store, STAGE, run_id)
    return written


def read_routed(spark: SparkSession, store: Store, run_id: str) -> DataFrame:
    wanted = T.StructType([f for f in _ROUTED.fields if f.name != "classified_at_utc"])
    found = read_table(spark, store.snapshot(STAGE, run_id, "routed"), wanted)
    # Blank stands for missing at rest; undecided rows have no label yet.
    return found.withColumn("model_classification", F.when(F.col("model_classification") != "", F.col("model_classification")))


def classification_summary(
    rows: DataFrame, selected: DataFrame, outputs: DataFrame, sent: DataFrame | None = None
) -> DataFrame:
    """Counters and distributions of a full run; ``selected`` are the rows not skipped."""
    total = counts(rows, {"input_rows": F.count(F.lit(1))})
    done = counts(outputs, {"new_rows_processed": F.count(F.lit(1)), "num_platforms": platform_count()})
    parts = [total, done, skipped_rows(total, selected)]
    if sent is not None:
        parts.append(counts(sent, {"rows_sent_to_gpt": F.count(F.lit(1))}))
    spread = distributions(
        outputs,
        {
            "platform_distribution": "platform",
            "collection_method_distribution": "collection_method",
            "available_terms_distribution": "available_terms",
            "model_classification_distribution": "model_classification",
        },
    )
    return union_metrics(*parts, spread)


def skipped_rows(total: DataFrame, selected: DataFrame) -> DataFrame:
    taken = counts(selected, {"_selected": F.count(F.lit(1))})
    return difference(union_metrics(total, taken), "skipped_existing_rows", "input_rows", "_selected")


def prefilter_summary(rows: DataFrame, routed: DataFrame) -> DataFrame:
    """Counters of a prefilter-only run."""
    total = counts(rows, {"input_rows": F.count(F.lit(1))})
    done = counts(
        routed,
        {
            "new_rows_processed": F.count(F.lit(1)),
            "provided_label_rows": F.count_if(F.col("route") == "provided"),
            "rule_filtered_rows": F.count_if(F.col("route") == "rules"),
            "gpt_candidate_rows": F.count_if(F.col("route") == "batch"),
            "rows_sent_to_gpt": F.lit(0) * F.count(F.lit(1)),
        },
    )
    return union_metrics(total, done, skipped_rows(total, routed))
