"""Valid rows to language rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from talkloom.functions.jsontext import json_string_list
from talkloom.functions.text import blank_if_null, clean_text
from talkloom.operators.batches import (
    LANGUAGE_ANSWER,
    LANGUAGE_INSTRUCTIONS,
    answered_languages,
    failed_rows,
    join_responses,
    response_usage,
)
from talkloom.operators.langid import LanguageSettings, decide, early_reason, goes_to_batch
from talkloom.operators.routing import provided_label
from talkloom.operators.summaries import counts, distributions, platform_count, price_usage, sum_usage, union_metrics
from talkloom.plans.classification import VALID_TABLE, select_new, skipped_rows, stage_input
from talkloom.plans.labelling import Labeller, LabelQueue
from talkloom.plans.store import (
    Sink,
    Store,
    commit_rows,
    mark_consumed,
    quarantine,
    read_master,
    read_state,
    recover,
    write_summary,
)
from talkloom.schemas import (
    CLASSIFICATION,
    GPT_ERROR_FALLBACK,
    LANGUAGE,
    LANGUAGE_COLUMNS,
    PROVIDED_LABEL,
    ROW_ORD,
)
from talkloom.session import prepare_session, settle
from talkloom.sources.tables import read_table, seen_keys

STAGE = "language_detection"
TABLE = "language_detection"
SINK = Sink(STAGE, TABLE, LANGUAGE)
BATCH_SIZE = 20
SCORER_NAME = "fasttext"

Scorer = Callable[[DataFrame], DataFrame]

_PASSED = LANGUAGE_COLUMNS[:7]
_ROUTED = T.StructType(
    LANGUAGE.fields[:7]
    + [
        T.StructField("languages", T.ArrayType(T.StringType())),
        T.StructField("language_label", T.StringType()),
        T.StructField("detector", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField(ROW_ORD, T.ArrayType(T.LongType())),
        T.StructField("record_key", T.StringType()),
        T.StructField("route", T.StringType()),
    ]
)
_CANDIDATE = T.StructType(
    LANGUAGE.fields[:7]
    + [T.StructField(ROW_ORD, T.ArrayType(T.LongType())), T.StructField("record_key", T.StringType())]
    + [T.StructField("row_id", T.StringType()), T.StructField("batch_id", T.StringType())]
    + [T.StructField("ord", T.IntegerType()), T.StructField("forced", T.StringType())]
)


def route_languages(
    rows: DataFrame, scorer: Scorer | None, settings: LanguageSettings, scores: DataFrame | None = None
) -> DataFrame:
    """Add ``route`` (provided, scorer, batch), ``languages``, ``language_label`` and
    ``detector``. ``rows`` carries ``record_key``.

    Only rows that need a score reach the scorer. A fallback whose reason may not be
    sent on ends as out of scope under the scorer's name.
    """
    given = provided_label(rows, "provided_language_label", "language_label")
    tagged = rows.drop("language_label").withColumn("_provided", given).withColumn("row_key", F.col("record_key"))
    open_rows = tagged.filter("_provided = ''")
    if scores is None and scorer is not None:
        early = open_rows.withColumn("_clean", clean_text("text")).withColumn("_early", early_reason(F.col("_clean"), settings))
        scores = scorer(early.filter("_early is null").select("row_key", "text"))
    judged = decide(open_rows, scores, settings)
    batch = F.col("reason").isNotNull() & goes_to_batch(F.col("reason"), settings)
    judged = judged.withColumn("route", F.when(batch, F.lit("batch")).otherwise(F.lit("scorer"))).withColumn(
        "detector", F.lit(SCORER_NAME)
    )
    labelled = tagged.filter("_provided <> ''").withColumns(
        {
            "reason": F.lit(None).cast("string"),
            "languages": F.array(F.col("_provided")),
            "language_label": F.col("_provided"),
            "confidence": F.lit(0.0),
            "route": F.lit("provided"),
            "detector": F.lit(PROVIDED_LABEL),
        }
    )
    return labelled.unionByName(judged).drop("_provided", "row_key")


def language_output(rows: DataFrame, run_ts: str) -> DataFrame:
    """The eleven output columns; the language list as JSON text."""
    present = set(rows.columns)
    return rows.select(
        *[(blank_if_null(c) if c in present else F.lit("")).alias(c) for c in _PASSED],
        json_string_list(F.col("languages")).alias("language_detected"),
        "language_label",
        F.lit(run_ts).alias("language_detected_at_utc"),
        F.col("detector").alias("model_classification"),
        *[c for c in (ROW_ORD, "record_key", "route") if c in present],
    )


def answer_candidates(
    candidates: DataFrame, responses: DataFrame, model: str, run_ts: str, settings: LanguageSettings
) -> DataFrame:
    """Output of the batch route for candidates whose batch was answered."""
    joined = join_responses(candidates, responses)
    languages, label = answered_languages(
        F.col("answer"), F.col("failed"), settings.supported, settings.order, settings.max_languages
    )
    answered = joined.withColumns(
        {
            "languages": languages,
            "language_label": label,
            "detector": F.when(F.col("failed"), F.lit(GPT_ERROR_FALLBACK)).otherwise(F.lit(model)),
        }
    )
    return language_output(answered, run_ts)


def label_queue(spark: SparkSession, store: Store) -> LabelQueue:
    return LabelQueue(spark, store, STAGE, _CANDIDATE, LANGUAGE_INSTRUCTIONS, LANGUAGE_ANSWER)


def committed_keys(spark: SparkSession, store: Store) -> DataFrame:
    return seen_keys(read_master(spark, store, TABLE, LANGUAGE), read_state(spark, store, STAGE))


def run_language(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    model: str,
    source: DataFrame | None = None,
    scorer: Scorer | None = None,
    labeller: Labeller | None = None,
    settings: LanguageSettings | None = None,
    batch_size: int = BATCH_SIZE,
    force: bool = False,
    limit: int | None = None,
    prices: DataFrame | None = None,
) -> DataFrame:
    """Detect the languages of valid rows; returns the summary rows.

    Without ``scorer`` every undecided row counts as unscored and goes to the labeller.
    Without ``labeller`` batch rows wait for a run that has one or for ``collect_language``.
    """
    prepare_session(spark)
    recover(spark, store, SINK)
    settings = settings or LanguageSettings()
    master = read_master(spark, store, VALID_TABLE, CLASSIFICATION)
    rows, unread, sizes = stage_input(spark, store, STAGE, master, source, limit, force)
    queue = label_queue(spark, store)
    seen = None if force else committed_keys(spark, store).unionByName(queue.candidates().select("record_key"))
    # Three branches read the selection: provided labels, the scorer and the ladder.
    routed = route_languages(settle(select_new(unread, seen)), scorer, settings)
    work = store.snapshot(STAGE, run_id, "routed")
    routed.select(*_ROUTED.fieldNames()).write.mode("overwrite").partitionBy("route").parquet(work)
    routed = read_table(spark, work, _ROUTED)
    own = queue.put(routed.filter("route = 'batch'"), run_id, batch_size, force)
    columns = [*LANGUAGE_COLUMNS, ROW_ORD]
    outputs = language_output(routed.filter("route <> 'batch'"), run_ts).select(*columns)
    sent = None
    if labeller is not None:
        sent = own if force else queue.waiting(committed_keys(spark, store))
        usage = response_usage(queue.ask(sent, labeller, run_id), model)
        responses = queue.responses(sent)
        queue.settle(sent, responses, run_id)
        outputs = outputs.unionByName(answer_candidates(sent, responses, model, run_ts, settings).select(*columns))
        quarantine(failed_rows(join_responses(sent, responses), STAGE, run_ts), store)
        if prices is not None:
            write_summary(price_usage(sum_usage(usage), prices), store, STAGE, run_id, "cost")
    written = commit_rows(outputs, store, SINK, run_id, run_ts)
    if sizes is not None:
        mark_consumed(sizes, store, STAGE)
    return write_summary(language_summary(rows, routed, written, sent), store, STAGE, run_id)


def collect_language(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    model: str,
    responses: DataFrame,
    settings: LanguageSettings | None = None,
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
    answered = answer_candidates(waiting, answers, model, run_ts, settings or LanguageSettings())
    written = commit_rows(answered, store, SINK, run_id, run_ts)
    if prices is not None:
        write_summary(price_usage(sum_usage(response_usage(new, model)), prices), store, STAGE, run_id, "cost")
    write_summary(language_summary(waiting, waiting, written, queue.answered(waiting, answers)), store, STAGE, run_id)
    return written


def language_summary(
    rows: DataFrame, selected: DataFrame, outputs: DataFrame, sent: DataFrame | None = None
) -> DataFrame:
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
            "language_label_distribution": "language_label",
            "detector_distribution": "model_classification",
        },
    )
    return union_metrics(*parts, spread)
