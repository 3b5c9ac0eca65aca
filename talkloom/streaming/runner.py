"""Stages as streams: each micro-batch runs the batch stage on its own rows.

The seen-tables carry the state, so it survives restarts, never expires and is shared
with batch runs. A micro-batch commits under a run id fixed by its number. One that is replayed after a
crash consults the markers of that commit (``plans.commits``): committed as a whole, it does nothing; with a whole
snapshot, the missing steps are done from it; otherwise it runs anew. So snapshot, master and state are
each written once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from talkloom.functions.keys import row_key
from talkloom.operators.langid import LanguageSettings
from talkloom.operators.terms import TermMatcher
from talkloom.plans import classification, extraction, language, preprocessing
from talkloom.plans.labelling import Labeller
from talkloom.plans.store import Sink, Store, is_committed, ordered_source, recover
from talkloom.schemas import EXTRACTION
from talkloom.session import prepare_session

BatchStep = Callable[[DataFrame, str], object]


def read_landing(
    spark: SparkSession, folder: str, source: str = "parquet", schema=EXTRACTION, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over the files that arrive in a landing folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(source).load(folder)


def stream_stage(
    rows: DataFrame,
    step: BatchStep,
    run_id: str,
    checkpoint: str,
    available_now: bool = True,
    store: Store | None = None,
    sink: Sink | None = None,
) -> StreamingQuery:
    """Run ``step(batch_rows, batch_run_id)`` per micro-batch.

    The run id is fixed by the batch number. With ``store`` and ``sink``, a batch whose commit is whole, or can
    be made whole from its snapshot, is not run again.
    """

    def one(batch: DataFrame, number: int) -> None:
        batch_run = f"{run_id}-{number:06d}"
        if sink is not None:
            spark = rows.sparkSession
            recover(spark, store, sink)
            if is_committed(spark, store, sink.stage, batch_run):
                return
        step(batch, batch_run)

    writer = rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_extraction(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    landing: DataFrame,
    checkpoint: str,
    comments: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Commit landed rows as they arrive; the first landing of an id wins across batches."""
    prepare_session(spark)

    def step(batch: DataFrame, batch_run: str) -> None:
        extraction.run_extraction(spark, store, batch_run, run_ts, ordered_source(batch), comments)

    return stream_stage(landing, step, run_id, checkpoint, available_now, store, extraction.SINK)


def stream_preprocessing(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    landing: DataFrame,
    checkpoint: str,
    available_now: bool = True,
    summarize: bool = False,
) -> StreamingQuery:
    """Standardize landing files as they arrive."""
    prepare_session(spark)

    def step(batch: DataFrame, batch_run: str) -> None:
        preprocessing.run_preprocessing(spark, store, batch_run, run_ts, source=ordered_source(batch), summarize=summarize)

    return stream_stage(landing, step, run_id, checkpoint, available_now, store, preprocessing.SINK)


def stream_classification(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    matcher: TermMatcher,
    model: str,
    landing: DataFrame,
    checkpoint: str,
    labeller: Labeller | None = None,
    prefilter_only: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Route and label standardized rows as they arrive.

    ``landing`` is a stream of standardized rows, such as ``read_landing`` over the standardized master. Without
    a labeller, batch rows wait as in a batch run.
    """
    prepare_session(spark)

    def step(batch: DataFrame, batch_run: str) -> None:
        rows = ordered_source(batch)
        classification.run_classification(spark, store, batch_run, run_ts, matcher, model, rows, labeller=labeller, prefilter_only=prefilter_only)

    return stream_stage(landing, step, run_id, checkpoint, available_now, store, classification.SINK)


def stream_language(
    spark: SparkSession,
    store: Store,
    run_id: str,
    run_ts: str,
    model: str,
    landing: DataFrame,
    checkpoint: str,
    scorer: language.Scorer | None = None,
    labeller: Labeller | None = None,
    settings: LanguageSettings | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Detect the languages of classified rows as they arrive."""
    prepare_session(spark)

    def step(batch: DataFrame, batch_run: str) -> None:
        language.run_language(spark, store, batch_run, run_ts, model, ordered_source(batch), scorer, labeller, settings)

    return stream_stage(landing, step, run_id, checkpoint, available_now, store, language.SINK)


def bounded_first_wins(rows: DataFrame, event_time: str, watermark: str) -> DataFrame:
    """Variant with bounded state: repeats of a row key are dropped within the watermark.

    An extension for sources whose repeats arrive close together; the seen-tables of
    ``stream_preprocessing`` have no such limit.
    """
    keyed = rows.withColumn("record_key", row_key()).withWatermark(event_time, watermark)
    return keyed.dropDuplicatesWithinWatermark(["record_key"])
