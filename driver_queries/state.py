"""Sinks, incremental runs and streams, through tables written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.classify import MODEL, PREFILTER
from driver_queries.registry import FLAGGED, LEXICON_A, LEXICON_B, ROUTED, RUN_TS, query, scratch, std, table, with_std
from talkloom.functions.keys import row_key
from talkloom.operators.dedup import first_wins, skip_seen
from talkloom.operators.routing import decided_rows, route_rows
from talkloom.operators.terms import TermMatcher
from talkloom.plans.classification import SINK, collect_classification, label_queue, run_classification, select_new
from talkloom.plans.extraction import conform_extraction, run_extraction
from talkloom.plans.preprocessing import run_preprocessing
from talkloom.plans.store import Store, append_table, commit_stage, export_csv, read_master, read_state, stage_schema, write_snapshot, write_table
from talkloom.schemas import CLASSIFICATION, EXTRACTION, REQUEST, STANDARDIZED, text_schema
from talkloom.sources.tables import read_table, read_values, seen_keys
from talkloom.streaming.runner import read_landing, stream_classification, stream_preprocessing
from talkloom.streaming.seen_state import keyed_first_wins

_STATE_COLUMNS = "stage, record_key, platform, id, associated_id, processed_at_utc"


def landing_rows(spark, sf):
    """Documents as landed posts: (labelled ones, all of them)."""
    rows = std(spark, sf).withColumn("comments_json", F.lit("")).withColumnRenamed("source_url", "url")
    wide = conform_extraction(rows.drop("category", "associated_id")).select(*EXTRACTION.fieldNames(), "row_ord", "quality")
    return wide.filter("quality >= 0").drop("quality"), wide.drop("quality")


# Blank documents are not rows.
_LANDED = with_std("SELECT id, platform, category, text, collection_method FROM std WHERE text <> ''")


@query("q_incremental", _LANDED)
def incremental(spark, sf):
    """Two batch runs, the second landing holding the first one again."""
    store = Store(scratch(spark))
    early, late = landing_rows(spark, sf)
    run_preprocessing(spark, store, "run-1", RUN_TS, source=early, summarize=False)
    run_preprocessing(spark, store, "run-2", RUN_TS, source=late, summarize=False)
    return read_master(spark, store, "standardized", STANDARDIZED).select("id", "platform", "category", "text", "collection_method")


@query("q_stream_dedup", _LANDED)
def streamed(spark, sf):
    """The same landings as files of a stream."""
    folder = scratch(spark)
    store = Store(f"{folder}/store")
    early, late = landing_rows(spark, sf)
    for rows in (early, late):
        rows.select(*EXTRACTION.fieldNames()).write.mode("append").parquet(f"{folder}/landing")
    landing = read_landing(spark, f"{folder}/landing", files_per_batch=4)
    stream_preprocessing(spark, store, "stream", RUN_TS, landing, f"{folder}/checkpoint").awaitTermination()
    return read_master(spark, store, "standardized", STANDARDIZED).select("id", "platform", "category", "text", "collection_method")


@query("q_stream_keyed", with_std("SELECT id, CASE WHEN quality >= 0 THEN text ELSE text || ' copy' END AS text FROM std"))
def streamed_keyed(spark, sf):
    """Two landings with differing copies through a stream that keeps its seen-set as state: the first copy wins."""
    folder = scratch(spark)
    rows = std(spark, sf)
    for copy, part in enumerate((rows.filter("quality >= 0"), rows.withColumn("text", F.concat("text", F.lit(" copy"))))):
        part.select("id", "text", F.array(F.lit(copy).cast("bigint"), "doc_id").alias("row_ord")).write.mode("append").parquet(f"{folder}/landing")
    schema = "id string, text string, row_ord array<long>"
    landing = read_landing(spark, f"{folder}/landing", schema=schema, files_per_batch=8)
    first = keyed_first_wins(landing, F.col("id"), "row_ord")
    sink = first.writeStream.format("parquet").option("path", f"{folder}/first").option("checkpointLocation", f"{folder}/checkpoint")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/first").select("id", "text")


@query(
    "q_stream_classify",
    with_std("SELECT id, available_terms, model_used, model_classification FROM output", FLAGGED, ROUTED, PREFILTER),
)
def stream_classified(spark, sf):
    """Standardized rows as files of a stream, the second landing holding the first one again."""
    folder = scratch(spark)
    store = Store(f"{folder}/store")
    rows = std(spark, sf)
    for part in (rows.filter("quality >= 0"), rows):
        part.select(*STANDARDIZED.fieldNames(), "row_ord", "run_id").write.mode("append").parquet(f"{folder}/landing")
    landing = read_landing(spark, f"{folder}/landing", schema=stage_schema(STANDARDIZED), files_per_batch=8)
    matcher = TermMatcher.build(LEXICON_A, LEXICON_B)
    stream_classification(spark, store, "stream", RUN_TS, matcher, MODEL, landing, f"{folder}/checkpoint", prefilter_only=True).awaitTermination()
    return read_master(spark, store, "classification_all", CLASSIFICATION).select("id", "available_terms", "model_used", "model_classification")


def says(label):
    """A labeller that gives every row of a request one label."""

    def answer(requests):
        rows = F.from_json(F.substring_index("prompt", "Rows:\n", -1), "array<struct<row_id:string>>")
        results = F.transform(rows, lambda r: F.struct(r["row_id"].alias("row_id"), F.lit(label).alias("model_classification")))
        return requests.select("batch_id", F.lit("ok").alias("status"), F.to_json(F.struct(results.alias("results"))).alias("body"))

    return answer


@query(
    "q_force_pending",
    with_std(
        "SELECT id, label AS model_classification FROM routed, (VALUES ('unsure'), ('invalid_confusing_or_insufficient')) v(label) WHERE route = 'batch'",
        FLAGGED,
        ROUTED,
    ),
)
def force_pending(spark, sf):
    """All rows labelled, then asked for again by a forced run without a labeller, whose answers come later."""
    store = Store(scratch(spark))
    rows, matcher = std(spark, sf), TermMatcher.build(LEXICON_A, LEXICON_B)
    run_classification(spark, store, "one", RUN_TS, matcher, MODEL, rows, labeller=says("unsure"))
    run_classification(spark, store, "two", RUN_TS, matcher, MODEL, rows, force=True)
    waiting = read_table(spark, label_queue(spark, store).path("prompts", "two"), REQUEST)
    answers = says("invalid_confusing_or_insufficient")(waiting)
    for run in ("three", "four"):  # the second time, nothing waits any more
        collect_classification(spark, store, run, RUN_TS, MODEL, answers)
    return read_master(spark, store, "classification_all", CLASSIFICATION).filter(F.col("model_used") == MODEL).select("id", "model_classification")


@query(
    "q_replay_valid_only",
    with_std(
        "SELECT o.id, o.platform, o.model_classification, CASE WHEN s.quality >= 0 THEN 'lost' ELSE 'next' END AS run_id "
        "FROM output o JOIN std s USING (id) WHERE o.model_classification = 'valid_ai_healthcare'",
        FLAGGED,
        ROUTED,
        PREFILTER,
    ),
)
def replayed(spark, sf):
    """A run whose driver is lost after the snapshot; the next one carries it to its end and adds the rest."""
    store = Store(scratch(spark))
    rows, matcher = std(spark, sf), TermMatcher.build(LEXICON_A, LEXICON_B)
    early = decided_rows(route_rows(select_new(rows.filter("quality >= 0"), None), matcher, True), RUN_TS)
    write_snapshot(early, store, SINK, "lost", RUN_TS)
    run_classification(spark, store, "next", RUN_TS, matcher, MODEL, rows, prefilter_only=True)
    return read_master(spark, store, "classification_valid_only", CLASSIFICATION).select("id", "platform", "model_classification", "run_id")


@query(
    "q_schema_migration",
    with_std("SELECT id, text, CASE WHEN quality >= 0 THEN '' ELSE provided_language_label || 'new' END AS label FROM std"),
)
def migrated(spark, sf):
    path = scratch(spark)
    rows = std(spark, sf)
    old = rows.filter("quality >= 0").select(F.lit("x").alias("dropped"), "text", "id")
    new = rows.filter("quality < 0").select("id", "text", F.concat("provided_language_label", F.lit("new")).alias("label"))
    append_table(old, path)
    append_table(new, path)
    return read_table(spark, path, text_schema(("id", "text", "label")))


@query(
    "q_state_roundtrip",
    with_std(
        f"SELECT 'preprocessing' AS stage, record_key, platform, id, associated_id, '{RUN_TS}' AS processed_at_utc FROM keyed"
    ),
)
def roundtrip(spark, sf):
    """Two commits that overlap; the state ends with every key once."""
    store = Store(scratch(spark))
    rows = std(spark, sf).withColumn("record_key", row_key())
    for number, part in enumerate((rows.filter("quality >= 0"), rows)):
        seen = seen_keys(read_master(spark, store, "standardized", STANDARDIZED), read_state(spark, store, "preprocessing"))
        fresh = skip_seen(first_wins(part, "record_key", ["row_ord"]), seen)
        commit_stage(fresh, store, "preprocessing", "standardized", STANDARDIZED, f"run-{number}", RUN_TS)
    return read_state(spark, store, "preprocessing")


@query("q_csv_roundtrip", "SELECT CAST(doc_id AS VARCHAR) AS id, text, '' AS category FROM documents")
def csv_roundtrip(spark, sf):
    """Raw documents through a CSV table: line breaks, quotes and outer blanks survive."""
    path = scratch(spark)
    rows = table(spark, sf, "documents").select("text", F.col("doc_id").cast("string").alias("id"))
    export_csv(rows, path, ["text", "id"])
    return read_table(spark, path, STANDARDIZED, "csv").select("id", "text", "category")


@query(
    "q_overwrite_conform",
    with_std("SELECT id, text, '' AS source_url, '' AS missing FROM std"),
)
def overwritten(spark, sf):
    """The second write replaces the first; extras are ignored, missing columns are blank."""
    path = scratch(spark)
    rows = std(spark, sf)
    write_table(rows.limit(1), path, ["id"])
    write_table(rows, path, ["id", "text", "source_url", "missing"])
    return spark.read.parquet(path)


@query(
    "q_platform_split",
    with_std(
        """SELECT coalesce(nullif(CASE WHEN quality = 1 THEN '' ELSE platform END, ''), 'unknown') AS part, count(*) AS n_rows
        FROM std GROUP BY 1"""
    ),
)
def split(spark, sf):
    """The extraction snapshot has a folder per platform; blank platforms go to ``unknown``."""
    store = Store(scratch(spark))
    rows = std(spark, sf).withColumn("platform", F.when(F.col("quality") == 1, "").otherwise(F.col("platform")))
    landed = rows.select("platform", "collection_method", "id", "text", "row_ord")
    run_extraction(spark, store, "run", RUN_TS, landed)
    snapshot = spark.read.parquet(store.snapshot("extraction", "run", "extraction_raw"))
    return snapshot.groupBy(F.col("platform_part").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "q_summary_sink",
    with_std(
        """SELECT 'extraction' AS stage, 'run' AS run_id, 'platform_distribution' AS metric, platform AS key, count(*) AS value FROM std GROUP BY platform
        UNION ALL SELECT 'extraction', 'run', 'output_rows', '', count(*) FROM std"""
    ),
)
def summaries(spark, sf):
    store = Store(scratch(spark))
    landed = std(spark, sf).select("platform", "collection_method", "id", "text", "row_ord")
    run_extraction(spark, store, "run", RUN_TS, landed)
    lines = spark.read.schema("stage string, run_id string, metric string, key string, value bigint").json(
        store.snapshot("extraction", "run", "summary")
    )
    return lines.filter(F.col("metric").isin("platform_distribution", "output_rows"))


@query(
    "q_input_list",
    "SELECT trim(p_name) AS value, p_partkey AS pos FROM part WHERE p_brand <> 'Brand#1'",
)
def values(spark, sf):
    """A list with blanks, padding and repeats."""
    padded = F.when(F.col("p_brand") == "Brand#1", " \t").otherwise(F.concat(F.lit(" "), "p_name", F.lit("\n")))
    df = table(spark, sf, "part").select(padded.alias("keyword"), "p_partkey")
    return read_values(df, "keyword", ["p_partkey"]).select("value", F.element_at("pos", 1).alias("pos"))
