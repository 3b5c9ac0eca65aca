"""Routing, batches, responses and classification outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import FLAGGED, LEXICON_A, LEXICON_B, ROUTED, RULE, RUN_TS, long_sql, query, std, with_std
from talkloom.operators.batches import (
    CLASSIFICATION_ANSWER,
    CLASSIFICATION_INSTRUCTIONS,
    build_requests,
    failed_rows,
    forecast_usage,
    join_responses,
    response_usage,
)
from talkloom.operators.numbering import assign_batches
from talkloom.operators.routing import decided_rows, label_candidates, route_rows, valid_only
from talkloom.operators.summaries import distribution, price_usage, sum_usage
from talkloom.operators.terms import TermMatcher
from talkloom.plans.classification import classification_summary, prefilter_summary, select_new
from talkloom.schemas import CLASSIFICATION_COLUMNS
from talkloom.session import settle

MODEL = "model-x"
BATCH = 5
_PASSED = ", ".join(CLASSIFICATION_COLUMNS[:8])
_ALL = ", ".join(CLASSIFICATION_COLUMNS)


def routed(spark, sf, prefilter_only=False):
    rows = select_new(std(spark, sf), None)
    return route_rows(rows, TermMatcher.build(LEXICON_A, LEXICON_B), prefilter_only)


def candidates(rows):
    """Rows of the batch route in their batches; ``rows`` are routed and written out."""
    batch = rows.filter("route = 'batch'").withColumn("row_id", F.col("record_key"))
    return settle(assign_batches(batch, "record_key", BATCH))


def batch_candidates(spark, sf):
    return candidates(settle(routed(spark, sf).filter("route = 'batch'")))


def synthetic_responses(rows):
    """One answer per batch: the label depends on the length of the text, short texts are
    left out, every third batch fails."""
    size = F.char_length("text")
    label = (
        F.when(size > 4000, "valid_ai_healthcare").when(size > 2500, "unsure").when(size > 1500, "made_up")
    )
    item = F.when(
        label.isNotNull(), F.struct("row_id", label.alias("model_classification"), F.lit("by length").alias("reason"))
    )
    grouped = rows.groupBy("batch_id").agg(F.collect_list(item).alias("results"), F.count(F.lit(1)).alias("n"))
    usage = F.struct(
        (F.col("n") * 1000).alias("prompt_tokens"),
        (F.col("n") * 10).alias("completion_tokens"),
        F.struct((F.col("n") * 100).alias("cached_tokens")).alias("prompt_tokens_details"),
    )
    failed = F.col("batch_id").cast("bigint") % 3 == 1
    return grouped.select(
        "batch_id",
        F.when(failed, "error").otherwise("ok").alias("status"),
        F.to_json(F.struct("results")).alias("body"),
        F.to_json(F.struct(usage.alias("usage"))).alias("usage"),
        F.when(failed, "Timeout").otherwise("").alias("error_type"),
        F.when(failed, "no answer").otherwise("").alias("message"),
    )


CANDIDATES = f"""cand AS (SELECT *, (row_number() OVER (ORDER BY md5(record_key), record_key) - 1) AS rn FROM routed WHERE route = 'batch'),
answered AS (SELECT *, rn // {BATCH} AS batch_no, (rn // {BATCH}) % 3 = 1 AS failed,
  CASE WHEN length(text) > 4000 THEN 'valid_ai_healthcare' WHEN length(text) > 2500 THEN 'unsure'
    ELSE 'invalid_confusing_or_insufficient' END AS answer FROM cand)"""
OUTPUT = f"""output AS (
  SELECT {_PASSED}, CASE route WHEN 'provided' THEN 'provided_label' ELSE terms END AS available_terms,
    '{RUN_TS}' AS classified_at_utc,
    CASE route WHEN 'provided' THEN 'provided_label' ELSE 'rules_terms_filter' END AS model_used,
    CASE route WHEN 'provided' THEN provided_classification_label ELSE {RULE} END AS model_classification
  FROM routed WHERE route <> 'batch'
  UNION ALL
  SELECT {_PASSED}, terms, '{RUN_TS}', CASE WHEN failed THEN 'gpt_error_fallback' ELSE '{MODEL}' END,
    CASE WHEN failed THEN 'invalid_confusing_or_insufficient' ELSE answer END FROM answered)"""
PREFILTER = f"""output AS (
  SELECT {_PASSED}, CASE route WHEN 'provided' THEN 'provided_label' ELSE terms END AS available_terms,
    '{RUN_TS}' AS classified_at_utc, 'prefilter_only' AS model_used,
    CASE route WHEN 'provided' THEN 'provided_label' WHEN 'batch' THEN 'valid_ai_healthcare' ELSE {RULE} END AS model_classification
  FROM routed)"""
FULL = (FLAGGED, ROUTED, CANDIDATES, OUTPUT)


def full_output(spark, sf):
    rows = settle(routed(spark, sf))  # one scan for terms serves both branches
    waiting = candidates(rows)
    answered = label_candidates(waiting, synthetic_responses(waiting), MODEL, RUN_TS)
    decided = decided_rows(rows, RUN_TS)
    return decided.select(*CLASSIFICATION_COLUMNS).unionByName(answered.select(*CLASSIFICATION_COLUMNS)), waiting


@query("q_classify_full", with_std("SELECT id, available_terms, model_used, model_classification FROM output", *FULL))
def classify_full(spark, sf):
    return full_output(spark, sf)[0].select("id", "available_terms", "model_used", "model_classification")


@query("q_outputs_schema", with_std(f"SELECT {_ALL} FROM output", *FULL))
def all_columns(spark, sf):
    return full_output(spark, sf)[0]


@query(
    "q_classify_prefilter_only",
    with_std("SELECT id, available_terms, model_used, model_classification FROM output", FLAGGED, ROUTED, PREFILTER),
)
def classify_prefilter(spark, sf):
    return decided_rows(routed(spark, sf, True), RUN_TS).select("id", "available_terms", "model_used", "model_classification")


@query(
    "q_valid_only",
    with_std(
        "SELECT id, platform, model_classification FROM output WHERE model_classification = 'valid_ai_healthcare'",
        FLAGGED,
        ROUTED,
        PREFILTER,
    ),
)
def valid(spark, sf):
    return valid_only(decided_rows(routed(spark, sf, True), RUN_TS)).select("id", "platform", "model_classification")


@query(
    "q_label_distribution",
    with_std('SELECT model_classification, count(*) AS "count" FROM output GROUP BY 1', FLAGGED, ROUTED, PREFILTER),
)
def labels(spark, sf):
    return distribution(decided_rows(routed(spark, sf, True), RUN_TS), "model_classification")


@query(
    "q_classification_summary",
    with_std(
        long_sql(
            "m",
            {
                "input_rows": "n",
                "new_rows_processed": "n",
                "num_platforms": "p",
                "skipped_existing_rows": "0",
                "rows_sent_to_gpt": "c",
            },
            {
                "platform_distribution": "platform",
                "collection_method_distribution": "collection_method",
                "available_terms_distribution": "available_terms",
                "model_classification_distribution": "model_classification",
            },
            "output",
        ),
        *FULL,
        "m AS (SELECT (SELECT count(*) FROM output) AS n, (SELECT count(DISTINCT platform) FROM output) AS p, (SELECT count(*) FROM cand) AS c)",
    ),
)
def summary(spark, sf):
    rows = std(spark, sf)
    output, sent = full_output(spark, sf)
    return classification_summary(rows, rows, output, sent)


@query(
    "q_prefilter_summary",
    with_std(
        long_sql(
            "m",
            {
                "input_rows": "n",
                "new_rows_processed": "n",
                "provided_label_rows": "p",
                "rule_filtered_rows": "r",
                "gpt_candidate_rows": "b",
                "rows_sent_to_gpt": "0",
                "skipped_existing_rows": "0",
            },
        ),
        FLAGGED,
        ROUTED,
        "m AS (SELECT count(*) AS n, count(*) FILTER (route = 'provided') AS p, count(*) FILTER (route = 'rules') AS r, count(*) FILTER (route = 'batch') AS b FROM routed)",
    ),
)
def summary_prefilter(spark, sf):
    return prefilter_summary(std(spark, sf), routed(spark, sf, True))


# ---- batches ---------------------------------------------------------------

_HEAD = f"{CLASSIFICATION_INSTRUCTIONS}\n\n{CLASSIFICATION_ANSWER}\n\nRows:\n".replace("'", "''")
PROMPTS = f"""prompts AS (SELECT lpad(CAST(batch_no AS VARCHAR), 12, '0') AS batch_id, count(*) AS n_rows, min(record_key) AS first_key,
  '{_HEAD}[' || string_agg('{{"row_id": ' || CAST(to_json(record_key) AS VARCHAR) || ', "text": ' || CAST(to_json(text) AS VARCHAR) || '}}', ', ' ORDER BY rn) || ']' AS prompt
  FROM answered GROUP BY batch_no)"""


@query(
    "q_batches",
    with_std(
        "SELECT batch_id, n_rows, first_key, md5(prompt) AS prompt_md5 FROM prompts", FLAGGED, ROUTED, CANDIDATES, PROMPTS
    ),
)
def batches(spark, sf):
    rows = batch_candidates(spark, sf)
    firsts = rows.groupBy("batch_id").agg(F.min("record_key").alias("first_key"))
    return build_requests(rows).join(firsts, "batch_id").select("batch_id", "n_rows", "first_key", F.md5("prompt").alias("prompt_md5"))


@query(
    "q_cost_forecast",
    with_std(
        "SELECT batch_id, greatest(length(prompt) // 4, 1) AS input_tokens, CAST(7 AS BIGINT) AS output_tokens FROM prompts",
        FLAGGED,
        ROUTED,
        CANDIDATES,
        PROMPTS,
    ),
)
def forecast(spark, sf):
    return forecast_usage(build_requests(batch_candidates(spark, sf)), MODEL).select("batch_id", "input_tokens", "output_tokens")


@query(
    "q_quarantine",
    with_std(
        f"""SELECT '{RUN_TS}' AS failed_at_utc, 'classification' AS stage, platform, collection_method, id AS id_or_query,
        'Timeout' AS error_type, 'no answer' AS message FROM answered WHERE failed""",
        FLAGGED,
        ROUTED,
        CANDIDATES,
    ),
)
def errors(spark, sf):
    rows = batch_candidates(spark, sf)
    return failed_rows(join_responses(rows, synthetic_responses(rows)), "classification", RUN_TS)


@query(
    "q_batch_costs",
    with_std(
        f"""SELECT '{MODEL}' AS model_used, CAST(n * 1000 AS BIGINT) AS input_tokens, CAST(n * 100 AS BIGINT) AS cached_input_tokens,
        CAST(n * 10 AS BIGINT) AS output_tokens, round(n * 900 / 1000000.0::DOUBLE * 0.75, 10) AS input_cost_usd,
        'openai_api_usage' AS usage_source FROM (SELECT count(*)::DOUBLE AS n FROM answered WHERE NOT failed)""",
        FLAGGED,
        ROUTED,
        CANDIDATES,
    ),
)
def batch_costs(spark, sf):
    usage = response_usage(synthetic_responses(batch_candidates(spark, sf)), MODEL)
    prices = spark.createDataFrame([(MODEL, 0.75, 0.075, 4.5)], "model string, input double, cached double, output double")
    return price_usage(sum_usage(usage), prices).select(
        "model_used", "input_tokens", "cached_input_tokens", "output_tokens", "input_cost_usd", "usage_source"
    )
