"""Batch labelling through tables: requests go out, responses come back.

A request row carries the text of one batch; a response row carries ``batch_id``,
``status`` (``ok`` or anything else for a failed call), the answer ``body`` and the
``usage`` of the call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from talkloom.functions.cost import API_USAGE, ESTIMATED_USAGE, estimated_tokens, usage_fields
from talkloom.functions.jsontext import is_object, json_array, json_list, json_object, json_string, parse_json
from talkloom.functions.languages import (
    LANGUAGE_ORDER,
    MAX_LANGUAGES_PER_ROW,
    SUPPORTED_LANGUAGES,
    language_label,
    text_array,
)
from talkloom.functions.text import blank_if_null
from talkloom.schemas import (
    INVALID_CONFUSING_OR_INSUFFICIENT,
    LABELS,
    OUT_OF_SCOPE,
    QUARANTINE_COLUMNS,
)

CLASSIFICATION_INSTRUCTIONS = (
    "Label each text on its own, without guessing at a parent post, thread, link or author.\n"
    "A text is valid_ai_healthcare when it connects AI or related technology with health or care, "
    "however briefly or informally.\n"
    "Use invalid_ai_only for technology without health, invalid_health_only for health without "
    "technology and invalid_neither for neither.\n"
    "Use invalid_confusing_or_insufficient when only missing context could decide, and unsure when a "
    "complete text stays ambiguous."
)
LANGUAGE_INSTRUCTIONS = (
    "Name the languages visible in each text on its own: " + ", ".join(LANGUAGE_ORDER) + ".\n"
    f"Give at most {MAX_LANGUAGES_PER_ROW}, in that order. Use out_of_scope when no listed language is visible."
)
CLASSIFICATION_ANSWER = (
    'Answer in JSON: {"results": [{"row_id": "...", "model_classification": "'
    + " | ".join(LABELS)
    + '", "reason": "..."}]} with one result for every row_id.'
)
LANGUAGE_ANSWER = (
    'Answer in JSON: {"results": [{"row_id": "...", "language_detected": ["..."], "language_label": "..."}]} '
    "with one result for every row_id."
)

UNPARSED = "UnparsedResponse"


def build_requests(
    candidates: DataFrame,
    instructions: str = CLASSIFICATION_INSTRUCTIONS,
    answer_format: str = CLASSIFICATION_ANSWER,
) -> DataFrame:
    """(batch_id, n_rows, prompt) from ``candidates(batch_id, ord, row_id, text)``.

    A group never holds more rows than the batch size they were assigned with.
    """
    item = json_object([("row_id", json_string("row_id")), ("text", json_string("text"))])
    grouped = candidates.select("batch_id", F.struct(F.col("ord"), item.alias("item")).alias("e")).groupBy("batch_id")
    head = F.lit(f"{instructions}\n\n{answer_format}\n\nRows:\n")
    ordered = F.transform(F.array_sort(F.collect_list("e")), lambda e: e["item"])
    return grouped.agg(F.count(F.lit(1)).alias("n_rows"), F.concat(head, json_array(ordered)).alias("prompt"))


def parse_responses(responses: DataFrame) -> DataFrame:
    """(batch_id, failed, results array<variant>, error_type, message), one row per batch.

    A call that reported failure, or whose answer is not a JSON object, failed as a
    whole. An object whose ``results`` is no list answered with nothing.
    """
    parsed = responses.select(
        "batch_id",
        "status",
        parse_json("body").alias("_answer"),
        *[
            (blank_if_null(c) if c in responses.columns else F.lit("")).alias(c)
            for c in ("error_type", "message")
        ],
    )
    usable = F.coalesce(is_object(F.col("_answer")), F.lit(False))
    answered = F.coalesce(F.col("status") == "ok", F.lit(False))
    results = F.filter(F.coalesce(json_list(F.col("_answer"), "$.results"), F.array().cast("array<variant>")), is_object)
    return parsed.select(
        "batch_id",
        (~(answered & usable)).alias("failed"),
        results.alias("results"),
        F.when(answered & ~usable, F.lit(UNPARSED)).otherwise(F.col("error_type")).alias("error_type"),
        F.when(answered & ~usable, F.lit("answer is not a JSON object")).otherwise(F.col("message")).alias("message"),
    )


def _answer_for(row_id: Column, results: Column) -> Column:
    """The last answer given for a row, NULL when there is none."""
    mine = F.filter(results, lambda x: F.try_variant_get(x, "$.row_id", "string") == row_id)
    return F.try_element_at(mine, F.lit(-1))


def one_response(parsed: DataFrame) -> DataFrame:
    """One response a batch: a good answer before a failed one; equal ones in a fixed order."""
    best = Window.partitionBy("batch_id").orderBy("failed", F.to_json("results"), "message")
    return parsed.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")


def join_responses(candidates: DataFrame, responses: DataFrame) -> DataFrame:
    """Candidates of answered batches with ``failed`` and their own ``answer``.

    Batches without a response stay pending: they appear in no output and are not
    recorded as seen. Results travel inside the one row of their batch, so there is
    one join on ``batch_id`` and no group larger than a batch.
    """
    parsed = one_response(parse_responses(responses))
    joined = candidates.join(parsed, "batch_id")
    return joined.withColumn("answer", _answer_for(F.col("row_id"), F.col("results"))).drop("results")


def answered_label(answer: Column, failed: Column) -> Column:
    """Label of an answer; unknown labels, missing rows and failed batches get the default."""
    default = F.lit(INVALID_CONFUSING_OR_INSUFFICIENT)
    label = F.try_variant_get(answer, "$.model_classification", "string")
    return F.when(~failed & label.isin(*LABELS), label).otherwise(default)


def answered_languages(
    answer: Column,
    failed: Column,
    supported: Sequence[str] = SUPPORTED_LANGUAGES,
    order: Sequence[str] = LANGUAGE_ORDER,
    max_languages: int = MAX_LANGUAGES_PER_ROW,
) -> tuple[Column, Column]:
    """(languages, label) of an answer: supported ones first, then the cap; an unsupported
    one makes the label out of scope and leaves the list."""
    nothing = F.array().cast("array<string>")
    named = F.transform(
        F.coalesce(json_list(answer, "$.language_detected"), F.array().cast("array<variant>")),
        lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("None")),
    )
    known = text_array(supported)
    languages = F.slice(F.filter(named, lambda x: F.array_contains(known, x)), 1, max_languages)
    languages = F.when(failed | answer.isNull(), nothing).otherwise(languages)
    foreign = F.exists(named, lambda x: ~F.array_contains(known, x))
    label = F.when(failed | answer.isNull() | foreign, F.lit(OUT_OF_SCOPE)).otherwise(language_label(languages, order))
    return languages, label


def failed_rows(joined: DataFrame, stage: str, failed_at_utc: str) -> DataFrame:
    """Quarantine rows: one per record of every failed batch."""
    return joined.filter("failed").select(
        F.lit(failed_at_utc).alias("failed_at_utc"),
        F.lit(stage).alias("stage"),
        "platform",
        "collection_method",
        F.col("id").alias("id_or_query"),
        "error_type",
        "message",
    ).select(*QUARANTINE_COLUMNS)


def response_usage(responses: DataFrame, model: str) -> DataFrame:
    """Token usage per answered batch; failed calls bring an empty usage."""
    fields = usage_fields("usage")
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    return responses.select(
        "batch_id",
        F.lit(model).alias("model"),
        *[F.when(ok, c).otherwise(F.lit(0)).cast("bigint").alias(n) for n, c in fields.items()],
        F.lit(API_USAGE).alias("usage_source"),
    )


def forecast_usage(requests: DataFrame, model: str, response_text: str = '{"model_classification": "..."}') -> DataFrame:
    """Estimated usage of requests that were not sent yet."""
    return requests.select(
        "batch_id",
        F.lit(model).alias("model"),
        estimated_tokens("prompt").alias("input_tokens"),
        F.lit(0).cast("bigint").alias("cached_input_tokens"),
        estimated_tokens(F.lit(response_text)).alias("output_tokens"),
        F.lit(ESTIMATED_USAGE).alias("usage_source"),
    )
