"""Routing of classification rows and the classification output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from talkloom.functions.text import blank_if_null, first_filled_stripped
from talkloom.operators.batches import answered_label, join_responses
from talkloom.operators.terms import TermMatcher, with_available_terms
from talkloom.schemas import (
    CLASSIFICATION_COLUMNS,
    GPT_ERROR_FALLBACK,
    INVALID_AI_ONLY,
    INVALID_HEALTH_ONLY,
    INVALID_NEITHER,
    PREFILTER_ONLY,
    PROVIDED_LABEL,
    ROW_ORD,
    RULES_TERMS_FILTER,
    VALID_AI_HEALTHCARE,
    WITH_AI_AND_HEALTH_TERMS,
    WITH_AI_TERM_ONLY,
    WITH_HEALTH_TERM_ONLY,
)


def provided_label(df: DataFrame, *names: str) -> Column:
    """First of the columns, where present, that is not blank once stripped."""
    present = [n for n in names if n in df.columns]
    return first_filled_stripped(*present) if present else F.lit("")


def rule_label(available: Column) -> Column:
    return (
        F.when(available == WITH_AI_TERM_ONLY, F.lit(INVALID_AI_ONLY))
        .when(available == WITH_HEALTH_TERM_ONLY, F.lit(INVALID_HEALTH_ONLY))
        .otherwise(F.lit(INVALID_NEITHER))
    )


def route_rows(rows: DataFrame, matcher: TermMatcher, prefilter_only: bool = False) -> DataFrame:
    """Add ``route`` (provided, rules, batch), ``available_terms`` and, where the route
    decides it, ``model_used`` and ``model_classification``.

    Rows with a provided label are never scanned for terms. In prefilter-only mode such a
    row gets the literal text ``provided_label`` as its label, and rows with both term
    groups count as valid.
    """
    labelled = rows.withColumn("_provided", provided_label(rows, "provided_classification_label", "classification_label"))
    given = F.col("_provided") != ""
    scanned = with_available_terms(labelled, matcher, only_if=~given)
    terms = F.when(given, F.lit(PROVIDED_LABEL)).otherwise(F.col("available_terms"))
    both = F.col("available_terms") == WITH_AI_AND_HEALTH_TERMS
    route = F.when(given, "provided").when(both, "batch").otherwise("rules")
    if prefilter_only:
        used = F.lit(PREFILTER_ONLY)
        label = F.when(given, F.lit(PROVIDED_LABEL)).when(both, F.lit(VALID_AI_HEALTHCARE))
    else:
        used = F.when(given, F.lit(PROVIDED_LABEL)).when(~both, F.lit(RULES_TERMS_FILTER))
        label = F.when(given, F.col("_provided")).when(both, F.lit(None))
    return scanned.select(
        *[c for c in scanned.columns if c not in ("_provided", "available_terms")],
        route.alias("route"),
        terms.alias("available_terms"),
        used.alias("model_used"),
        label.otherwise(rule_label(F.col("available_terms"))).alias("model_classification"),
    )


def classification_output(rows: DataFrame, run_ts: str) -> DataFrame:
    """The twelve output columns, plus the order and key columns where present."""
    stamped = rows.withColumn("classified_at_utc", F.lit(run_ts))
    extra = [c for c in (ROW_ORD, "record_key", "route") if c in rows.columns]
    present = set(stamped.columns)
    return stamped.select(
        *[(blank_if_null(c) if c in present else F.lit("")).alias(c) for c in CLASSIFICATION_COLUMNS], *extra
    )


def decided_rows(routed: DataFrame, run_ts: str) -> DataFrame:
    """Output of the provided and rule routes (all rows in prefilter-only mode)."""
    return classification_output(routed.filter("model_classification is not null"), run_ts)


def label_candidates(candidates: DataFrame, responses: DataFrame, model: str, run_ts: str) -> DataFrame:
    """Output of the batch route for candidates whose batch was answered."""
    joined = join_responses(candidates, responses)
    labelled = joined.withColumns(
        {
            "model_used": F.when(F.col("failed"), F.lit(GPT_ERROR_FALLBACK)).otherwise(F.lit(model)),
            "model_classification": answered_label(F.col("answer"), F.col("failed")),
        }
    )
    return classification_output(labelled, run_ts)


def valid_only(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("model_classification") == VALID_AI_HEALTHCARE)
