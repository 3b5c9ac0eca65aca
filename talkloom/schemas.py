"""Table layouts and enumerations shared by the stages."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column layouts of the stage tables ---
EXTRACTION_COLUMNS = (
    "platform",
    "collection_method",
    "id",
    "text",
    "title",
    "author",
    "created_at_utc",
    "url",
    "comments_json",
    "metadata_json",
    "provided_language_label",
    "provided_classification_label",
    "extracted_at_utc",
)
STANDARDIZED_COLUMNS = (
    "platform",
    "collection_method",
    "id",
    "text",
    "category",
    "associated_id",
    "source_url",
    "provided_language_label",
    "provided_classification_label",
)
CLASSIFICATION_COLUMNS = (
    "platform",
    "collection_method",
    "id",
    "text",
    "category",
    "associated_id",
    "provided_language_label",
    "provided_classification_label",
    "available_terms",
    "classified_at_utc",
    "model_used",
    "model_classification",
)
# ``model_classification`` of this table holds the name of the detector.
LANGUAGE_COLUMNS = (
    "platform",
    "collection_method",
    "id",
    "text",
    "category",
    "associated_id",
    "provided_language_label",
    "language_detected",
    "language_label",
    "language_detected_at_utc",
    "model_classification",
)
STATE_COLUMNS = ("stage", "record_key", "platform", "id", "associated_id", "processed_at_utc")
QUARANTINE_COLUMNS = (
    "failed_at_utc",
    "stage",
    "platform",
    "collection_method",
    "id_or_query",
    "error_type",
    "message",
)

# --- fixed values: enumerations ---
WITH_AI_AND_HEALTH_TERMS = "with_ai_and_health_terms"
WITH_AI_TERM_ONLY = "with_ai_term_only"
WITH_HEALTH_TERM_ONLY = "with_health_term_only"
NO_VALID_TERMS = "no_valid_terms"

VALID_AI_HEALTHCARE = "valid_ai_healthcare"
INVALID_AI_ONLY = "invalid_ai_only"
INVALID_HEALTH_ONLY = "invalid_health_only"
INVALID_NEITHER = "invalid_neither"
INVALID_CONFUSING_OR_INSUFFICIENT = "invalid_confusing_or_insufficient"
UNSURE = "unsure"
LABELS = (
    VALID_AI_HEALTHCARE,
    INVALID_AI_ONLY,
    INVALID_HEALTH_ONLY,
    INVALID_NEITHER,
    INVALID_CONFUSING_OR_INSUFFICIENT,
    UNSURE,
)

PROVIDED_LABEL = "provided_label"
RULES_TERMS_FILTER = "rules_terms_filter"
PREFILTER_ONLY = "prefilter_only"
GPT_ERROR_FALLBACK = "gpt_error_fallback"
OUT_OF_SCOPE = "out_of_scope"

ROOT_CATEGORY = {"reddit": "post", "youtube": "video", "twitter": "post"}
# --- end of fixed values ---


def text_schema(columns) -> T.StructType:
    """All columns of a stage table are text at rest."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


EXTRACTION = text_schema(EXTRACTION_COLUMNS)
STANDARDIZED = text_schema(STANDARDIZED_COLUMNS)
CLASSIFICATION = text_schema(CLASSIFICATION_COLUMNS)
LANGUAGE = text_schema(LANGUAGE_COLUMNS)
STATE = text_schema(STATE_COLUMNS)
QUARANTINE = text_schema(QUARANTINE_COLUMNS)

JOB = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("collection_method", T.StringType()),
        T.StructField("ids", T.ArrayType(T.StringType())),
        T.StructField("subreddit", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("limit", T.IntegerType()),
        T.StructField("include_comments", T.BooleanType()),
        T.StructField("comment_limit", T.IntegerType()),
    ]
)
REQUEST = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("prompt", T.StringType()),
    ]
)
RESPONSE = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("usage", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

# Input order of a stage table, carried next to the text columns. Tables have no
# order of their own; first-wins, limits and numbering sort by this array.
ROW_ORD = "row_ord"
EMPTY_ORD = T.ArrayType(T.LongType())
