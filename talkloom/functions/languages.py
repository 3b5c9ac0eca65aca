"""Language lists and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from talkloom.schemas import OUT_OF_SCOPE

# --- fixed values: languages, codes, cues and thresholds of the language stage ---
SUPPORTED_LANGUAGES = ("english", "tagalog", "cebuano", "ilocano", "hiligaynon")
LANGUAGE_ORDER = ("english", "tagalog", "cebuano", "ilocano", "hiligaynon")
LABEL_MAP = {"en": "english", "tl": "tagalog", "ceb": "cebuano", "ilo": "ilocano"}
HILIGAYNON_CUES = ("gid", "indi", "sang", "sa akon", "nga", "subong")
CONFIDENCE_THRESHOLD = 0.75
MIXED_CONFIDENCE_THRESHOLD = 0.30
TOP_K = 3
MIN_CHARS = 12
MAX_LANGUAGES_PER_ROW = 3
BATCH_REASONS = ("possible_hiligaynon", "possible_mixed_language", "fasttext_model_unavailable")
# --- end of fixed values ---


def text_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def language_label(languages: Column, order: Sequence[str] = LANGUAGE_ORDER) -> Column:
    """One language, ``mixed_a_b[_c]`` in canonical order, or out of scope."""
    ordered = F.slice(F.filter(text_array(order), lambda name: F.array_contains(languages, name)), 1, 3)
    return (
        F.when(F.size(ordered) == 1, F.element_at(ordered, 1))
        .when(F.size(ordered) > 1, F.concat(F.lit("mixed_"), F.array_join(ordered, "_")))
        .otherwise(F.lit(OUT_OF_SCOPE))
    )
