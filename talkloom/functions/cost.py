"""Token usage and cost columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from talkloom.functions.jsontext import parse_json

# --- fixed values: names of usage sources ---
API_USAGE = "openai_api_usage"
ESTIMATED_USAGE = "estimated_tokenizer"
MIXED_USAGE = "mixed"
# --- end of fixed values ---

CHARS_PER_TOKEN = 4


def estimated_tokens(text: Column | str) -> Column:
    size = F.char_length(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    return F.when(size > 0, F.greatest(F.floor(size / CHARS_PER_TOKEN), F.lit(1))).otherwise(F.lit(0)).cast("bigint")


def uncached_tokens(input_tokens: Column, cached: Column) -> Column:
    return F.greatest(input_tokens - cached, F.lit(0))


def usage_fields(payload: Column | str) -> dict[str, Column]:
    """Token counts of an API answer in either naming; a missing count is 0.

    A field that is present but null counts as 0, it does not fall through to its
    alias.
    """
    answer = parse_json(payload)
    usage = F.coalesce(F.try_variant_get(answer, "$.usage", "variant"), answer)

    def pick(*paths: str) -> Column:
        found = F.coalesce(*[F.try_variant_get(usage, p, "variant") for p in paths])
        return F.coalesce(F.try_variant_get(found, "$", "bigint"), F.lit(0).cast("bigint"))

    details = F.coalesce(
        F.try_variant_get(usage, "$.input_tokens_details", "variant"),
        F.try_variant_get(usage, "$.prompt_tokens_details", "variant"),
    )
    cached = F.coalesce(F.try_variant_get(details, "$.cached_tokens", "bigint"), F.lit(0).cast("bigint"))
    return {
        "input_tokens": pick("$.input_tokens", "$.prompt_tokens"),
        "cached_input_tokens": cached,
        "output_tokens": pick("$.output_tokens", "$.completion_tokens"),
    }


def part_cost(tokens: Column, price_per_million: Column) -> Column:
    return tokens.cast("double") / F.lit(1000000.0) * price_per_million
