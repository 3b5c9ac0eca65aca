"""Token usage and cost over the event table, read as labeller calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, texts
from talkloom.functions.cost import usage_fields
from talkloom.operators.summaries import price_usage, sum_usage

_PRICES = (("click", 0.75, 0.075, 4.5), ("error", 1.0, 0.5, 2.0), ("purchase", 0.1, 0.01, 0.4), ("signup", 3.0, 0.3, 15.0), ("view", 0.0, 0.0, 0.0))
_PRICE_VALUES = ", ".join(f"('{m}', {i}::DOUBLE, {c}::DOUBLE, {o}::DOUBLE)" for m, i, c, o in _PRICES)


@query(
    "q_usage_cost",
    f"""WITH u AS (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
    s AS (SELECT event_type, CAST(sum(1000 + 10 * k) AS BIGINT) AS i, CAST(sum(5 * k) AS BIGINT) AS c, CAST(sum(k) AS BIGINT) AS o FROM u GROUP BY 1),
    p AS (SELECT * FROM (VALUES {_PRICE_VALUES}) v(model, pi, pc, po)),
    x AS (SELECT *, greatest(i - c, 0) / 1000000.0::DOUBLE * pi AS ci, c / 1000000.0::DOUBLE * pc AS cc, o / 1000000.0::DOUBLE * po AS co
      FROM s JOIN p ON model = event_type)
    SELECT event_type AS model_used, i AS input_tokens, c AS cached_input_tokens, greatest(i - c, 0) AS uncached_input_tokens,
      o AS output_tokens, i + o AS total_tokens, round(ci, 10) AS input_cost_usd, round(cc, 10) AS cached_input_cost_usd,
      round(co, 10) AS output_cost_usd, round(ci + cc + co, 10) AS estimated_cost_usd, 'prices' AS pricing_source,
      CASE event_type WHEN 'error' THEN 'mixed' ELSE 'openai_api_usage' END AS usage_source FROM x""",
)
def costs(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    payload = F.when(
        F.col("event_type") == "signup",
        F.to_json(
            F.struct(
                (1000 + 10 * k).alias("input_tokens"),
                k.alias("output_tokens"),
                F.struct((5 * k).alias("cached_tokens")).alias("input_tokens_details"),
            )
        ),
    ).otherwise(
        F.to_json(
            F.struct(
                F.struct(
                    (1000 + 10 * k).alias("prompt_tokens"),
                    k.alias("completion_tokens"),
                    F.struct((5 * k).alias("cached_tokens")).alias("prompt_tokens_details"),
                ).alias("usage")
            )
        )
    )
    calls = texts(spark, sf, "events", "event_type", "props").select(F.col("event_type").alias("model"), payload.alias("payload"))
    source = F.when((F.col("model") == "error"), "estimated_tokenizer").otherwise("openai_api_usage")
    usage = calls.select("model", *[c.alias(n) for n, c in usage_fields("payload").items()], source.alias("usage_source"))
    prices = spark.createDataFrame(list(_PRICES), "model string, input double, cached double, output double")
    return price_usage(sum_usage(usage), prices)
