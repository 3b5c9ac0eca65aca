"""Distributions, stage summaries, usage and cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from talkloom.functions.cost import API_USAGE, MIXED_USAGE, part_cost, uncached_tokens
from talkloom.functions.text import blank_if_null

SUMMARY_SCHEMA = "metric string, key string, value bigint"


def long_metrics(one_row: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns of a one-row frame as (metric, key, value) rows."""
    pairs = [F.struct(F.lit(n).alias("metric"), F.lit("").alias("key"), F.col(n).cast("bigint").alias("value")) for n in names]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def distributions(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Counts per value of several columns in one pass; blanks are dropped.

    ``fields`` maps the metric name to its column. Counting starts in the map tasks, so
    a value that holds most rows moves as one row per task.
    """
    pairs = [F.struct(F.lit(m).alias("metric"), blank_if_null(c).alias("key")) for m, c in fields.items()]
    return (
        df.select(F.explode(F.array(*pairs)).alias("d"))
        .select("d.*")
        .filter("key <> ''")
        .groupBy("metric", "key")
        .agg(F.count(F.lit(1)).alias("value"))
    )


def distribution(df: DataFrame, field: str) -> DataFrame:
    """(value, count), sorted by value, blanks dropped."""
    counts = distributions(df, {field: field})
    return counts.select(F.col("key").alias(field), F.col("value").alias("count")).orderBy(field)


def platform_count(column: Column | str = "platform") -> Column:
    """Distinct platforms; here blank counts as a value."""
    return F.count_distinct(blank_if_null(column))


def counts(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Aggregate measures as (metric, key, value) rows."""
    row = df.agg(*[c.cast("bigint").alias(n) for n, c in measures.items()])
    return long_metrics(row, list(measures))


def union_metrics(*parts: DataFrame) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def difference(metrics: DataFrame, name: str, minuend: str, subtrahend: str) -> DataFrame:
    """One more metric, ``minuend - subtrahend``, from counters that are already there."""
    signed = F.when(F.col("metric") == minuend, F.col("value")).when(F.col("metric") == subtrahend, -F.col("value"))
    return metrics.filter("key = ''").agg(F.coalesce(F.sum(signed), F.lit(0)).cast("bigint").alias(name)).transform(
        lambda row: long_metrics(row, [name])
    )


def sum_usage(usage: DataFrame, by: Sequence[str] = ("model",), start_source: str = API_USAGE) -> DataFrame:
    """Token sums per group. The sum starts from an empty API usage, so a group keeps its
    source only where every row has that one; otherwise it is mixed."""
    same = F.min("usage_source").eqNullSafe(F.lit(start_source)) & F.max("usage_source").eqNullSafe(F.lit(start_source))
    return usage.groupBy(*by).agg(
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("cached_input_tokens").alias("cached_input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.when(same, F.lit(start_source)).otherwise(F.lit(MIXED_USAGE)).alias("usage_source"),
    )


def price_usage(sums: DataFrame, prices: DataFrame, pricing_source: str = "prices") -> DataFrame:
    """Cost parts and total of summed usage; a model without a price is an error.

    ``prices(model, input, cached, output)`` is a price list, so the join is left to
    broadcast by its measured size. The total is rounded from the unrounded parts.
    """
    listed = prices.select(
        F.col("model").alias("_model"),
        F.col("input").alias("_input"),
        F.col("cached").alias("_cached"),
        F.col("output").alias("_output"),
    )
    joined = sums.join(listed, F.col("model") == F.col("_model"), "left")
    missing = F.raise_error(F.concat(F.lit("no price for model: "), F.col("model"))).cast("double")

    def price(column: str) -> Column:
        return F.coalesce(F.col(column), missing)

    uncached = uncached_tokens(F.col("input_tokens"), F.col("cached_input_tokens"))
    parts = joined.select(
        F.col("model").alias("model_used"),
        "input_tokens",
        "cached_input_tokens",
        uncached.alias("uncached_input_tokens"),
        "output_tokens",
        (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
        part_cost(uncached, price("_input")).alias("_input_cost"),
        part_cost(F.col("cached_input_tokens"), price("_cached")).alias("_cached_cost"),
        part_cost(F.col("output_tokens"), price("_output")).alias("_output_cost"),
        "usage_source",
    )
    return parts.select(
        "model_used",
        "input_tokens",
        "cached_input_tokens",
        "uncached_input_tokens",
        "output_tokens",
        "total_tokens",
        F.round("_input_cost", 10).alias("input_cost_usd"),
        F.round("_cached_cost", 10).alias("cached_input_cost_usd"),
        F.round("_output_cost", 10).alias("output_cost_usd"),
        F.round(F.col("_input_cost") + F.col("_cached_cost") + F.col("_output_cost"), 10).alias("estimated_cost_usd"),
        F.lit(pricing_source).alias("pricing_source"),
        "usage_source",
    )


def summary_document(metrics: DataFrame, max_keys: int = 10_000) -> DataFrame:
    """The summary as one row: plain counters as columns of a map, distributions as maps.

    Meant for summaries a person reads. Provided labels are free text, so the number of
    distinct keys is checked first; the long form has no such bound.
    """
    if metrics.limit(max_keys + 1).count() > max_keys:
        raise ValueError(f"summary has more than {max_keys} rows; keep its long form")
    per_metric = metrics.groupBy("metric").agg(
        F.max(F.when(F.col("key") == "", F.col("value"))).alias("count"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("key") != "", F.struct("key", "value"))))).alias("distribution"),
    )
    return per_metric.agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(F.col("count").isNotNull(), F.struct("metric", "count"))))
        ).alias("counters"),
        F.map_from_entries(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.when(F.size("distribution") > 0, F.struct("metric", F.to_json("distribution").alias("d")))
                    )
                ),
                lambda e: e,
            )
        ).alias("distributions"),
    )
