"""Collection jobs from input lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from talkloom.operators.numbering import number_rows
from talkloom.schemas import JOB

# --- fixed values: job defaults ---
DEFAULT_LIMIT = 100
DEFAULT_COMMENT_LIMIT = 500
DEFAULT_INCLUDE_COMMENTS = True
KEYWORD_PLATFORMS = ("reddit", "youtube", "twitter")
# --- end of fixed values ---

IDS_PER_ROW = 10_000
#: Values of either list in one cell of their product.
BLOCK = 1_000


def keyword_jobs(keywords: DataFrame) -> DataFrame:
    """Every keyword on every platform: the platforms are three literals, not a table."""
    platforms = F.array(*[F.lit(p) for p in KEYWORD_PLATFORMS])
    return keywords.select(F.explode(platforms).alias("platform"), F.col("value").alias("keyword"), F.col("pos").alias("_k")).select(
        "platform",
        F.lit("keyword").alias("collection_method"),
        "keyword",
        _ord(2, F.array().cast("array<bigint>"), F.col("_k")),
    )


def subreddit_jobs(subreddits: DataFrame, keywords: DataFrame, block: int = BLOCK) -> DataFrame:
    """One search per subreddit and keyword.

    Every pair is wanted, so the output is the product. Both lists are cut into blocks of about ``block`` values,
    as many as their counts ask for, and the product is formed as an equi-join on the grid of
    block x block: a cell holds one block of either list, and neither list is ever whole in one task.
    """
    rows, columns = (max(1, -(-values.count() // block)) for values in (subreddits, keywords))

    def cells(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def place(n: int):
        return F.pmod(F.xxhash64("pos"), F.lit(n)).cast("int")

    left = subreddits.select(F.col("value").alias("subreddit"), F.col("pos").alias("_s"), place(rows).alias("_i"), cells(columns).alias("_j"))
    right = keywords.select(F.col("value").alias("keyword"), F.col("pos").alias("_k"), cells(rows).alias("_i"), place(columns).alias("_j"))
    return left.join(right, ["_i", "_j"]).select(
        F.lit("reddit").alias("platform"),
        F.lit("subreddit_keyword").alias("collection_method"),
        "subreddit",
        "keyword",
        _ord(1, F.col("_s"), F.col("_k")),
    )


def targeted_jobs(ids: DataFrame, platform: str, ids_per_row: int = IDS_PER_ROW) -> DataFrame:
    """The id list of one platform as one job.

    A list of up to ``ids_per_row`` ids is one row. A longer one continues in further rows
    of the same job (``part`` counts them), so no row grows with the list.
    """
    ranked = number_rows(ids.withColumn("_key", F.array_join(F.col("pos").cast("array<string>"), ",")), "_key", "_n")
    small = ranked.withColumn("part", F.floor(F.col("_n") / ids_per_row))
    return (
        small.groupBy("part")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("_ids"))
        .select(
            F.lit(platform).alias("platform"),
            F.lit("targeted_id").alias("collection_method"),
            F.transform("_ids", lambda e: e["value"]).alias("ids"),
            "part",
            _ord(0, F.array(F.col("part").cast("bigint"))),
        )
    )


def _ord(group: int, *parts):
    return F.concat(F.array(F.lit(group).cast("bigint")), *parts).alias("job_ord")


def build_jobs(
    ids: Mapping[str, DataFrame],
    subreddits: DataFrame,
    keywords: DataFrame,
    enabled: Mapping[str, bool] | None = None,
    ids_per_row: int = IDS_PER_ROW,
) -> DataFrame:
    """JOB rows of all enabled platforms with their order inside the platform (``job_ord``).

    ``ids`` maps a platform to its id list. A platform that ``enabled`` does not list is
    enabled; one without jobs has no rows.
    """
    parts = [targeted_jobs(values, platform, ids_per_row) for platform, values in sorted(ids.items())]
    parts += [subreddit_jobs(subreddits, keywords), keyword_jobs(keywords)]
    jobs = parts[0]
    for part in parts[1:]:
        jobs = jobs.unionByName(part, allowMissingColumns=True)
    off = [p for p, on in (enabled or {}).items() if not on]
    if off:
        jobs = jobs.filter(~F.col("platform").isin(off))
    search = F.col("collection_method") != "targeted_id"
    filled = jobs.withColumns(
        {
            "limit": F.when(search, F.lit(DEFAULT_LIMIT)),
            "include_comments": F.lit(DEFAULT_INCLUDE_COMMENTS),
            "comment_limit": F.lit(DEFAULT_COMMENT_LIMIT),
            "part": F.coalesce(F.col("part"), F.lit(0)).cast("bigint"),
        }
    )
    return filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOB], "part", "job_ord")
