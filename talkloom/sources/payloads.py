"""Landed API payloads to extraction rows and comment lists.

Each function takes the frame ``spark.read.schema(...).json(path)`` gives, with the API's
own field names, plus the context of the request that brought the item:
``collection_method`` and, for searches, ``query`` (and ``searched_subreddit``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from talkloom.functions.clock import epoch_to_iso
from talkloom.functions.jsontext import json_array, json_object, json_string, parse_json, spaced_json
from talkloom.functions.text import blank_if_null, null_if_blank
from talkloom.schemas import EXTRACTION_COLUMNS

# --- fixed values: URL prefixes of the platforms ---
REDDIT_URL = "https://www.reddit.com"
YOUTUBE_URL = "https://www.youtube.com/watch?v="
TWITTER_URL = "https://x.com/i/web/status/"
# --- end of fixed values ---

_COUNTS = "struct<retweet_count:bigint,reply_count:bigint,like_count:bigint,quote_count:bigint>"
REDDIT_POST = (
    "id string, selftext string, title string, author string, created_utc double, permalink string, "
    "subreddit string, score bigint, upvote_ratio double"
)
REDDIT_COMMENTS = (
    "source_id string, comments array<struct<id:string,body:string,author:string,created_utc:double,permalink:string>>"
)
_SNIPPET = "struct<description:string,title:string,channelTitle:string,channelId:string,publishedAt:string>"
YOUTUBE_VIDEO = f"id string, snippet {_SNIPPET}, statistics struct<viewCount:string,likeCount:string>"
_COMMENT = "struct<id:string,snippet:struct<textDisplay:string,authorDisplayName:string,publishedAt:string>>"
YOUTUBE_THREADS = (
    f"source_id string, items array<struct<snippet:struct<topLevelComment:{_COMMENT}>,"
    f"replies:struct<comments:array<{_COMMENT}>>>>"
)
TWEET = f"id string, text string, author_id string, created_at string, conversation_id string, public_metrics {_COUNTS}"
TWEETS = "source_id string, data array<struct<id:string,text:string,author_id:string,created_at:string>>"


def _context(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _method(df: DataFrame) -> Column:
    return F.coalesce(_context(df, "collection_method"), F.lit("targeted_id"))


def _number_json(value: Column) -> Column:
    """A number as JSON, a missing one as the empty string."""
    return F.coalesce(value.cast("string"), F.lit('""'))


def _extraction_rows(df: DataFrame, run_ts: str, **values: Column) -> DataFrame:
    fixed = {
        "collection_method": _method(df),
        "comments_json": F.lit("[]"),
        "provided_language_label": F.lit(""),
        "provided_classification_label": F.lit(""),
        "extracted_at_utc": F.lit(run_ts),
    }
    filled = {**fixed, **values}
    job = [c for c in ("job_ord", "pos", "include_comments", "comment_limit") if c in df.columns]
    return df.select(*[blank_if_null(filled[c]).alias(c) for c in EXTRACTION_COLUMNS], *job)


def reddit_posts(df: DataFrame, run_ts: str) -> DataFrame:
    query = _context(df, "query")
    searched = F.when(query.isNotNull(), F.coalesce(_context(df, "searched_subreddit"), F.lit("all")))
    subreddit = F.coalesce(null_if_blank(blank_if_null("subreddit")), searched, F.lit(""))
    metadata = json_object(
        [
            ("subreddit", json_string(subreddit)),
            ("query", F.when(query.isNotNull(), json_string(query))),
            ("score", _number_json(F.col("score"))),
            ("upvote_ratio", _number_json(F.col("upvote_ratio"))),
        ]
    )
    return _extraction_rows(
        df,
        run_ts,
        platform=F.lit("reddit"),
        id=F.col("id"),
        text=F.col("selftext"),
        title=F.col("title"),
        author=F.col("author"),
        created_at_utc=epoch_to_iso("created_utc"),
        url=F.concat(F.lit(REDDIT_URL), blank_if_null("permalink")),
        metadata_json=metadata,
    )


def youtube_videos(df: DataFrame, run_ts: str) -> DataFrame:
    query = _context(df, "query")
    metadata = json_object(
        [
            ("channel_id", json_string("snippet.channelId")),
            ("view_count", json_string("statistics.viewCount")),
            ("like_count", json_string("statistics.likeCount")),
            ("query", F.when(query.isNotNull(), json_string(query))),
        ]
    )
    return _extraction_rows(
        df,
        run_ts,
        platform=F.lit("youtube"),
        id=F.col("id"),
        text=F.col("snippet.description"),
        title=F.col("snippet.title"),
        author=F.col("snippet.channelTitle"),
        created_at_utc=F.col("snippet.publishedAt"),
        url=F.concat(F.lit(YOUTUBE_URL), blank_if_null("id")),
        metadata_json=metadata,
    )


def keyword_videos(hits: DataFrame, videos: DataFrame, run_ts: str) -> DataFrame:
    """Videos of a keyword search: ``hits(id, query, job_ord, pos)`` name them, ``videos``
    are their payloads. Rows are tagged ``keyword`` and the query enters the metadata."""
    found = hits.withColumn("collection_method", F.lit("keyword")).join(videos, "id")
    return youtube_videos(found, run_ts)


def tag_keyword(rows: DataFrame, query: Column) -> DataFrame:
    """Re-tag finished rows as keyword hits, merging the query into their metadata.

    Metadata that is not a JSON object counts as empty.
    """
    bag = F.coalesce(
        F.try_variant_get(parse_json("metadata_json"), "$", "map<string,variant>"),
        F.create_map().cast("map<string,variant>"),
    )
    kept = F.map_filter(bag, lambda k, v: k != "query")
    members = F.transform(
        F.map_entries(kept), lambda e: F.concat(json_string(e["key"]), F.lit(": "), spaced_json(e["value"]))
    )
    merged = F.concat(
        F.lit("{"),
        F.array_join(F.concat(members, F.array(F.concat(F.lit('"query": '), json_string(query)))), ", "),
        F.lit("}"),
    )
    return rows.withColumn("metadata_json", merged).withColumn("collection_method", F.lit("keyword"))


def tweets(df: DataFrame, run_ts: str) -> DataFrame:
    query = _context(df, "query")
    metrics = F.to_json("public_metrics")
    metadata = json_object(
        [
            ("query", F.when(query.isNotNull(), json_string(query))),
            ("author_id", json_string("author_id")),
            ("conversation_id", json_string("conversation_id")),
            # Counters only: no text in it that a separator could be mistaken for.
            ("public_metrics", F.coalesce(F.regexp_replace(metrics, "([:,])", "$1 "), F.lit("{}"))),
        ]
    )
    return _extraction_rows(
        df,
        run_ts,
        platform=F.lit("twitter"),
        id=F.col("id"),
        text=F.col("text"),
        title=F.lit(""),
        author=F.col("author_id"),
        created_at_utc=F.col("created_at"),
        url=F.concat(F.lit(TWITTER_URL), blank_if_null("id")),
        metadata_json=metadata,
    )


# ---- comment lists ---------------------------------------------------------


def _comment_json(id_, text, author, created, url, replies: Column | None) -> Column:
    fields = [
        ("id", json_string(id_)),
        ("text", json_string(text)),
        ("author", json_string(author)),
        ("created_at_utc", json_string(created)),
        ("url", json_string(url)),
    ]
    return json_object(fields if replies is None else [*fields, ("replies", replies)])


def _prefix(items: Column, limit: Column | int | None) -> Column:
    """The first ``limit`` items; a column of limits has one for each row, null for no limit."""
    if limit is None:
        return items
    if isinstance(limit, Column):
        return F.when(limit.isNull(), items).otherwise(F.slice(items, F.lit(1), F.greatest(limit, F.lit(0))))
    return F.slice(items, 1, limit)


def _comments(df: DataFrame, platform: str, members: Column) -> DataFrame:
    told = [c for c in ("status", "error_type", "message") if c in df.columns]
    return df.select(
        F.lit(platform).alias("platform"),
        "source_id",
        F.coalesce(json_array(members), F.lit("[]")).alias("comments_json"),
        *told,
    )


def reddit_comments(df: DataFrame, limit: Column | int | None = 500) -> DataFrame:
    return _comments(
        df,
        "reddit",
        F.transform(
            _prefix(F.col("comments"), limit),
            lambda c: _comment_json(
                c["id"],
                c["body"],
                c["author"],
                epoch_to_iso(c["created_utc"]),
                F.concat(F.lit(REDDIT_URL), blank_if_null(c["permalink"])),
                F.lit("[]"),
            ),
        ),
    )


def youtube_comments(df: DataFrame, limit: Column | int | None = 500) -> DataFrame:
    def one(comment: Column, replies: Column | None) -> Column:
        s = comment["snippet"]
        return _comment_json(
            comment["id"], s["textDisplay"], s["authorDisplayName"], s["publishedAt"], F.lit(""), replies
        )

    def thread(item: Column) -> Column:
        replies = F.transform(item["replies"]["comments"], lambda r: one(r, None))
        return one(item["snippet"]["topLevelComment"], F.coalesce(json_array(replies), F.lit("[]")))

    return _comments(df, "youtube", F.transform(_prefix(F.col("items"), limit), thread))


def twitter_comments(df: DataFrame, limit: Column | int | None = 500) -> DataFrame:
    """The first ``limit`` tweets of a conversation without its root: cut first, then drop."""
    others = F.filter(_prefix(F.col("data"), limit), lambda t: ~t["id"].eqNullSafe(F.col("source_id")))
    return _comments(
        df,
        "twitter",
        F.transform(
            others,
            lambda t: _comment_json(
                t["id"],
                t["text"],
                t["author_id"],
                t["created_at"],
                F.concat(F.lit(TWITTER_URL), blank_if_null(t["id"])),
                F.lit("[]"),
            ),
        ),
    )


# Payload transforms per platform: (items -> extraction rows, threads -> comment lists).
# Add a platform by adding a pair.
REGISTRY: dict[str, tuple[Callable[..., DataFrame], Callable[..., DataFrame]]] = {
    "reddit": (reddit_posts, reddit_comments),
    "youtube": (youtube_videos, youtube_comments),
    "twitter": (tweets, twitter_comments),
}


def land_payloads(payloads: Mapping[str, DataFrame], run_ts: str, registry=None) -> DataFrame:
    """Extraction rows of several platforms; a platform nobody registered is an error."""
    return _per_platform(payloads, registry or REGISTRY, 0, run_ts)


def land_comments(threads: Mapping[str, DataFrame], limit: int | None = 500, registry=None) -> DataFrame:
    """Comment lists of several platforms."""
    return _per_platform(threads, registry or REGISTRY, 1, limit)


def _per_platform(frames: Mapping[str, DataFrame], registry, place: int, argument) -> DataFrame:
    unknown = sorted(set(frames) - set(registry))
    if unknown or not frames:
        raise ValueError(f"no payload transform for platforms: {', '.join(unknown) or 'none given'}")
    parts = [registry[name][place](frame, argument) for name, frame in sorted(frames.items())]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def first_results(rows: DataFrame, limit: Column | int = 100, place: str = "pos") -> DataFrame:
    """The results whose place in the answer of their job is below ``limit``, one number or a column."""
    return rows.filter(F.col(place) < limit)
