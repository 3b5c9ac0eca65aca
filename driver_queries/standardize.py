"""Nested posts to standardized rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import long_sql, query, std, texts, with_std
from talkloom.functions.keys import extraction_key, row_key
from talkloom.operators.dedup import first_rows, first_wins, skip_seen
from talkloom.operators.standardize import standardize, standardize_counts
from talkloom.plans.extraction import conform_extraction, extraction_summary, select_new_rows
from talkloom.plans.preprocessing import preprocessing_summary
from talkloom.schemas import STANDARDIZED_COLUMNS
from talkloom.sources.tables import seen_keys, state_keys

TURNS_PER_ROW = 200


def raw(spark, sf, damaged=False):
    """Conversations as extraction rows: turn 0 is the post, odd turns its comments, even
    turns replies to the comment before.

    A conversation of more than ``TURNS_PER_ROW`` turns lands as several rows of the same
    post, each with the next stretch of comments, so no row grows with its length.
    """
    turns = texts(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    part = F.floor(F.greatest(F.col("turn") - 1, F.lit(0)) / TURNS_PER_ROW).cast("bigint")
    shape = turns.select("conv_id", part.alias("part"), "turn", "role", "text")
    packed = shape.filter("turn > 0").groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t")
    )
    odd = F.filter("t", lambda x: x["turn"] % 2 == 1)

    def entry(x, prefix):
        return [
            F.concat(F.lit(prefix), F.col("conv_id"), F.lit("_"), x["turn"]).alias("id"),
            x["text"].alias("text"),
            F.lit("").alias("author"),
            F.when(x["role"] == "user", F.lit("https://example.test/u")).otherwise(F.lit("")).alias("url"),
            F.when(x["role"] == "user", F.lit("human")).otherwise(F.lit("")).alias("provided_language_label"),
        ]

    comments = F.transform(
        odd,
        lambda c: F.struct(
            *entry(c, "c"),
            F.transform(F.filter("t", lambda x: x["turn"] == c["turn"] + 1), lambda r: F.struct(*entry(r, "r"))).alias("replies"),
        ),
    )
    nested = packed.select("conv_id", "part", F.to_json(comments).alias("comments_json"))
    roots = shape.filter("turn = 0").select("conv_id", "role", "text")
    every = nested.join(roots, "conv_id", "left")
    # A conversation of one turn has no packed row of its own.
    alone = roots.join(nested, "conv_id", "left_anti").withColumns({"part": F.lit(0).cast("bigint"), "comments_json": F.lit("")})
    rows = every.unionByName(alone)
    body = F.coalesce(F.col("text"), F.lit(""))
    if damaged:
        rows = rows.withColumn(
            "comments_json",
            F.when(F.col("role") == "system", F.concat(F.lit("["), "comments_json"))
            .when(F.col("conv_id") % 7 == 1, "{}")
            .when(F.col("conv_id") % 7 == 2, "null")
            .when(F.col("conv_id") % 7 == 3, F.concat(F.lit("[1,"), F.expr("substring(comments_json, 2)")))
            .otherwise(F.col("comments_json")),
        )
    return rows.select(
        F.when(F.col("role") == "system", "youtube").otherwise("reddit").alias("platform"),
        F.when(F.col("conv_id") % 2 == 0, "targeted_id").otherwise("keyword").alias("collection_method"),
        F.concat(F.lit("p"), "conv_id").alias("id"),
        body.alias("text"),
        F.substring_index(body, " ", 2).alias("title"),
        F.concat(F.lit("https://example.test/"), "conv_id").alias("url"),
        "comments_json",
        F.lit("").alias("metadata_json"),
        F.when(F.col("role") == "user", "").otherwise("machine").alias("provided_classification_label"),
        F.array("conv_id", "part").alias("row_ord"),
    ).transform(conform_extraction)


# The same rows straight from the turns.
TURNS = r"""turns AS (
  SELECT c.conv_id, c.turn, c.role, trim(regexp_replace(c.text, '\s+', ' ', 'g')) AS text,
    r.role AS root_role, trim(regexp_replace(coalesce(r.text, ''), '\s+', ' ', 'g')) AS root_text
  FROM conversations c LEFT JOIN conversations r ON r.conv_id = c.conv_id AND r.turn = 0),
flat AS (
  SELECT conv_id, turn,
    CASE WHEN root_role = 'system' THEN 'youtube' ELSE 'reddit' END AS platform,
    CASE WHEN conv_id % 2 = 0 THEN 'targeted_id' ELSE 'keyword' END AS collection_method,
    CASE WHEN turn = 0 THEN 'p' || conv_id WHEN turn % 2 = 1 THEN 'c' || conv_id || '_' || turn
      ELSE 'r' || conv_id || '_' || turn END AS id,
    text,
    CASE WHEN turn = 0 THEN CASE WHEN root_role = 'system' THEN 'video' ELSE 'post' END
      WHEN turn % 2 = 1 THEN 'comment' ELSE 'reply' END AS category,
    'p' || conv_id AS associated_id,
    CASE WHEN turn > 0 AND role = 'user' THEN 'https://example.test/u' ELSE 'https://example.test/' || conv_id END AS source_url,
    CASE WHEN turn > 0 AND role = 'user' THEN 'human' ELSE '' END AS provided_language_label,
    CASE WHEN root_role = 'user' THEN '' ELSE 'machine' END AS provided_classification_label
  FROM turns)"""
# The title is the first two words of the body, so it is never prefixed.
_COLUMNS = ", ".join(STANDARDIZED_COLUMNS)


@query("q_standardize", f"WITH {TURNS} SELECT {_COLUMNS} FROM flat WHERE text <> ''")
def flatten(spark, sf):
    return standardize(raw(spark, sf)).select(*STANDARDIZED_COLUMNS)


def with_copies(spark, sf):
    """Every conversation twice, the second time under another method and with blank posts
    where the post is a user's."""
    rows = raw(spark, sf)
    again = rows.withColumns(
        {
            "collection_method": F.lit("again"),
            "text": F.when(F.col("provided_classification_label") == "", F.lit(" \t ")).otherwise(F.col("text")),
            "title": F.lit(""),
            "row_ord": F.concat(F.array(F.lit(1).cast("bigint")), "row_ord"),
        }
    )
    return rows.withColumn("row_ord", F.concat(F.array(F.lit(0).cast("bigint")), "row_ord")).unionByName(again)


_COPIES = f"""WITH {TURNS},
 landed AS (SELECT conv_id, root_role FROM turns GROUP BY ALL),
 m AS (SELECT (SELECT count(*) FROM landed) AS landed, (SELECT count(*) FROM landed WHERE root_role = 'user') AS blank,
   (SELECT count(*) FROM flat) AS kept, (SELECT count(*) FROM flat WHERE category = 'comment') AS comments,
   (SELECT count(*) FROM flat WHERE category = 'reply') AS replies)
 """


@query(
    "q_standardize_stats",
    _COPIES
    + long_sql(
        "m",
        {
            "input_rows": "2 * landed",
            "output_rows": "kept",
            "dropped_empty_text_rows": "blank",
            "deduplicated_rows": "2 * kept - blank - kept",
            "comments_exploded": "comments",
            "replies_exploded": "replies",
            "invalid_comments_json_rows": "0",
        },
    ),
)
def stats(spark, sf):
    return standardize_counts(with_copies(spark, sf))


_DAMAGE = r"""d AS (SELECT conv_id, root_role, count(*) FILTER (turn > 0) AS nested,
   CASE WHEN root_role = 'system' THEN 'broken' WHEN conv_id % 7 = 1 THEN 'object' WHEN conv_id % 7 = 2 THEN 'null'
     ELSE 'whole' END AS damage FROM turns GROUP BY ALL)"""


@query(
    "q_conform",
    f"""WITH {TURNS}, {_DAMAGE},
    m AS (SELECT count(*) AS rows, count(*) FILTER (damage IN ('object', 'null')) AS invalid,
      coalesce(sum(nested) FILTER (damage = 'whole'), 0) AS nested FROM d),
    k AS (SELECT count(*) FILTER (category = 'comment') AS comments, count(*) FILTER (category = 'reply') AS replies
      FROM flat JOIN d USING (conv_id) WHERE damage = 'whole'),
    s AS (SELECT * FROM m, k) """
    + long_sql(
        "s",
        {
            "input_rows": "rows",
            "output_rows": "rows + nested",
            "dropped_empty_text_rows": "0",
            "deduplicated_rows": "0",
            "comments_exploded": "comments",
            "replies_exploded": "replies",
            "invalid_comments_json_rows": "invalid",
        },
    ),
)
def damaged(spark, sf):
    return standardize_counts(raw(spark, sf, damaged=True))


# ---- dedup and skip-seen ---------------------------------------------------


def shifted(spark, sf):
    """Documents and a copy that lands later under another method and with a shorter text."""
    rows = std(spark, sf)
    copy = rows.withColumns(
        {"collection_method": F.lit("late"), "text": F.upper("platform"), "row_ord": F.array(F.col("doc_id") + 1_000_000_000)}
    )
    return copy.unionByName(rows)


@query("q_first_wins", with_std("SELECT doc_id, collection_method, text FROM std"))
def wins(spark, sf):
    rows = shifted(spark, sf).withColumn("record_key", row_key())
    return first_wins(rows, "record_key", ["row_ord"]).select("doc_id", "collection_method", "text")


@query(
    "q_first_wins_hot",
    "SELECT text, min(doc_id) AS doc_id FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 'one hot key' ELSE text END AS text FROM documents) GROUP BY text",
)
def hot(spark, sf):
    """One key holds most rows: the group limit below the exchange keeps it flat."""
    rows = texts(spark, sf, "documents", "doc_id", "lang", "text").select(
        "doc_id", F.when(F.col("lang") == "en", "one hot key").otherwise(F.col("text")).alias("text")
    )
    return first_wins(rows, "text", ["doc_id"]).select("text", "doc_id")


def history(spark, sf):
    """(master, state): rows of good quality are in the master, toxic ones in the state."""
    rows = std(spark, sf)
    master = rows.filter("quality = 1")
    state = rows.filter("provided_classification_label <> ''").select(row_key().alias("record_key"))
    return master, state.unionByName(spark.createDataFrame([("",)], "record_key string"))


@query("q_skip_seen", with_std("SELECT doc_id, record_key FROM keyed WHERE NOT (quality = 1 OR provided_classification_label <> '')"))
def unseen(spark, sf):
    master, state = history(spark, sf)
    rows = std(spark, sf).withColumn("record_key", row_key())
    return skip_seen(rows, seen_keys(master, state)).select("doc_id", "record_key")


@query("q_skip_seen_extraction", with_std("SELECT doc_id, platform || '|' || id AS record_key FROM std WHERE quality <> 1"))
def unseen_extraction(spark, sf):
    master, _ = history(spark, sf)
    rows = std(spark, sf).withColumn("record_key", extraction_key())
    return skip_seen(rows, seen_keys(master, spark.createDataFrame([], "record_key string"), extraction_key)).select(
        "doc_id", "record_key"
    )


@query("q_force_mode", with_std("SELECT doc_id, record_key FROM keyed"))
def forced(spark, sf):
    return skip_seen(std(spark, sf).withColumn("record_key", row_key()), None).select("doc_id", "record_key")


@query("q_state_keys", with_std("SELECT record_key FROM keyed WHERE provided_classification_label <> ''"))
def states(spark, sf):
    return state_keys(history(spark, sf)[1])


@query(
    "q_limit_then_skip",
    with_std(
        "SELECT doc_id FROM (SELECT * FROM std ORDER BY doc_id LIMIT 500) WHERE NOT (quality = 1 OR provided_classification_label <> '')"
    ),
)
def limited(spark, sf):
    """--limit is the feature here: the first 500 input rows, counted before skipping."""
    master, state = history(spark, sf)
    rows = first_rows(std(spark, sf), 500, ["row_ord"]).withColumn("record_key", row_key())
    return skip_seen(rows, seen_keys(master, state)).select("doc_id")


@query(
    "q_extraction_first_wins",
    with_std(
        long_sql(
            "m",
            {
                "output_rows": "n",
                "new_rows_added": "n",
                "num_platforms": "p",
                "skipped_existing_rows": "n",
                "duplicate_rows_skipped": "n",
            },
            {"platform_distribution": "platform", "collection_method_distribution": "collection_method"},
            "std",
        ),
        "m AS (SELECT count(*) AS n, count(DISTINCT platform) AS p FROM std)",
    ),
)
def extraction_wins(spark, sf):
    landed = shifted(spark, sf).select("platform", "collection_method", "id", "text", "row_ord")
    return extraction_summary(landed, select_new_rows(landed, None))


@query(
    "q_preprocess_summary",
    f"""WITH {TURNS}, fresh AS (SELECT * FROM flat WHERE category <> 'reply'),
    m AS (SELECT (SELECT count(DISTINCT conv_id) FROM flat) AS landed, (SELECT count(*) FROM flat) AS rows,
      (SELECT count(*) FROM flat WHERE category = 'comment') AS comments, (SELECT count(*) FROM flat WHERE category = 'reply') AS replies,
      (SELECT count(*) FROM fresh) AS added, (SELECT count(DISTINCT platform) FROM fresh) AS platforms) """
    + long_sql(
        "m",
        {
            "input_rows": "landed",
            "output_rows": "rows",
            "dropped_empty_text_rows": "0",
            "deduplicated_rows": "0",
            "comments_exploded": "comments",
            "replies_exploded": "replies",
            "invalid_comments_json_rows": "0",
            "new_rows_added": "added",
            "num_platforms": "platforms",
            "skipped_existing_rows": "rows - added",
        },
        {
            "platform_distribution": "platform",
            "collection_method_distribution": "collection_method",
            "category_distribution": "category",
        },
        "fresh",
    ),
)
def preprocess(spark, sf):
    rows = raw(spark, sf)
    done = standardize(rows)
    replies = done.filter("category = 'reply'").select("record_key")
    return preprocessing_summary(rows, skip_seen(done, replies))
