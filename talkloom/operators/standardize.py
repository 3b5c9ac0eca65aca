"""Posts with nested comments to one cleaned text per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from talkloom.functions.jsontext import is_object, json_field, json_field_or_blank, json_list, parse_json
from talkloom.functions.keys import row_key
from talkloom.functions.text import blank_if_null, clean_text, combine_title, null_if_blank
from talkloom.operators.dedup import first_wins
from talkloom.operators.summaries import long_metrics
from talkloom.schemas import ROOT_CATEGORY, ROW_ORD, STANDARDIZED_COLUMNS

_COUNTERS = (
    "input_rows",
    "output_rows",
    "dropped_empty_text_rows",
    "deduplicated_rows",
    "comments_exploded",
    "replies_exploded",
    "invalid_comments_json_rows",
)


def with_row_ord(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """Attach the input order as an array of numbers, which sorts element by element."""
    parts = [F.col(c) if isinstance(c, str) else c for c in order_by]
    return df.withColumn(ROW_ORD, F.array(*[p.cast("bigint") for p in parts]))


def root_category(platform: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROOT_CATEGORY.items() for x in pair])
    return F.coalesce(F.try_element_at(known, platform), F.lit("post"))


def flatten_posts(raw: DataFrame) -> DataFrame:
    """Every root, comment and reply of the extraction rows, cleaned but not yet filtered.

    ``raw`` carries the extraction columns and ``row_ord``. The nested lists are turned
    into one array of entries per row and exploded once, so the raw table is scanned
    once and nothing is joined or unioned. A root that will be dropped still yields its
    comments.
    """
    base = raw.select(
        *[blank_if_null(c).alias(c) for c in ("platform", "collection_method", "id", "url")],
        *[blank_if_null(c).alias(c) for c in ("provided_language_label", "provided_classification_label")],
        blank_if_null("title").alias("_title"),
        blank_if_null("text").alias("_body"),
        F.col(ROW_ORD),
        parse_json("comments_json", fallback="[]").alias("_doc"),
    )
    comments = json_list(F.col("_doc"))
    root = _entry("root", -1, -1, F.col("id"), F.col("_title"), F.col("_body"))
    nested = F.transform(
        F.filter(comments, is_object),
        lambda comment, i: F.concat(
            F.array(_json_entry("comment", i, F.lit(-1), comment)),
            F.transform(
                F.filter(F.coalesce(json_list(comment, "$.replies"), _no_variants()), is_object),
                lambda reply, j: _json_entry("reply", i, j, reply),
            ),
        ),
    )
    entries = F.concat(F.array(root), F.coalesce(F.flatten(nested), F.array().cast(_ENTRY_ARRAY)))
    exploded = base.select(
        "*",
        # Well-formed JSON that is not a list; malformed text counts as an empty list.
        (F.col("_doc").isNotNull() & comments.isNull()).alias("_not_a_list"),
        F.explode(entries).alias("e"),
    )
    is_root = F.col("e.kind") == "root"
    cleaned = exploded.select(
        "platform",
        "collection_method",
        F.col("e.id").alias("id"),
        clean_text("e.title").alias("_title"),
        clean_text("e.text").alias("_body"),
        F.when(is_root, root_category(F.col("platform"))).otherwise(F.col("e.kind")).alias("category"),
        F.col("id").alias("associated_id"),
        F.coalesce(null_if_blank("e.url"), F.col("url")).alias("source_url"),
        # A reply without a label takes the label of the root, not of its comment.
        F.coalesce(null_if_blank("e.language"), F.col("provided_language_label")).alias("provided_language_label"),
        F.coalesce(null_if_blank("e.label"), F.col("provided_classification_label")).alias(
            "provided_classification_label"
        ),
        F.concat(ROW_ORD, F.array(F.col("e.c"), F.col("e.r"))).alias(ROW_ORD),
        F.col("e.kind").alias("_kind"),
        (is_root & F.col("_not_a_list")).alias("_invalid"),
    )
    return cleaned.select(
        *[F.col(c) if c != "text" else combine_title("_title", "_body").alias("text") for c in STANDARDIZED_COLUMNS],
        ROW_ORD,
        "_kind",
        "_invalid",
    )


_ENTRY_ARRAY = (
    "array<struct<kind:string,c:bigint,r:bigint,id:string,title:string,text:string,url:string,"
    "language:string,label:string>>"
)


def _no_variants() -> Column:
    return F.array().cast("array<variant>")


def _entry(kind, c, r, id_, title, text, url=None, language=None, label=None) -> Column:
    blank = F.lit("")
    return F.struct(
        F.lit(kind).alias("kind"),
        (F.lit(c) if isinstance(c, int) else c).cast("bigint").alias("c"),
        (F.lit(r) if isinstance(r, int) else r).cast("bigint").alias("r"),
        id_.alias("id"),
        title.alias("title"),
        text.alias("text"),
        (blank if url is None else url).alias("url"),
        (blank if language is None else language).alias("language"),
        (blank if label is None else label).alias("label"),
    )


def _json_entry(kind: str, c: Column, r: Column, item: Column) -> Column:
    return _entry(
        kind,
        c,
        r,
        json_field_or_blank(item, "$.id"),
        F.lit(""),
        json_field(item, "$.text"),
        json_field_or_blank(item, "$.url"),
        json_field_or_blank(item, "$.provided_language_label"),
        json_field_or_blank(item, "$.provided_classification_label"),
    )


def is_valid() -> Column:
    return (F.col("id") != "") & (F.col("text") != "")


def standardize(raw: DataFrame) -> DataFrame:
    """STANDARDIZED rows of ``raw``: valid rows, first of every row key in traversal order."""
    rows = flatten_posts(raw).filter(is_valid()).withColumn("record_key", row_key())
    return first_wins(rows, "record_key", [ROW_ORD]).select(*STANDARDIZED_COLUMNS, ROW_ORD, "record_key")


def standardize_counts(raw: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """Counters of ``standardize`` as (metric, key, value) rows.

    Comment and reply counters count rows that were kept; ``dropped_empty_text_rows``
    also counts rows without an id. ``kept`` is the result of ``standardize`` where the
    caller has it written out already.
    """
    flat = flatten_posts(raw)
    before = flat.agg(
        F.count_if(F.col("_kind") == "root").alias("input_rows"),
        F.count_if(~is_valid()).alias("dropped_empty_text_rows"),
        F.count_if(is_valid()).alias("_valid"),
        F.count_if("_invalid").alias("invalid_comments_json_rows"),
    )
    if kept is None:
        narrow = flat.filter(is_valid()).select(row_key().alias("record_key"), ROW_ORD)
        kept = first_wins(narrow, "record_key", [ROW_ORD])
    # The two last places of the order are those of the comment and of the reply.
    comment, reply = F.element_at(ROW_ORD, -2), F.element_at(ROW_ORD, -1)
    after = kept.agg(
        F.count(F.lit(1)).alias("output_rows"),
        F.count_if((comment >= 0) & (reply < 0)).alias("comments_exploded"),
        F.count_if(reply >= 0).alias("replies_exploded"),
    )
    both = before.unionByName(after, allowMissingColumns=True)
    totals = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])
    totals = totals.withColumn("deduplicated_rows", F.col("_valid") - F.col("output_rows"))
    return long_metrics(totals, _COUNTERS)
