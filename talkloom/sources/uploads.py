"""Uploaded CSV files of any layout to extraction rows.

A row either is one text, or carries a ``json`` cell with a list of ``results``.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from talkloom.functions.clock import epoch_to_iso
from talkloom.functions.hashing import item_hashes, short_hash
from talkloom.functions.jsontext import (
    filled_json,
    is_object,
    json_field_or_blank,
    json_list,
    json_object,
    json_string,
    parse_json,
)
from talkloom.functions.text import blank_if_null, first_filled, null_if_blank, strip
from talkloom.operators.dedup import first_wins
from talkloom.operators.summaries import long_metrics, union_metrics
from talkloom.schemas import EXTRACTION_COLUMNS, ROW_ORD
from talkloom.session import spread
from talkloom.sources.tables import CSV_OPTIONS

# --- fixed values: column aliases and defaults of uploaded files ---
PLATFORM_ALIASES = ("platform", "source_platform", "source")
ID_ALIASES = ("id", "source_item_id", "post_id")
LANGUAGE_ALIASES = ("provided_language_label", "language_label")
CLASSIFICATION_ALIASES = ("provided_classification_label", "classification_label")
DEFAULT_PLATFORM = "manual"
DEFAULT_METHOD = "manual_upload"
DEFAULT_JSON_METHOD = "manual_upload_json"
FIRST_RECORD_NUMBER = 2
# --- end of fixed values ---

# One path and one number per file: some 20 MB at most.
MAX_BROADCAST_FILES = 100_000

_RECORD_COLUMNS = (
    "file_name",
    "record_no",
    "json",
    "text",
    "platform",
    "source_id",
    "collection_method",
    "query",
    "url",
    "language",
    "label",
    "original_columns",
    "row_json",
)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, file_name) of the uploads, empty files included; no file is opened."""
    paths = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).inputFiles()
    names = [(p, unquote(p.rsplit("/", 1)[-1])) for p in paths]
    return spark.createDataFrame(names, "path string, file_name string")


def file_layouts(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[tuple[list[str], list[str]]]:
    """(column names, paths) per distinct header.

    Headers are found by a job that forwards one line per file; what reaches the driver
    is one entry per file, as in any file listing.
    """
    lines = spark.read.option("pathGlobFilter", pattern).text(folder)
    first = (
        lines.select("value", "_metadata.file_path", "_metadata.file_block_start")
        .withColumn("_at", F.monotonically_increasing_id())
        .filter("file_block_start = 0")
        .groupBy("file_path")
        .agg(F.min_by("value", "_at").alias("header"))
        .groupBy("header")
        .agg(F.sort_array(F.collect_list("file_path")).alias("paths"))
    )
    layouts = []
    for row in first.collect():
        paths = [unquote(p) for p in row.paths]  # metadata paths are URI-encoded
        header = row.header.lstrip("\ufeff")
        names = next(csv.reader([header]), [])
        if header.count('"') % 2:
            # A quoted name runs over several lines: let the CSV reader find its end.
            for path in paths:
                cells = spark.read.options(**{**CSV_OPTIONS, "header": False}).csv(path).first()
                layouts.append(([str(c or "").lstrip("\ufeff") for c in cells], [path]))
        elif names:
            layouts.append((names, paths))
    return layouts


def read_records(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """One row per CSV record of every file, reduced to the columns uploads are read for."""
    parts = [_read_layout(spark, names, paths) for names, paths in file_layouts(spark, folder, pattern)]
    if not parts:
        schema = ", ".join(f"{c} {'bigint' if c == 'record_no' else 'string'}" for c in _RECORD_COLUMNS)
        return spark.createDataFrame([], schema)
    records = parts[0]
    for part in parts[1:]:
        records = records.unionByName(part)
    # Numbered already: records of few files may now part from their file's one task.
    return spread(records)


def _decoded(column: str) -> Column:
    """A metadata path part as text: it is URI-encoded, where a plus is only a plus."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def _read_layout(spark: SparkSession, names: Sequence[str], paths: Sequence[str]) -> DataFrame:
    # Columns are read by position; of a repeated name the last one counts.
    positions = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{p} string" for p in positions)
    cells = (
        spark.read.options(**CSV_OPTIONS)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .schema(schema)
        .csv(list(paths))
        .select("*", F.col("_metadata.file_path").alias("_path"), _decoded("_metadata.file_name").alias("file_name"))
        .withColumn("_at", F.monotonically_increasing_id())
    )
    by_name = dict(zip(names, positions))

    def alias(*wanted: str) -> Column:
        present = [F.col(by_name[n]) for n in wanted if n in by_name]
        return first_filled(*[blank_if_null(c) for c in present]) if present else F.lit("")

    def all_cells(keep_blank: bool) -> Column:
        members = []
        for name in sorted(by_name):
            value = blank_if_null(by_name[name])
            quoted = json_string(value)
            if keep_blank:
                members.append((name, quoted))
            elif name:
                members.append((name, F.when(value != "", quoted)))
        return json_object(members)

    records = cells.select(
        "_path",
        "file_name",
        "_at",
        alias("json").alias("json"),
        alias("text").alias("text"),
        F.coalesce(null_if_blank(alias(*PLATFORM_ALIASES)), F.lit(DEFAULT_PLATFORM)).alias("platform"),
        alias(*ID_ALIASES).alias("source_id"),
        alias("collection_method").alias("collection_method"),
        alias("query").alias("query"),
        alias("url").alias("url"),
        alias(*LANGUAGE_ALIASES).alias("language"),
        alias(*CLASSIFICATION_ALIASES).alias("label"),
        all_cells(keep_blank=False).alias("original_columns"),
        all_cells(keep_blank=True).alias("row_json"),
    )
    # A multi-line file is one unsplit scan, so its records carry consecutive ids. The
    # number of a record is its distance from the file's first id: no sort, and no
    # file gathered anywhere.
    starts = cells.groupBy(F.col("_path").alias("_file")).agg(F.min("_at").alias("_start"))
    if len(paths) <= MAX_BROADCAST_FILES:
        starts = F.broadcast(starts)
    numbered = records.join(starts, F.col("_path") == F.col("_file"))
    return numbered.withColumn("record_no", F.col("_at") - F.col("_start") + FIRST_RECORD_NUMBER).select(*_RECORD_COLUMNS)


def upload_items(records: DataFrame) -> DataFrame:
    """Every record's items with an ``outcome``: row, blank_text, invalid_json or nothing.

    A record without items still gives one line (``place`` 0), which is what counters
    are taken from. Records with a payload take a branch of their own: files without a
    ``json`` column are folded out of it before it runs.
    """
    return _flat_items(records.filter("json = ''")).unionByName(_payload_items(records.filter("json <> ''")))


def _flat_items(records: DataFrame) -> DataFrame:
    return records.select(
        "file_name",
        "record_no",
        F.lit(0).alias("place"),
        F.lit(0).cast("bigint").alias("result_index"),
        F.lit(False).alias("from_json"),
        "platform",
        F.coalesce(null_if_blank("collection_method"), F.lit(DEFAULT_METHOD)).alias("collection_method"),
        "text",
        "source_id",
        "url",
        F.lit("").alias("author"),
        F.lit("").alias("created_at_utc"),
        F.col("language").alias("provided_language_label"),
        F.col("label").alias("provided_classification_label"),
        short_hash(F.col("row_json")).alias("content_hash"),
        _flat_metadata().alias("metadata_json"),
        F.when(F.col("text") == "", F.lit("blank_text")).otherwise(F.lit("row")).alias("outcome"),
    )


def _payload_items(records: DataFrame) -> DataFrame:
    payload = records.withColumns({"_doc": parse_json("json"), "_hashes": item_hashes(F.col("json"))})
    results = F.try_variant_get("_doc", "$.results", "variant")
    listed = json_list(F.col("_doc"), "$.results")
    indexed = F.filter(
        F.transform(listed, lambda item, i: F.struct((i + 1).alias("result_index"), item.alias("item"))),
        lambda e: is_object(e["item"]),
    )
    malformed = F.col("_doc").isNull() | F.col("_hashes").isNull()
    invalid = malformed | (results.isNotNull() & listed.isNull())
    exploded = payload.select("*", invalid.alias("_invalid"), F.posexplode_outer(F.when(~malformed, indexed)).alias("_p", "_e"))
    item = F.col("_e.item")

    def either(first: str, second: str) -> Column:
        return strip(F.coalesce(null_if_blank(json_field_or_blank(item, first)), json_field_or_blank(item, second)))

    merged = exploded.select(
        "file_name",
        "record_no",
        F.coalesce(F.col("_p"), F.lit(0)).alias("place"),
        F.coalesce(F.col("_e.result_index"), F.lit(0)).cast("bigint").alias("result_index"),
        F.lit(True).alias("from_json"),
        "platform",
        F.coalesce(null_if_blank("collection_method"), F.lit(DEFAULT_JSON_METHOD)).alias("collection_method"),
        either("$.message", "$.message_rich").alias("text"),
        either("$.post_id", "$.id").alias("source_id"),
        strip(json_field_or_blank(item, "$.url")).alias("url"),
        json_field_or_blank(item, "$.author.name").alias("author"),
        epoch_to_iso(F.try_variant_get(item, "$.timestamp", "string")).alias("created_at_utc"),
        F.col("language").alias("provided_language_label"),
        F.col("label").alias("provided_classification_label"),
        F.try_element_at(F.col("_hashes"), F.col("_e.result_index").cast("int")).alias("content_hash"),
        _json_metadata(item).alias("metadata_json"),
        F.col("_e").isNull().alias("_no_item"),
        "_invalid",
    )
    outcome = (
        F.when(F.col("_invalid"), F.lit("invalid_json"))
        .when(F.col("_no_item"), F.lit("nothing"))
        .when(F.col("text") == "", F.lit("blank_text"))
        .otherwise(F.lit("row"))
    )
    return merged.withColumn("outcome", outcome).drop("_no_item", "_invalid")


def _flat_metadata() -> Column:
    return json_object(
        [
            ("original_columns", F.when(F.col("original_columns") != "{}", F.col("original_columns"))),
            ("source_file", json_string("file_name")),
            ("source_item_id", F.when(F.col("source_id") != "", json_string("source_id"))),
            ("source_row_number", F.col("record_no").cast("string")),
        ]
    )


def _json_metadata(item: Column) -> Column:
    return json_object(
        [
            ("associated_group_id", filled_json(item, "$.associated_group_id")),
            ("attached_post_url", filled_json(item, "$.attached_post_url")),
            ("author_id", filled_json(item, "$.author.id")),
            ("author_url", filled_json(item, "$.author.url")),
            ("comments_count", filled_json(item, "$.comments_count")),
            ("external_url", filled_json(item, "$.external_url")),
            ("query", F.when(F.col("query") != "", json_string("query"))),
            ("reactions", filled_json(item, "$.reactions")),
            ("reactions_count", filled_json(item, "$.reactions_count")),
            ("reshare_count", filled_json(item, "$.reshare_count")),
            ("result_index", F.col("_e.result_index").cast("string")),
            ("result_type", filled_json(item, "$.type")),
            ("source_file", json_string("file_name")),
            ("source_row_number", F.col("record_no").cast("string")),
        ]
    )


def number_duplicates(items: DataFrame) -> DataFrame:
    """Give every item its id: its own or a generated one, marked when it is not the first.

    Only "first or not" is asked per (platform, id). The firsts are found under a group
    limit and joined back on the identity of the item, which is unique: an id shared by
    a third of all rows gathers nowhere.
    """
    identity = ("file_name", "record_no", "result_index")
    stem = F.regexp_replace("file_name", r"(?<=.)\.[^.]*$", "")
    generated = F.concat(stem, F.lit("_"), _padded("record_no"), F.lit("_"), F.col("content_hash"))
    named = items.withColumn("candidate", F.coalesce(null_if_blank("source_id"), generated))
    firsts = first_wins(
        named.select(*identity, F.to_json(F.struct("platform", "candidate")).alias("_key")), "_key", list(identity)
    ).select(*[F.col(c).alias(f"_{c}") for c in identity])
    same = [F.col(c) == F.col(f"_{c}") for c in identity]
    marked = named.join(firsts, same, "left")
    again = F.concat("candidate", F.lit("__manual_"), _padded("record_no"), F.lit("_"), F.col("content_hash"))
    return marked.withColumn(
        "id", F.when(F.col("_record_no").isNotNull(), F.col("candidate")).otherwise(again)
    ).drop("candidate", *[f"_{c}" for c in identity])


def _padded(column: str) -> Column:
    return F.format_string("%05d", F.col(column))


def upload_rows(items: DataFrame, run_ts: str) -> DataFrame:
    """Extraction rows of the items that carry a text, in file, record and result order."""
    kept = number_duplicates(items.filter("outcome = 'row'"))
    constants = {
        "title": F.lit(""),
        "comments_json": F.lit("[]"),
        "extracted_at_utc": F.lit(run_ts),
    }
    return kept.select(
        *[constants.get(c, F.col(c)).alias(c) for c in EXTRACTION_COLUMNS], "file_name", "record_no", "result_index"
    )


def with_upload_order(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Attach ``row_ord``: files by name, then record, then result.

    Only the file list is numbered; it is as long as the listing Spark itself holds.
    """
    by_name = Window.orderBy("file_name")
    places = files.select(
        F.col("file_name").alias("_file"), F.row_number().over(by_name).cast("bigint").alias("_file_no")
    )
    if files.count() <= MAX_BROADCAST_FILES:
        places = F.broadcast(places)
    return (
        rows.join(places, F.col("file_name") == F.col("_file"))
        .withColumn(ROW_ORD, F.array(F.col("_file_no"), F.col("record_no"), F.col("result_index")))
        .drop("_file", "_file_no")
    )


def upload_counts(items: DataFrame, files: DataFrame) -> DataFrame:
    """Counters as (metric, key, value) rows; a file without rows is listed with 0."""
    is_row = F.col("outcome") == "row"
    per_file = items.groupBy("file_name").agg(
        F.count_if(F.col("place") == 0).alias("input_rows"),
        F.count_if(is_row).alias("output_rows"),
        F.count_if(F.col("outcome") == "blank_text").alias("skipped_empty_text_rows"),
        F.count_if(F.col("outcome") == "invalid_json").alias("invalid_json_rows"),
        F.count_if(is_row & F.col("from_json")).alias("json_results_extracted"),
    )
    listed = files.select("file_name").join(per_file, "file_name", "left").na.fill(0)
    names = ["input_rows", "output_rows", "skipped_empty_text_rows", "invalid_json_rows", "json_results_extracted"]
    totals = listed.agg(F.count(F.lit(1)).alias("input_files"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    by_file = listed.select(
        F.lit("rows_by_file").alias("metric"), F.col("file_name").alias("key"), F.col("output_rows").alias("value")
    )
    return union_metrics(long_metrics(totals, ["input_files", *names]), by_file)
