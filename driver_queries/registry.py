"""Registration of queries, the shared table adapters and their SQL twins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from talkloom import prepare_session
from talkloom.functions.text import clean_text
from talkloom.session import spread

RUN_TS = "2026-01-02T03:04:05Z"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare_session(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The columns of a table whose rows are about to be worked on one by one."""
    return spread(table(spark, sf_dir, name).select(*columns))


def scratch(spark: SparkSession) -> str:
    """A new folder for tables a query writes: in the shared folder of the cluster; a local one only where Spark runs locally."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = shared.rstrip("/") if shared else tempfile.mkdtemp(prefix="talkloom-query-")
    return f"{base}/talkloom-{uuid.uuid4().hex}"


# ---- documents as standardized rows ---------------------------------------
#
# Platform follows the language, so one platform holds most rows; a platform outside the
# known three is among them. Labels provide a language where quality is 0 and a
# classification where the text is toxic.


def std(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels")
    lang = F.col("lang")
    platform = (
        F.when(lang == "en", "reddit").when(lang == "fr", "youtube").when(lang == "de", "twitter").otherwise("forum")
    )
    id_ = F.col("doc_id").cast("string")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        platform.alias("platform"),
        F.when(F.col("n_chars") > 1000, "targeted_id").otherwise("keyword").alias("collection_method"),
        id_.alias("id"),
        clean_text("text").alias("text"),
        F.when(lang == "fr", "video").otherwise("post").alias("category"),
        id_.alias("associated_id"),
        F.lit("").alias("source_url"),
        F.when(F.col("quality") == 0, lang).otherwise("").alias("provided_language_label"),
        F.when(F.col("toxic") == 1, "invalid_neither").otherwise("").alias("provided_classification_label"),
        F.coalesce(F.col("quality"), F.lit(-1)).alias("quality"),
        F.array("doc_id").alias("row_ord"),
        F.lit("").alias("run_id"),
    )


STD = r"""std AS (
  SELECT d.doc_id,
    CASE d.lang WHEN 'en' THEN 'reddit' WHEN 'fr' THEN 'youtube' WHEN 'de' THEN 'twitter' ELSE 'forum' END AS platform,
    CASE WHEN d.n_chars > 1000 THEN 'targeted_id' ELSE 'keyword' END AS collection_method,
    CAST(d.doc_id AS VARCHAR) AS id,
    trim(regexp_replace(d.text, '\s+', ' ', 'g')) AS text,
    CASE WHEN d.lang = 'fr' THEN 'video' ELSE 'post' END AS category,
    CAST(d.doc_id AS VARCHAR) AS associated_id,
    '' AS source_url,
    CASE WHEN l.quality = 0 THEN d.lang ELSE '' END AS provided_language_label,
    CASE WHEN l.toxic = 1 THEN 'invalid_neither' ELSE '' END AS provided_classification_label,
    coalesce(l.quality, -1) AS quality
  FROM documents d LEFT JOIN labels l USING (doc_id)),
keyed AS (SELECT *, platform || '|' || category || '|' || id || '|' || associated_id AS record_key FROM std)"""


def with_std(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([STD, *ctes]) + "\n" + select


# ---- lexicons that hit the invented prose ----------------------------------

LEXICON_A = ("model*", "ai", "whst", "eauou*")
LEXICON_B = ("er", "shthe*", "el")

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"


def lexicon_sql(terms, boundaries: bool = True) -> str:
    body = "|".join(t.replace("*", WORD[:-1] + "-]*" if boundaries else "") for t in terms)
    return f"(^|{NOT_WORD})({body})($|{NOT_WORD})" if boundaries else f"({body})"


def fold_sql(column: str) -> str:
    return f"replace(lower({column}), 'ß', 'ss')"


def available_sql(has_a: str, has_b: str) -> str:
    return (
        f"CASE WHEN {has_a} AND {has_b} THEN 'with_ai_and_health_terms' WHEN {has_a} THEN 'with_ai_term_only' "
        f"WHEN {has_b} THEN 'with_health_term_only' ELSE 'no_valid_terms' END"
    )


FLAGGED = (
    f"flagged AS (SELECT *, regexp_matches({fold_sql('text')}, '{lexicon_sql(LEXICON_A)}') AS a, "
    f"regexp_matches({fold_sql('text')}, '{lexicon_sql(LEXICON_B)}') AS b FROM keyed)"
)
RULE = (
    "CASE terms WHEN 'with_ai_term_only' THEN 'invalid_ai_only' "
    "WHEN 'with_health_term_only' THEN 'invalid_health_only' ELSE 'invalid_neither' END"
)
ROUTED = (
    f"termed AS (SELECT *, {available_sql('a', 'b')} AS terms FROM flagged),\n"
    "routed AS (SELECT *, CASE WHEN provided_classification_label <> '' THEN 'provided' "
    "WHEN terms = 'with_ai_and_health_terms' THEN 'batch' ELSE 'rules' END AS route FROM termed)"
)


def long_sql(source: str, counters: dict[str, str], spreads: dict[str, str] | None = None, base: str | None = None) -> str:
    """(metric, key, value) from counters over ``source`` and distributions over ``base``."""
    parts = [f"SELECT '{m}' AS metric, '' AS key, CAST({e} AS BIGINT) AS value FROM {source}" for m, e in counters.items()]
    for metric, column in (spreads or {}).items():
        parts.append(
            f"SELECT '{metric}', {column}, count(*) FROM {base or source} WHERE {column} <> '' GROUP BY {column}"
        )
    return "\nUNION ALL ".join(parts)
