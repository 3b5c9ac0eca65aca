"""Language identification and the language stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import RUN_TS, long_sql, query, std, with_std
from talkloom.functions.jsontext import json_string_list
from talkloom.functions.keys import row_key
from talkloom.operators.batches import answered_languages, join_responses
from talkloom.operators.langid import LanguageSettings, decide, goes_to_batch, score_texts, train_profile
from talkloom.operators.numbering import assign_batches
from talkloom.plans.language import answer_candidates, language_output, language_summary, route_languages
from talkloom.schemas import LANGUAGE_COLUMNS
from talkloom.session import settle

SETTINGS = LanguageSettings(
    supported=("english", "french", "german"),
    order=("english", "french", "german"),
    label_map={"en": "english", "fr": "french", "de": "german"},
    cues=("indi", "subong"),
)
BATCH = 20
MODEL = "model-x"

LID = r"""chars AS (SELECT doc_id, lang, string_split(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), '') AS l FROM documents),
grams AS (SELECT doc_id, lang, a || b || c AS gram FROM (
  SELECT doc_id, lang, unnest(l[1:len(l) - 2]) AS a, unnest(l[2:len(l) - 1]) AS b, unnest(l[3:len(l)]) AS c FROM chars WHERE len(l) >= 3)),
profile AS (SELECT gram, lang AS code FROM (SELECT gram, lang, count(*) AS n FROM grams GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY gram ORDER BY n DESC, lang) = 1),
votes AS (SELECT doc_id, code, count(*) AS votes FROM grams JOIN profile USING (gram) GROUP BY ALL),
scores AS (SELECT doc_id, code, votes, CAST(sum(votes) OVER (PARTITION BY doc_id) AS BIGINT) AS total_votes FROM votes
  UNION ALL SELECT doc_id, 'und', 0, 0 FROM chars WHERE len(l) < 3),
scored AS (SELECT *, CASE WHEN total_votes > 0 THEN votes / total_votes ELSE 1.0 END::DOUBLE AS score FROM scores)"""
LADDER = r"""top AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, code) <= 3),
mapped AS (SELECT doc_id, score, code, CASE code WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' END AS language FROM top
  WHERE code IN ('en', 'fr', 'de')),
per AS (SELECT doc_id, (list(language ORDER BY score DESC, code))[1] AS language, max(score) AS score, count(DISTINCT language) FILTER (score >= 0.30) AS strong
  FROM mapped GROUP BY doc_id),
judged AS (SELECT s.*, p.language, p.score,
  CASE WHEN length(text) < 12 THEN 'too_short'
    WHEN contains(lower(text), 'indi') OR contains(lower(text), 'subong') THEN 'possible_hiligaynon'
    WHEN p.language IS NULL THEN 'unsupported_language'
    WHEN strong > 1 THEN 'possible_mixed_language'
    WHEN p.score < 0.75 THEN 'low_confidence' END AS reason
  FROM keyed s LEFT JOIN per p USING (doc_id)),
ladder AS (SELECT *, coalesce(reason IN ('possible_hiligaynon', 'possible_mixed_language', 'low_confidence'), false) AS batch FROM judged)"""


def profile_of(spark, sf):
    return train_profile(std(spark, sf).join(languages(spark, sf), "doc_id").select("code", "text"))


def languages(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("code"))


def texts_of(spark, sf):
    return std(spark, sf).select(F.col("doc_id").alias("row_key"), "text")


@query("q_lid_profile", f"WITH {LID} SELECT gram, code FROM profile")
def profile(spark, sf):
    return profile_of(spark, sf)


@query("q_lid_scores", f"WITH {LID} SELECT doc_id, code, votes, total_votes, score FROM scored")
def scores(spark, sf):
    scored = score_texts(texts_of(spark, sf), profile_of(spark, sf), keep_votes=True)
    return scored.withColumnRenamed("row_key", "doc_id")


@query("q_lid_scores_shuffled", f"WITH {LID} SELECT doc_id, code, votes, total_votes, score FROM scored")
def scores_shuffled(spark, sf):
    """The plan for profiles beyond the broadcast limit."""
    scored = score_texts(texts_of(spark, sf), profile_of(spark, sf), keep_votes=True, broadcast_rows=0)
    return scored.withColumnRenamed("row_key", "doc_id")


@query(
    "q_lid_ladder",
    with_std(
        """SELECT doc_id, coalesce(reason, 'accepted') AS reason, batch, CASE WHEN reason IS NULL THEN language ELSE 'out_of_scope' END AS language_label,
        CASE WHEN reason IS NULL THEN score ELSE 0.0 END::DOUBLE AS confidence FROM ladder""",
        LID,
        LADDER,
    ),
)
def ladder(spark, sf):
    texts = texts_of(spark, sf)
    judged = decide(texts, score_texts(texts, profile_of(spark, sf)), SETTINGS)
    return judged.select(
        F.col("row_key").alias("doc_id"),
        F.coalesce("reason", F.lit("accepted")).alias("reason"),
        goes_to_batch(F.col("reason"), SETTINGS).alias("batch"),
        "language_label",
        "confidence",
    )


# ---- stage -----------------------------------------------------------------


def routed(spark, sf):
    rows = std(spark, sf).withColumn("record_key", row_key())
    profile = profile_of(spark, sf)
    return route_languages(rows, lambda texts: score_texts(texts, profile), SETTINGS)


def synthetic_responses(rows):
    """One answer per batch of candidates: long texts get two languages, middling ones an
    unsupported one, short ones nothing; every third batch fails."""
    size = F.char_length("text")
    named = F.when(size > 3000, F.array(F.lit("french"), F.lit("english"))).when(
        size > 1000, F.array(F.lit("spanish"), F.lit("german"))
    )
    item = F.when(named.isNotNull(), F.struct("row_id", named.alias("language_detected")))
    failed = F.col("batch_id").cast("bigint") % 3 == 1
    return (
        rows.groupBy("batch_id")
        .agg(F.collect_list(item).alias("results"))
        .select("batch_id", F.when(failed, "error").otherwise("ok").alias("status"), F.to_json(F.struct("results")).alias("body"))
    )


def stage_output(spark, sf):
    rows = settle(routed(spark, sf))
    waiting = settle(
        assign_batches(rows.filter("route = 'batch'").withColumn("row_id", F.col("record_key")), "record_key", BATCH)
    )
    answered = answer_candidates(waiting, synthetic_responses(waiting), MODEL, RUN_TS, SETTINGS)
    decided = language_output(rows.filter("route <> 'batch'"), RUN_TS)
    return decided.select(*LANGUAGE_COLUMNS).unionByName(answered.select(*LANGUAGE_COLUMNS)), waiting


_PASSED = ", ".join(LANGUAGE_COLUMNS[:7])
STAGE = f"""answered AS (SELECT *, ((row_number() OVER (ORDER BY md5(record_key), record_key) - 1) // {BATCH}) % 3 = 1 AS failed
  FROM ladder WHERE batch AND provided_language_label = ''),
output AS (
  SELECT {_PASSED}, '["' || provided_language_label || '"]' AS language_detected, provided_language_label AS language_label,
    '{RUN_TS}' AS language_detected_at_utc, 'provided_label' AS model_classification
  FROM ladder WHERE provided_language_label <> ''
  UNION ALL
  SELECT {_PASSED}, CASE WHEN reason IS NULL THEN '["' || language || '"]' ELSE '[]' END,
    CASE WHEN reason IS NULL THEN language ELSE 'out_of_scope' END, '{RUN_TS}', 'fasttext'
  FROM ladder WHERE NOT batch AND provided_language_label = ''
  UNION ALL
  SELECT {_PASSED},
    CASE WHEN failed THEN '[]' WHEN length(text) > 3000 THEN '["french", "english"]' WHEN length(text) > 1000 THEN '["german"]' ELSE '[]' END,
    CASE WHEN NOT failed AND length(text) > 3000 THEN 'mixed_english_french' ELSE 'out_of_scope' END, '{RUN_TS}',
    CASE WHEN failed THEN 'gpt_error_fallback' ELSE '{MODEL}' END
  FROM answered)"""


@query("q_language_stage", with_std(f"SELECT {', '.join(LANGUAGE_COLUMNS)} FROM output", LID, LADDER, STAGE))
def stage(spark, sf):
    return stage_output(spark, sf)[0]


@query(
    "q_language_summary",
    with_std(
        long_sql(
            "m",
            {
                "input_rows": "n",
                "new_rows_processed": "n",
                "num_platforms": "p",
                "skipped_existing_rows": "0",
                "rows_sent_to_gpt": "c",
            },
            {
                "platform_distribution": "platform",
                "collection_method_distribution": "collection_method",
                "language_label_distribution": "language_label",
                "detector_distribution": "model_classification",
            },
            "output",
        ),
        LID,
        LADDER,
        STAGE,
        "m AS (SELECT (SELECT count(*) FROM output) AS n, (SELECT count(DISTINCT platform) FROM output) AS p, (SELECT count(*) FROM answered) AS c)",
    ),
)
def summary(spark, sf):
    rows = std(spark, sf)
    output, sent = stage_output(spark, sf)
    return language_summary(rows, rows, output, sent)


@query(
    "q_lang_response",
    with_std(
        """SELECT id, CASE platform WHEN 'reddit' THEN '["tagalog", "hiligaynon", "english"]' WHEN 'youtube' THEN '["english"]' ELSE '[]' END AS languages,
        CASE platform WHEN 'reddit' THEN 'mixed_english_tagalog_hiligaynon' ELSE 'out_of_scope' END AS language_label FROM std"""
    ),
)
def responses(spark, sf):
    """Answers with too many, unsupported, malformed and no languages, by platform."""
    rows = std(spark, sf).select("id", "platform", row_key().alias("row_id"))
    waiting = settle(assign_batches(rows, "row_id", BATCH))
    answer = (
        F.when(F.col("platform") == "reddit", '["tagalog","hiligaynon","english","cebuano"]')
        .when(F.col("platform") == "youtube", '["english","klingon"]')
        .when(F.col("platform") == "twitter", '"english"')
        .otherwise("[]")
    )
    item = F.concat(F.lit('{"row_id":"'), "row_id", F.lit('","language_detected":'), answer, F.lit("}"))
    replies = waiting.groupBy("batch_id").agg(F.array_join(F.collect_list(item), ",").alias("items")).select(
        "batch_id", F.lit("ok").alias("status"), F.concat(F.lit('{"results":['), "items", F.lit("]}")).alias("body")
    )
    joined = join_responses(waiting, replies)
    found, label = answered_languages(F.col("answer"), F.col("failed"))
    return joined.select("id", json_string_list(found).alias("languages"), label.alias("language_label"))
