"""Text, keys, dictionaries and prefilter."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import (
    FLAGGED,
    LEXICON_A,
    LEXICON_B,
    NOT_WORD,
    WORD,
    available_sql,
    fold_sql,
    lexicon_sql,
    query,
    std,
    table,
    texts,
    with_std,
)
from talkloom.functions.clock import epoch_to_iso
from talkloom.functions.keys import extraction_key, row_key
from talkloom.functions.text import clean_text, combine_title, match_form
from talkloom.operators.summaries import distribution
from talkloom.operators.terms import TermMatcher, distinct_terms, term_hits, terms_table, with_available_terms

CLEAN = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query("q_clean_text", f"SELECT doc_id, {CLEAN} AS text FROM documents")
def clean(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", clean_text("text").alias("text"))


@query(
    "q_remove_urls",
    r"""SELECT page_id,
      trim(regexp_replace(regexp_replace(html, 'https?://\S+|www\.\S+', ' ', 'gi'), '\s+', ' ', 'g')) AS html,
      trim(regexp_replace(regexp_replace('see ' || url || ' now', 'https?://\S+|www\.\S+', ' ', 'gi'), '\s+', ' ', 'g')) AS sentence
    FROM pages""",
)
def urls(spark, sf):
    sentence = F.concat(F.lit("see "), F.col("url"), F.lit(" now"))
    return texts(spark, sf, "pages", "page_id", "url", "html").select(
        "page_id", clean_text("html", remove_urls=True).alias("html"), clean_text(sentence, remove_urls=True).alias("sentence")
    )


@query("q_match_normalize", f"SELECT doc_id, {fold_sql(CLEAN)} AS folded FROM documents")
def normalize(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", match_form("text").alias("folded"))


@query("q_row_keys", with_std("SELECT doc_id, record_key, platform || '|' || id AS item_key FROM keyed"))
def keys(spark, sf):
    padded = F.concat(F.lit(" "), F.col("platform"), F.lit("\t"))
    return std(spark, sf).select("doc_id", row_key(padded).alias("record_key"), extraction_key(padded).alias("item_key"))


@query(
    "q_title_combine",
    f"""WITH t AS (SELECT doc_id, {CLEAN} AS body FROM documents),
    w AS (SELECT doc_id, body, CASE WHEN length(body) > 2000 THEN split_part(body, ' ', 1) || '#'
      ELSE split_part(body, ' ', 1) END AS title FROM t)
    SELECT doc_id, CASE WHEN title <> '' AND body <> '' AND NOT contains(body, title) THEN title || ' ' || body
      WHEN body <> '' THEN body ELSE title END AS text FROM w""",
)
def titles(spark, sf):
    body = texts(spark, sf, "documents", "doc_id", "text").select("doc_id", clean_text("text").alias("body"))
    word = F.substring_index("body", " ", 1)
    titled = body.withColumn("title", F.when(F.char_length("body") > 2000, F.concat(word, F.lit("#"))).otherwise(word))
    return titled.select("doc_id", combine_title("title", "body").alias("text"))


@query(
    "q_epoch_iso",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS created_at_utc, '' AS broken FROM events""",
)
def epochs(spark, sf):
    # Fractional seconds as text, the way a payload carries them.
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(20,0)")).cast("string")
    return texts(spark, sf, "events", "event_id", "event_type", "ts").select(
        "event_id", epoch_to_iso(seconds).alias("created_at_utc"), epoch_to_iso(F.concat("event_type", seconds)).alias("broken")
    )


# ---- prefilter -------------------------------------------------------------


@query(
    "q_prefilter_driver",
    with_std(f"SELECT doc_id, {available_sql('a', 'b')} AS available_terms FROM flagged", FLAGGED),
)
def prefilter(spark, sf):
    matcher = TermMatcher.build(LEXICON_A, LEXICON_B)
    return with_available_terms(std(spark, sf), matcher).select("doc_id", "available_terms")


@query(
    "q_prefilter_substring",
    with_std(
        f"""SELECT doc_id, {available_sql(f"regexp_matches(text, '{lexicon_sql(LEXICON_A, False)}')",
                                          f"regexp_matches(text, '{lexicon_sql(LEXICON_B, False)}')")} AS available_terms FROM std"""
    ),
)
def substring(spark, sf):
    matcher = TermMatcher.build(LEXICON_A, LEXICON_B, case_sensitive=True, word_boundaries=False)
    return with_available_terms(std(spark, sf), matcher).select("doc_id", "available_terms")


def benchmark_dictionary(spark, sf):
    """A dictionary that comes as a table: first words of benchmark items, open-ended, as one
    group, their last words as the other."""
    words = table(spark, sf, "benchmark").select(
        F.split(F.trim(F.lower(F.regexp_replace("text", r"[^\p{L}]+", " "))), " ").alias("w")
    )
    first = words.select(F.lit("ai_terms").alias("group"), F.lit("").alias("language"), F.concat(F.element_at("w", 1), F.lit("*")).alias("term"))
    last = words.select(F.lit("health_terms").alias("group"), F.lit("").alias("language"), F.element_at("w", -1).alias("term"))
    return first.unionByName(last)


# Terms are folded like the texts they are looked up in.
DICTIONARY = r"""words AS (SELECT string_split(trim(lower(regexp_replace(text, '[^\p{L}]+', ' ', 'g'))), ' ') AS w FROM benchmark),
terms AS (SELECT DISTINCT 'ai_terms' AS grp, replace(w[1], 'ß', 'ss') AS stem, w[1] || '*' AS term FROM words
  UNION SELECT DISTINCT 'health_terms', replace(w[len(w)], 'ß', 'ss'), w[len(w)] FROM words)"""
_PATTERNS = (
    "patterns AS (SELECT "
    f"'(^|{NOT_WORD})(' || (SELECT string_agg(stem, '|') FROM terms WHERE grp = 'ai_terms') || '){WORD[:-1]}-]*($|{NOT_WORD})' AS pa, "
    f"'(^|{NOT_WORD})(' || (SELECT string_agg(stem, '|') FROM terms WHERE grp = 'health_terms') || ')($|{NOT_WORD})' AS pb)"
)


@query(
    "q_prefilter_dictionary",
    with_std(
        f"SELECT doc_id, {available_sql('a', 'b')} AS available_terms FROM "
        f"(SELECT doc_id, regexp_matches({fold_sql('text')}, pa) AS a, regexp_matches({fold_sql('text')}, pb) AS b FROM std, patterns)",
        DICTIONARY,
        _PATTERNS,
    ),
)
def prefilter_dictionary(spark, sf):
    matcher = TermMatcher.from_table(benchmark_dictionary(spark, sf))
    return with_available_terms(std(spark, sf), matcher).select("doc_id", "available_terms")


@query("q_terms_flat", f'WITH {DICTIONARY} SELECT grp AS "group", term FROM terms')
def flat(spark, sf):
    terms = benchmark_dictionary(spark, sf)
    parts = [distinct_terms(terms, g).select(F.lit(g).alias("group"), "term") for g in ("ai_terms", "health_terms")]
    return parts[0].unionByName(parts[1])


# One constant pattern per term: a pattern that varies per row is compiled per row.
_LEXICON_HITS = " UNION ALL ".join(
    f"""SELECT '{g}' AS "group", '{t}' AS term, count(*) AS n_rows, min(doc_id) AS first_doc FROM folded
    WHERE regexp_matches(f, '{lexicon_sql([t])}') HAVING count(*) > 0"""
    for g, ts in (("a", LEXICON_A), ("b", LEXICON_B))
    for t in (*ts, "the er")
)


@query("q_term_hits", with_std(_LEXICON_HITS, f"folded AS (SELECT doc_id, {fold_sql('text')} AS f FROM std)"))
def hits(spark, sf):
    terms = terms_table(spark, {"a": [*LEXICON_A, "the er"], "b": [*LEXICON_B, "the er"]})
    found = term_hits(std(spark, sf), "doc_id", terms)
    return found.groupBy("group", "term").agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_doc"))


@query(
    "q_dictionary_hits",
    with_std(
        f"""SELECT grp AS "group", term, count(DISTINCT doc_id) AS n_rows FROM
        (SELECT DISTINCT doc_id, unnest(regexp_extract_all({fold_sql('text')}, '{WORD}+')) AS word FROM std)
        JOIN terms ON CASE WHEN grp = 'ai_terms' THEN starts_with(word, stem) ELSE word = stem END GROUP BY ALL""",
        DICTIONARY,
    ),
)
def dictionary_hits(spark, sf):
    found = term_hits(std(spark, sf), "doc_id", benchmark_dictionary(spark, sf))
    return found.groupBy("group", "term").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "q_prefilter_spread",
    with_std(
        f"""SELECT platform, {available_sql('a', 'b')} AS available_terms, count(*) AS n_rows FROM flagged GROUP BY ALL""",
        FLAGGED,
    ),
)
def prefilter_spread(spark, sf):
    """Flagship: clean, fold, prefilter with two dictionaries, distribution by platform."""
    matcher = TermMatcher.build(LEXICON_A, LEXICON_B)
    found = with_available_terms(std(spark, sf), matcher)
    return found.groupBy("platform", "available_terms").agg(F.count(F.lit(1)).alias("n_rows"))


@query("q_platform_distribution", with_std('SELECT platform, count(*) AS "count" FROM std GROUP BY platform'))
def platforms(spark, sf):
    return distribution(std(spark, sf), "platform")
