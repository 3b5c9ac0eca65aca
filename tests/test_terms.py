import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from talkloom.operators.terms import (
    TermMatcher,
    distinct_terms,
    group_pattern,
    has_match,
    normalize_term,
    read_dictionary,
    term_hits,
    terms_table,
    with_available_terms,
)
from tests.conftest import rows_of

A, B = ["ai", "machine learning"], ["health", "diagnosis"]


def classify(spark, texts, matcher):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.available_terms for r in with_available_terms(df, matcher).orderBy("i").collect()]


@pytest.mark.parametrize(
    "text, a, b, expected",
    [
        ("AI could help diagnosis workflows.", A, B, "with_ai_and_health_terms"),
        ("machine learning system", A, B, "with_ai_term_only"),
        ("community health program", A, B, "with_health_term_only"),
        ("plain words only", A, B, "no_valid_terms"),
        ("Chatbots for diagnosis", ["chatbot*"], ["diagnos*"], "with_ai_and_health_terms"),
        ("aié", ["ai"], B, "no_valid_terms"),
        ("MACHINE \n LEARNING", A, B, "with_ai_term_only"),
        ("x", [], [], "no_valid_terms"),
        (None, A, B, "no_valid_terms"),
        ("self-ai, pet/ct", ["ai"], ["pet/ct"], "with_ai_and_health_terms"),
    ],
)
def test_four_way_label(spark, text, a, b, expected):
    assert classify(spark, [text], TermMatcher.build(a, b)) == [expected]


def test_alternative_modes(spark):
    assert classify(spark, ["plain"], TermMatcher.build(A, B, word_boundaries=False)) == ["with_ai_term_only"]
    matcher = TermMatcher.build(["AI"], B, case_sensitive=True)
    assert classify(spark, ["ai", "AI"], matcher) == ["no_valid_terms", "with_ai_term_only"]


def reference_pattern(term, boundaries=True):
    escaped = r"[\w-]*".join(re.escape(p) for p in term.split("*"))
    return rf"(?<!\w){escaped}(?!\w)" if boundaries else escaped


TERMS = ["ai", "ai-*", "a.i*", "ai model*", "model", "é*", "b*c", "x/y", "c++", "ai ai"]
PIECES = ["ai", "a", "i", "-", ".", " ", "model", "s", "é", "b", "c", "_", "x/y", "+", "9", "ß", "٣"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), min_size=30, max_size=60))
def test_patterns_and_hits_agree_with_one_regex_per_term(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    folded = [" ".join(unicodedata.normalize("NFKC", t).split()).casefold() for t in texts]
    for boundaries in (True, False):
        wanted = [any(re.search(reference_pattern(t, boundaries), x) for t in TERMS) for x in folded]
        pattern = group_pattern(TERMS, word_boundaries=boundaries)
        folded_df = spark.createDataFrame(list(enumerate(folded)), "i int, t string")
        got = [r.m for r in folded_df.select("i", has_match(F.col("t"), pattern).alias("m")).orderBy("i").collect()]
        assert got == wanted
    expected = sorted(
        ("g", t, i) for i, x in enumerate(folded) for t in TERMS if re.search(reference_pattern(normalize_term(t)), x)
    )
    hits = term_hits(df, "i", terms_table(spark, {"g": TERMS}))
    assert rows_of(hits, "group", "term", "i") == expected


def test_hits_need_no_expression_per_length_of_a_term(spark):
    df = spark.createDataFrame([(1, "abcdefghijklmnopqrst xabc"), (2, "abcde fghij")], "i int, text string")
    terms = ["abcdefghijklmnopqrst"[:k] + "*" for k in range(1, 21)]
    hits = term_hits(df, "i", terms_table(spark, {"g": terms}))
    # Past 8,000 bytes of code per method the JVM interprets it.
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("substr") < 20
    assert rows_of(hits) == sorted([("g", t, 1) for t in terms] + [("g", t, 2) for t in terms[:5]])


def test_dictionary_forms(spark, tmp_path):
    table = terms_table(spark, {"ai_terms": {"english": ["ai", " gpt "], "cebuano": ["ai", "modelo", None]}, "other": ["x"]})
    assert rows_of(table) == [
        ("ai_terms", "cebuano", "ai"),
        ("ai_terms", "cebuano", "modelo"),
        ("ai_terms", "english", "ai"),
        ("ai_terms", "english", "gpt"),
        ("other", "", "x"),
    ]
    assert rows_of(distinct_terms(table, "ai_terms")) == [("ai",), ("gpt",), ("modelo",)]
    path = tmp_path / "terms.json"
    path.write_text('{"ai_terms": {"english": ["ai"]}, "health_terms": ["health*"]}', encoding="utf-8")
    matcher = TermMatcher.from_table(terms_table(spark, read_dictionary(str(path))))
    assert classify(spark, ["AI healthcare"], matcher) == ["with_ai_and_health_terms"]
