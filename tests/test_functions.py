import json
import unicodedata
from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from talkloom.functions.clock import epoch_to_iso, iso_utc, run_id_for
from talkloom.functions.cost import estimated_tokens, usage_fields
from talkloom.functions.jsontext import (
    json_field,
    json_field_or_blank,
    json_list,
    json_string,
    json_string_list,
    parse_json,
    spaced_json,
)
from talkloom.functions.keys import extraction_key, row_key
from talkloom.functions.languages import language_label
from talkloom.functions.text import (
    CONTROL_CHARS,
    clean_text,
    combine_title,
    first_filled,
    first_filled_stripped,
    match_form,
    strip,
)


def column(spark, values, expr, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def python_clean(text):
    text = unicodedata.normalize("NFKC", text)
    text = "".join(" " if c in CONTROL_CHARS else c for c in text)
    return " ".join(text.split())


@pytest.mark.parametrize(
    "text, expected",
    [
        ("  AI\x00\n healthcare\t\ttext  ", "AI healthcare text"),
        (None, ""),
        ("ﬁne ①\xa0x　y\x85z ", "fine 1 x y z"),
        ("​ a", "​ a"),
        ("\x1c\x1fa\x7fb", "a b"),
    ],
)
def test_clean_text(spark, text, expected):
    assert column(spark, [text], clean_text) == [expected]


def test_clean_text_removes_urls(spark):
    texts = ["see https://example.com now", "WWW.X.org/a?b=c, end", "a http:// b", "xhttps://q　r www."]
    got = column(spark, texts, lambda c: clean_text(c, remove_urls=True))
    assert got == ["see now", "end", "a http:// b", "x r www."]


def test_match_form_folds_case(spark):
    assert column(spark, ["Artificial Intelligence", "Stra\xdfe", "Σας"], match_form) == [
        "artificial intelligence",
        "strasse",
        "σασ",
    ]
    assert column(spark, ["Ab  C"], lambda c: match_form(c, case_sensitive=True)) == ["Ab C"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=40), min_size=20, max_size=60))
def test_clean_and_fold_agree_with_python(spark, texts):
    # Letters newer than one side's Unicode tables would differ, hence no unassigned ones.
    assert column(spark, texts, clean_text) == [python_clean(t) for t in texts]
    assert column(spark, texts, match_form) == [python_clean(t).casefold() for t in texts]
    assert column(spark, texts, strip) == [t.strip() for t in texts]
    assert column(spark, texts, json_string) == [json.dumps(t, ensure_ascii=False) for t in texts]


def test_keys(spark):
    df = spark.createDataFrame([(" reddit ", " abc123 ")], "platform string, id string")
    assert df.select(extraction_key()).first()[0] == "reddit|abc123"
    df = spark.createDataFrame(
        [("youtube", "comment", "c1", "v1"), ("twitter", "post", "1", "1"), (None, None, "x　", None)],
        "platform string, category string, id string, associated_id string",
    )
    assert [r[0] for r in df.select(row_key()).collect()] == ["youtube|comment|c1|v1", "twitter|post|1|1", "||x|"]


def test_alias_lookup_orders_of_strip_and_test(spark):
    df = spark.createDataFrame([("  ", "b"), ("", " b "), (None, None)], "a string, b string")
    assert [tuple(r) for r in df.select(first_filled("a", "b"), first_filled_stripped("a", "b")).collect()] == [
        ("", "b"),
        ("b", "b"),
        ("", ""),
    ]


def test_combine_title(spark):
    df = spark.createDataFrame(
        [("AI health", "Main body"), ("body", "Main body"), ("Body", "Main body"), ("", "b"), ("t", "")], "t string, b string"
    )
    assert [r[0] for r in df.select(combine_title("t", "b")).collect()] == [
        "AI health Main body",
        "Main body",
        "Body Main body",
        "b",
        "t",
    ]


def test_times(spark):
    moment = datetime(2026, 5, 24, 1, 2, 3, tzinfo=timezone.utc)
    assert iso_utc(moment) == "2026-05-24T01:02:03Z"
    assert run_id_for(moment) == "20260524T010203Z"
    values = ["1778839239", "1778839239.9", "abc", "", None, "-1.5", "NaN", "Infinity", "1e300"]
    assert column(spark, values, epoch_to_iso) == [
        "2026-05-15T10:00:39Z",
        "2026-05-15T10:00:39Z",
        "",
        "",
        "",
        "1969-12-31T23:59:58Z",
        "",
        "",
        "",
    ]


def test_json_scalars_follow_truthiness(spark):
    values = ["7", "0", "1.5", '"0"', '"x"', "true", "false", "null", "[]", "{}", '""', '"false"', '"[]"']
    docs = ['{"id": %s}' % v for v in values] + ["{}"]
    assert column(spark, docs, lambda c: json_field_or_blank(parse_json(c), "$.id")) == [
        "7", "", "1.5", "0", "x", "True", "", "", "", "", "", "false", "[]", "",
    ]
    assert column(spark, docs, lambda c: json_field(parse_json(c), "$.id")) == [
        "7", "0", "1.5", "0", "x", "True", "False", "", "[]", "{}", "", "false", "[]", "",
    ]


def test_lists_are_told_from_other_json(spark):
    docs = ["[1,2]", "{}", "null", "5", "[bad", "", None]
    size = column(spark, docs, lambda c: F.size(json_list(parse_json(c, "[]"))))
    assert size == [2, None, None, None, None, 0, 0] or size == [2, -1, -1, -1, -1, 0, 0]


def test_repeated_object_key_keeps_the_last(spark):
    assert column(spark, ['{"id":"a","id":"b"}'], lambda c: json_field(parse_json(c), "$.id")) == ["b"]


def test_spaced_json_matches_python(spark):
    values = [
        {"like": 3, "love": [1, {"b": 2, "a": "x,y:z"}]},
        ["a,b", "c\"d\\,e:", ""],
        {"k:1": "v,", "n": None, "t": True},
        "plain, text: here",
        12,
    ]
    texts = [json.dumps(v, ensure_ascii=False) for v in values]
    expected = [json.dumps(v, ensure_ascii=False, sort_keys=True) for v in values]
    assert column(spark, texts, lambda c: spaced_json(parse_json(c))) == expected


def test_string_list_as_json(spark):
    got = column(spark, [["cebuano"], [], ["a\"b", "c"]], json_string_list, "array<string>")
    assert got == ['["cebuano"]', "[]", '["a\\"b", "c"]']


def test_usage_aliases(spark):
    payloads = [
        '{"usage": {"prompt_tokens": 100, "completion_tokens": 25, "prompt_tokens_details": {"cached_tokens": 40}}}',
        '{"input_tokens": 7, "output_tokens": 3, "input_tokens_details": {"cached_tokens": 2}}',
        '{"usage": {"input_tokens": null, "prompt_tokens": 9}}',
        "broken",
        None,
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string")
    fields = usage_fields("p")
    got = [tuple(r) for r in df.orderBy("i").select(*fields.values()).collect()]
    assert got == [(100, 40, 25), (7, 2, 3), (0, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_token_estimate(spark):
    assert column(spark, ["", "abc", "abcdefgh", None], estimated_tokens) == [0, 1, 2, 0]


def test_language_labels(spark):
    lists = [[], ["english"], ["tagalog", "english"], ["hiligaynon", "ilocano", "cebuano", "tagalog"], ["klingon"]]
    assert column(spark, lists, language_label, "array<string>") == [
        "out_of_scope",
        "english",
        "mixed_english_tagalog",
        "mixed_tagalog_cebuano_ilocano",
        "out_of_scope",
    ]
