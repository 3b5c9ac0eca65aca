import json

from talkloom.operators.standardize import standardize, standardize_counts, with_row_ord
from talkloom.plans.extraction import conform_extraction
from talkloom.schemas import EXTRACTION
from tests.conftest import metrics_of


def raw(spark, *rows):
    base = {f: "" for f in EXTRACTION.fieldNames()}
    data = [(i, *[({**base, **r})[f] for f in EXTRACTION.fieldNames()]) for i, r in enumerate(rows)]
    schema = "n bigint, " + ", ".join(f"{f} string" for f in EXTRACTION.fieldNames())
    return with_row_ord(spark.createDataFrame(data, schema), ["n"]).drop("n")


def result(spark, *rows):
    df = raw(spark, *rows)
    out = [r.asDict() for r in standardize(df).orderBy("row_ord").collect()]
    return out, metrics_of(standardize_counts(df))


def test_explodes_post_comment_reply(spark):
    comments = [
        {
            "id": "c1",
            "text": "Comment",
            "url": "https://c1",
            "replies": [{"id": "r1", "text": "Reply", "provided_language_label": "tagalog"}],
        }
    ]
    rows, stats = result(
        spark,
        {
            "platform": "reddit",
            "id": "p1",
            "title": "AI health",
            "text": "Main body",
            "url": "https://p1",
            "comments_json": json.dumps(comments),
        },
    )
    assert [(r["category"], r["id"], r["text"], r["associated_id"], r["source_url"]) for r in rows] == [
        ("post", "p1", "AI health Main body", "p1", "https://p1"),
        ("comment", "c1", "Comment", "p1", "https://c1"),
        ("reply", "r1", "Reply", "p1", "https://p1"),
    ]
    assert [r["provided_language_label"] for r in rows] == ["", "", "tagalog"]
    assert stats[("comments_exploded", "")] == 1 and stats[("replies_exploded", "")] == 1


def test_first_wins(spark):
    rows, stats = result(
        spark,
        {"platform": "reddit", "id": "p1", "text": "x", "collection_method": "targeted_id"},
        {"platform": "reddit", "id": "p1", "text": "y", "collection_method": "keyword"},
    )
    assert [(r["collection_method"], r["text"]) for r in rows] == [("targeted_id", "x")]
    assert stats[("deduplicated_rows", "")] == 1 and stats[("input_rows", "")] == 2


def test_damaged_comment_lists(spark):
    bodies = ["[bad", "{}", "null", "5", '[1,{"id":"c"},{"id":"d","text":"ok"}]', "", '"text"']
    rows, stats = result(
        spark,
        *[{"platform": "x", "id": f"p{i}", "text": "t", "comments_json": b} for i, b in enumerate(bodies)],
    )
    assert stats[("invalid_comments_json_rows", "")] == 4
    assert stats[("dropped_empty_text_rows", "")] == 1
    assert [r["id"] for r in rows if r["category"] == "comment"] == ["d"]
    assert stats[("output_rows", "")] == 8


def test_dropped_root_keeps_its_comments(spark):
    rows, stats = result(
        spark,
        {"platform": "youtube", "id": "v", "comments_json": '[{"id":"c","text":"good"}]'},
        {"platform": "youtube", "id": "w", "text": "t", "comments_json": '[{"id":0,"text":"x"},{"id":7,"text":false}]'},
    )
    assert [(r["category"], r["id"], r["text"]) for r in rows] == [
        ("comment", "c", "good"),
        ("video", "w", "t"),
        ("comment", "7", "False"),
    ]
    assert stats[("dropped_empty_text_rows", "")] == 2


def test_label_and_url_inheritance(spark):
    comments = [
        {
            "id": "c",
            "text": "x",
            "provided_classification_label": "own",
            "replies": [{"id": "r", "text": "y"}, 5, {"id": "s", "text": "z", "replies": "no list"}],
        },
        {"id": "e", "text": "w", "replies": {"id": "lost", "text": "lost"}},
    ]
    rows, _ = result(
        spark,
        {
            "platform": "reddit",
            "id": "p",
            "text": "root",
            "url": "u",
            "provided_classification_label": "root label",
            "comments_json": json.dumps(comments),
        },
    )
    assert [(r["id"], r["provided_classification_label"], r["source_url"]) for r in rows] == [
        ("p", "root label", "u"),
        ("c", "own", "u"),
        ("r", "root label", "u"),
        ("s", "root label", "u"),
        ("e", "root label", "u"),
    ]
    assert [r["row_ord"] for r in rows] == [[0, -1, -1], [0, 0, -1], [0, 0, 0], [0, 0, 1], [0, 1, -1]]


def test_many_copies_of_one_key_keep_the_first(spark):
    df = spark.range(20000).selectExpr(
        "'reddit' platform", "'m' collection_method", "case when id % 3 = 0 then 'hot' else concat('p', id) end id",
        "concat('text ', id) text", "'' title", "'' author", "'' created_at_utc", "'' url", "'[]' comments_json",
        "'{}' metadata_json", "'' provided_language_label", "'' provided_classification_label", "'' extracted_at_utc",
        "array(id) row_ord",
    )
    out = standardize(df)
    assert out.count() == 20000 - 6667 + 1
    assert out.filter("id = 'hot'").first()["text"] == "text 0"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_conform_fills_json_columns(spark):
    df = spark.createDataFrame([("reddit", "1", "", None)], "platform string, id string, comments_json string, metadata_json string")
    row = conform_extraction(df).first()
    assert (row.comments_json, row.metadata_json, row.text) == ("[]", "{}", "")
