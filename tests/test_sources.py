import csv
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from talkloom.operators.standardize import standardize
from talkloom.plans.extraction import attach_comments, run_extraction, run_upload, select_new_rows
from talkloom.plans.store import read_master
from talkloom.schemas import EXTRACTION
from talkloom.sources.jobs import build_jobs
from talkloom.sources.payloads import (
    REDDIT_COMMENTS,
    REDDIT_POST,
    REGISTRY,
    TWEET,
    TWEETS,
    YOUTUBE_THREADS,
    YOUTUBE_VIDEO,
    first_results,
    keyword_videos,
    land_comments,
    land_payloads,
    reddit_comments,
    reddit_posts,
    tag_keyword,
    tweets,
    twitter_comments,
    youtube_comments,
    youtube_videos,
)
from talkloom.sources.tables import read_value_file
from talkloom.sources.uploads import list_files, read_records, upload_counts, upload_items, upload_rows
from tests.conftest import RUN_TS, metrics_of, rows_of


def python_hash(value):
    text = json.dumps(value, ensure_ascii=False, sort_keys=True)
    return hashlib.sha1(text.encode()).hexdigest()[:12]


def write_csv(path, fields, rows, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as handle:
        writer = csv.DictWriter(handle, fieldnames=fields)
        writer.writeheader()
        writer.writerows(rows)


def upload(spark, folder):
    items = upload_items(read_records(spark, str(folder)))
    return upload_rows(items, RUN_TS), metrics_of(upload_counts(items, list_files(spark, str(folder))))


# ---- uploads ---------------------------------------------------------------


def test_flat_and_json_uploads(spark, tmp_path):
    write_csv(
        tmp_path / "manual01.csv",
        ["source_platform", "text", "url"],
        [
            {"source_platform": "facebook", "text": "AI health text", "url": "https://example.test/a"},
            {"source_platform": "facebook", "text": "  ", "url": ""},
            {"source_platform": "", "text": 'multi\nline "quoted" ', "url": ""},
        ],
        encoding="utf-8-sig",
    )
    item = {
        "post_id": "p1",
        "url": "https://facebook.test/p1",
        "message": "ChatGPT doctor post",
        "timestamp": 1778839239,
        "author": {"name": "Example Author", "id": 12},
        "reactions": {"like": 3, "a:b": "x,y"},
        "comments_count": 0,
        "type": "",
    }
    fields = ["platform", "query", "json", "collection_method", "text"]
    cells = [
        json.dumps({"results": [item]}),
        "[broken",
        json.dumps({"results": {"no": "list"}}),
        json.dumps([1]),
        json.dumps({"results": [5, {"message": " "}, {"message_rich": "rich", "id": 7}, {"message": "m", "score": 1.0}]}),
        "",
    ]
    write_csv(
        tmp_path / "manual04.csv",
        fields,
        [{"platform": "facebook", "query": "ai q", "json": c, "collection_method": "scraper" if i == 0 else "", "text": "flat" if c == "" else ""} for i, c in enumerate(cells)],
    )
    write_csv(tmp_path / "no \u00e9%20ne.csv", ["text"], [])
    write_csv(tmp_path / "a b.csv", ["text", "id"], [{"text": "q", "id": "q"}])
    (tmp_path / "zero.csv").write_text("", encoding="utf-8")
    rows, stats = upload(spark, tmp_path)
    got = {(r.file_name, r.record_no, r.result_index): r for r in rows.collect()}
    assert sorted(got) == [
        ("a b.csv", 2, 0), ("manual01.csv", 2, 0), ("manual01.csv", 4, 0), ("manual04.csv", 2, 1), ("manual04.csv", 6, 3), ("manual04.csv", 6, 4), ("manual04.csv", 7, 0),
    ]
    flat = got[("manual01.csv", 2, 0)]
    digest = python_hash({"source_platform": "facebook", "text": "AI health text", "url": "https://example.test/a"})
    assert (flat.platform, flat.collection_method, flat.id) == ("facebook", "manual_upload", f"manual01_00002_{digest}")
    assert json.loads(flat.metadata_json) == {
        "original_columns": {"source_platform": "facebook", "text": "AI health text", "url": "https://example.test/a"},
        "source_file": "manual01.csv",
        "source_row_number": 2,
    }
    assert got[("manual01.csv", 4, 0)].text == 'multi\nline "quoted"' and got[("manual01.csv", 4, 0)].platform == "manual"
    first = got[("manual04.csv", 2, 1)]
    assert (first.id, first.author, first.created_at_utc, first.collection_method) == ("p1", "Example Author", "2026-05-15T10:00:39Z", "scraper")
    expected = {
        "author_id": 12,
        "comments_count": 0,
        "query": "ai q",
        "reactions": {"a:b": "x,y", "like": 3},
        "result_index": 1,
        "source_file": "manual04.csv",
        "source_row_number": 2,
    }
    assert first.metadata_json == json.dumps(expected, sort_keys=True)
    rich = got[("manual04.csv", 6, 3)]
    assert (rich.id, rich.text, rich.collection_method) == ("7", "rich", "manual_upload_json")
    assert got[("manual04.csv", 6, 4)].id == "manual04_00006_" + python_hash({"message": "m", "score": 1.0})
    assert got[("manual04.csv", 7, 0)].collection_method == "manual_upload"
    assert {k[0]: v for k, v in stats.items() if k[1] == ""} == {
        "input_files": 5, "input_rows": 10, "output_rows": 7, "skipped_empty_text_rows": 2, "invalid_json_rows": 2, "json_results_extracted": 3,
    }
    assert {k[1]: v for k, v in stats.items() if k[0] == "rows_by_file"} == {
        "a b.csv": 1, "manual01.csv": 2, "manual04.csv": 4, "no \u00e9%20ne.csv": 0, "zero.csv": 0,
    }


def test_duplicate_ids_are_numbered(spark, tmp_path):
    one, two = {"source": "fb", "text": "a", "id": "x"}, {"source": "fb", "text": "b", "id": "x"}
    other = {"platform": "ig", "text": "c", "post_id": " x "}
    third = {"platform": "fb", "text": "d", "post_id": "x"}
    write_csv(tmp_path / "a.csv", ["source", "text", "id"], [one, two])
    write_csv(tmp_path / "b.csv", ["platform", "text", "post_id"], [other, third])
    rows, _ = upload(spark, tmp_path)
    assert rows_of(rows, "text", "platform", "id") == [
        ("a", "fb", "x"),
        ("b", "fb", f"x__manual_00003_{python_hash(two)}"),
        ("c", "ig", "x"),
        ("d", "fb", f"x__manual_00003_{python_hash(third)}"),
    ]


def test_record_numbers_over_many_files(spark, tmp_path):
    for name in range(12):
        write_csv(tmp_path / f"f{name:02d}.csv", ["text", "id"], [{"text": f"t\n{i}", "id": f"{name}-{i}"} for i in range(100 + name)])
    rows, stats = upload(spark, tmp_path)
    assert all(r.record_no == int(r.id.split("-")[1]) + 2 for r in rows.collect())
    assert stats[("input_rows", "")] == sum(100 + n for n in range(12))


def test_text_after_a_payload_makes_it_invalid(spark, tmp_path):
    good = json.dumps({"results": [{"post_id": "p1", "message": "m"}]})
    cells = [good, good + " x", good + "}", "{} {}", "[1]", "{}", '{"results": 3}', good + "\n"]
    write_csv(tmp_path / "cells.csv", ["source_platform", "json"], [{"source_platform": "forum", "json": c} for c in cells])
    rows, stats = upload(spark, tmp_path)
    got = rows.collect()
    assert [r.text for r in got] == ["m", "m"] and all(r.id for r in got)
    assert {k[0]: v for k, v in stats.items() if k[1] == ""} == {
        "input_files": 1, "input_rows": 8, "output_rows": 2, "skipped_empty_text_rows": 0, "invalid_json_rows": 4, "json_results_extracted": 2,
    }


def test_upload_run_keeps_labels_through_standardization(spark, store, tmp_path):
    folder = tmp_path / "up"
    folder.mkdir()
    write_csv(
        folder / "manual03.csv",
        ["source", "text", "url", "provided_language_label"],
        [{"source": "facebook", "text": "AI tambal", "url": "https://example.test/a", "provided_language_label": "cebuano"}],
    )
    stats = metrics_of(run_upload(spark, store, "manual-test", RUN_TS, str(folder)))
    assert stats[("output_rows", "")] == 1
    for path in (f"{store.root}/manual/manual_extraction_raw", store.snapshot("manual", "manual-test", "manual_extraction_raw")):
        row = standardize(spark.read.parquet(path)).first()
        assert (row.provided_language_label, row.platform, row.source_url) == ("cebuano", "facebook", "https://example.test/a")
    assert spark.read.json(f"{store.root}/manual/manual_extraction_raw_summary").count() == spark.read.json(
        store.snapshot("manual", "manual-test", "summary")
    ).count()


# ---- jobs ------------------------------------------------------------------


def test_jobs(spark, tmp_path):
    for name, text in {"reddit_ids": "ids\nabc\nabd\n", "youtube_ids": "id\n", "subreddits": "subreddit\nPhilippines\nph2\n", "keywords": "keyword\nmedical AI\nother\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    read = lambda name, *columns: read_value_file(spark, str(tmp_path / f"{name}.csv"), *columns)
    ids = {p: read(f"{p}_ids", "id", "ids") for p in ("reddit", "youtube", "twitter")}
    jobs = build_jobs(ids, read("subreddits", "subreddit"), read("keywords", "keyword"), {"twitter": False})
    ordered = jobs.orderBy("platform", "job_ord").collect()
    assert [(r.platform, r.collection_method, r.ids, r.subreddit, r.keyword) for r in ordered] == [
        ("reddit", "targeted_id", ["abc", "abd"], None, None),
        ("reddit", "subreddit_keyword", None, "Philippines", "medical AI"),
        ("reddit", "subreddit_keyword", None, "Philippines", "other"),
        ("reddit", "subreddit_keyword", None, "ph2", "medical AI"),
        ("reddit", "subreddit_keyword", None, "ph2", "other"),
        ("reddit", "keyword", None, None, "medical AI"),
        ("reddit", "keyword", None, None, "other"),
        ("youtube", "keyword", None, None, "medical AI"),
        ("youtube", "keyword", None, None, "other"),
    ]
    assert (ordered[0].limit, ordered[1].limit, ordered[1].comment_limit, ordered[1].include_comments) == (None, 100, 500, True)
    long = build_jobs({"reddit": ids["reddit"]}, read("x", "subreddit"), read("x", "keyword"), ids_per_row=1)
    assert sorted(r.ids[0] for r in long.collect()) == ["abc", "abd"] and long.filter("part = 0").count() == 1


# ---- payloads --------------------------------------------------------------


def landed(spark, tmp_path, name, schema, *items):
    path = tmp_path / f"{name}.json"
    path.write_text("\n".join(json.dumps(i) for i in items), encoding="utf-8")
    return spark.read.schema(schema).json(str(path))


def test_reddit_payloads(spark, tmp_path):
    posts = landed(
        spark, tmp_path, "p", REDDIT_POST,
        {"id": "a", "selftext": "body", "title": "t", "author": "u", "created_utc": 1778839239.7, "permalink": "/r/x/a", "subreddit": "x", "score": 5, "upvote_ratio": 0.97},
        {"id": "b"},
    )
    rows = {r.id: r for r in reddit_posts(posts, RUN_TS).collect()}
    a = rows["a"]
    assert (a.platform, a.collection_method, a.text, a.title, a.created_at_utc, a.url) == (
        "reddit", "targeted_id", "body", "t", "2026-05-15T10:00:39Z", "https://www.reddit.com/r/x/a",
    )
    assert a.metadata_json == json.dumps({"subreddit": "x", "score": 5, "upvote_ratio": 0.97})
    assert (rows["b"].metadata_json, rows["b"].comments_json, rows["b"].extracted_at_utc) == (
        json.dumps({"subreddit": "", "score": "", "upvote_ratio": ""}), "[]", RUN_TS,
    )
    searched = posts.withColumns({"collection_method": F.lit("keyword"), "query": F.lit('q"1')})
    found = {r.id: json.loads(r.metadata_json) for r in reddit_posts(searched, RUN_TS).collect()}
    assert found["b"]["subreddit"] == "all" and found["a"] == {"subreddit": "x", "query": 'q"1', "score": 5, "upvote_ratio": 0.97}
    threads = landed(
        spark, tmp_path, "c", REDDIT_COMMENTS,
        {"source_id": "a", "comments": [{"id": "c1", "body": 'x "y"', "author": "v", "created_utc": 0, "permalink": "/c1"}, {"id": "c2"}, {"id": "c3"}]},
        {"source_id": "b"},
    )
    lists = {r.source_id: json.loads(r.comments_json) for r in reddit_comments(threads, 2).collect()}
    assert lists["b"] == [] and [c["id"] for c in lists["a"]] == ["c1", "c2"]
    assert lists["a"][0] == {
        "id": "c1", "text": 'x "y"', "author": "v", "created_at_utc": "1970-01-01T00:00:00Z", "url": "https://www.reddit.com/c1", "replies": [],
    }


def test_youtube_payloads(spark, tmp_path):
    videos = landed(
        spark, tmp_path, "v", YOUTUBE_VIDEO,
        {"id": "v1", "snippet": {"description": "d", "title": "t", "channelTitle": "ch", "channelId": "cid", "publishedAt": "2026-01-01T00:00:00Z"}, "statistics": {"viewCount": "10"}},
    )
    row = youtube_videos(videos, RUN_TS).first()
    assert (row.text, row.author, row.url) == ("d", "ch", "https://www.youtube.com/watch?v=v1")
    assert row.metadata_json == json.dumps({"channel_id": "cid", "view_count": "10", "like_count": ""})
    hits = spark.createDataFrame([("v1", "q1", [0], 0), ("gone", "q1", [0], 1)], "id string, query string, job_ord array<bigint>, pos bigint")
    found = keyword_videos(hits, videos, RUN_TS).collect()
    assert [(r.id, r.collection_method, json.loads(r.metadata_json)["query"]) for r in found] == [("v1", "keyword", "q1")]
    bags = spark.createDataFrame([("a", '{"x": 1, "query": "old"}'), ("b", "[1]"), ("c", "bad")], "id string, metadata_json string")
    tagged = tag_keyword(bags, F.lit("new"))
    assert rows_of(tagged, "id", "metadata_json", "collection_method") == [
        ("a", '{"x": 1, "query": "new"}', "keyword"), ("b", '{"query": "new"}', "keyword"), ("c", '{"query": "new"}', "keyword"),
    ]
    snippet = lambda t: {"textDisplay": t, "authorDisplayName": "u", "publishedAt": "p"}
    threads = landed(
        spark, tmp_path, "t", YOUTUBE_THREADS,
        {"source_id": "v1", "items": [{"snippet": {"topLevelComment": {"id": "c1", "snippet": snippet("top")}}, "replies": {"comments": [{"id": "r1", "snippet": snippet("re")}]}}, {"snippet": {"topLevelComment": {"id": "c2", "snippet": snippet("x")}}}]},
    )
    got = json.loads(youtube_comments(threads).first().comments_json)
    reply = {"id": "r1", "text": "re", "author": "u", "created_at_utc": "p", "url": ""}
    assert got[0] == {"id": "c1", "text": "top", "author": "u", "created_at_utc": "p", "url": "", "replies": [reply]}
    assert got[1]["replies"] == []


def test_tweet_payloads(spark, tmp_path):
    items = landed(
        spark, tmp_path, "tw", TWEET,
        {"id": "1", "text": "t", "author_id": "9", "created_at": "c", "conversation_id": "1", "public_metrics": {"retweet_count": 1, "like_count": 2}},
        {"id": "2"},
    )
    rows = {r.id: r for r in tweets(items, RUN_TS).collect()}
    assert rows["1"].metadata_json == json.dumps({"author_id": "9", "conversation_id": "1", "public_metrics": {"retweet_count": 1, "like_count": 2}})
    assert rows["2"].metadata_json == json.dumps({"author_id": "", "conversation_id": "", "public_metrics": {}})
    assert (rows["1"].title, rows["1"].author, rows["1"].url) == ("", "9", "https://x.com/i/web/status/1")
    talk = landed(spark, tmp_path, "co", TWEETS, {"source_id": "1", "data": [{"id": "1"}, {"id": "2", "text": "a"}, {"id": "3"}]})
    assert [c["id"] for c in json.loads(twitter_comments(talk, 2).first().comments_json)] == ["2"]
    assert set(REGISTRY) == {"reddit", "youtube", "twitter"}
    assert land_payloads({"twitter": items}, RUN_TS).count() == 2 and land_comments({"twitter": talk}, 1).first().comments_json == "[]"
    own = {"forum": (lambda df, run_ts: df.select(F.lit("forum").alias("platform"), "id"), None)}
    assert rows_of(land_payloads({"forum": items}, RUN_TS, own), "platform", "id") == [("forum", "1"), ("forum", "2")]
    with pytest.raises(ValueError, match="no payload transform for platforms: forum"):
        land_payloads({"forum": items}, RUN_TS)
    assert rows_of(first_results(spark.range(5).withColumnRenamed("id", "pos"), 2)) == [(0,), (1,)]


# ---- extraction ------------------------------------------------------------


def land(spark, *rows):
    return spark.createDataFrame(
        [(p, m, i, t, o) for o, (p, m, i, t) in enumerate(rows)], "platform string, collection_method string, id string, text string, o bigint"
    ).select("*", F.array("o").alias("row_ord")).drop("o")


def test_extraction_run(spark, store):
    rows = land(spark, ("reddit", "targeted_id", "p1", "a"), ("reddit", "keyword", "p1", "b"), ("reddit", "keyword", "p2", "c"), ("", "keyword", "p3", "d"))
    comments = spark.createDataFrame(
        [("reddit", "p1", '[{"id": "c"}]', "ok", "", ""), ("reddit", "p2", "", "error", "HttpError", "503")],
        "platform string, source_id string, comments_json string, status string, error_type string, message string",
    )
    stats = metrics_of(run_extraction(spark, store, "r1", RUN_TS, rows, comments))
    assert stats[("output_rows", "")] == 3 and stats[("errors", "")] == 1
    assert stats[("skipped_existing_rows", "")] == stats[("duplicate_rows_skipped", "")] == 1
    assert stats[("num_platforms", "")] == 2 and ("platform_distribution", "") not in stats
    master = read_master(spark, store, "extraction_raw", EXTRACTION)
    assert rows_of(master, "platform", "id", "text", "comments_json") == [
        ("", "p3", "d", "[]"), ("reddit", "p1", "a", '[{"id": "c"}]'), ("reddit", "p2", "c", "[]"),
    ]
    parts = {p.split("platform_part=")[1].split("/")[0] for p in spark.read.parquet(store.snapshot("extraction", "r1", "extraction_raw")).inputFiles()}
    assert parts == {"reddit", "unknown"}
    assert spark.read.parquet(store.quarantine()).first().id_or_query == "p2"
    again = land(spark, ("reddit", "keyword", "p2", "c"), ("reddit", "keyword", "p4", "e"))
    stats = metrics_of(run_extraction(spark, store, "r2", RUN_TS, again))
    assert stats[("new_rows_added", "")] == 1


def test_a_users_own_payload_plugs_in(spark):
    own = spark.createDataFrame([("7", "hello", 0)], "uid string, body string, o bigint")
    rows = own.select(F.lit("forum").alias("platform"), F.col("uid").alias("id"), F.col("body").alias("text"), F.array("o").alias("row_ord"))
    out = select_new_rows(rows, None)
    assert attach_comments(out, spark.createDataFrame([("forum", "7", "[1]")], "platform string, source_id string, comments_json string")).first().comments_json == "[1]"
