import json

import pytest
from pyspark.sql import functions as F

from talkloom.operators.batches import build_requests, forecast_usage
from talkloom.operators.langid import LanguageSettings, decide, goes_to_batch, score_texts, train_profile
from talkloom.operators.numbering import assign_batches, number_rows
from talkloom.operators.summaries import distribution, price_usage, sum_usage, summary_document
from talkloom.operators.terms import TermMatcher
from talkloom.plans import store as store_module
from talkloom.plans.classification import collect_classification, run_classification
from talkloom.plans.language import collect_language, run_language
from talkloom.plans.preprocessing import run_preprocessing
from talkloom.plans.store import append_table, read_master, read_state, state_rows
from talkloom.schemas import CLASSIFICATION, EXTRACTION, LANGUAGE, RESPONSE, STANDARDIZED
from talkloom.sources.tables import read_table, read_value_file
from tests.conftest import RUN_TS, metrics_of, rows_of

MATCHER = TermMatcher.build(["ai"], ["hospital", "health*"])
MODEL = "model-x"
PRICES = "model string, input double, cached double, output double"


def standardized(spark, *rows):
    base = {f: "" for f in STANDARDIZED.fieldNames()}
    base.update(platform="facebook", collection_method="manual_upload", category="post")
    full = [{**base, **r} for r in rows]
    for r in full:
        r["associated_id"] = r["associated_id"] or r["id"]
    data = [(*[r[f] for f in STANDARDIZED.fieldNames()], [i], "") for i, r in enumerate(full)]
    return spark.createDataFrame(data, f"{', '.join(f + ' string' for f in STANDARDIZED.fieldNames())}, row_ord array<bigint>, run_id string")


def extraction(spark, *rows):
    base = {f: "" for f in EXTRACTION.fieldNames()}
    data = [(*[({**base, **r})[f] for f in EXTRACTION.fieldNames()], [i]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, f"{', '.join(f + ' string' for f in EXTRACTION.fieldNames())}, row_ord array<bigint>")


def responses(spark, *rows):
    base = {f.name: "" for f in RESPONSE}
    return spark.createDataFrame([tuple({**base, "status": "ok", **r}[f.name] for f in RESPONSE) for r in rows], RESPONSE)


def answer(*results):
    return json.dumps({"results": list(results)})


# ---- numbering, requests, cost ---------------------------------------------


def test_numbers_are_dense_and_batches_full(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    numbered = number_rows(df, "key", "n", bucket_digits=2)
    assert sorted(r.n for r in numbered.collect()) == list(range(1000))
    ordered = [r.key for r in numbered.orderBy("n").collect()]
    assert ordered == [r.key for r in df.orderBy(F.md5("key")).collect()]
    sizes = [r["count"] for r in assign_batches(df, "key", 30).groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [30] * 33 + [10]


def test_requests_name_rows_and_labels(spark):
    df = spark.createDataFrame(
        [("b", 1, "row-2", 'say "hi"\n'), ("b", 0, "row-1", "AI in hospitals")], "batch_id string, ord int, row_id string, text string"
    )
    row = build_requests(df).first()
    assert '"row_id": "row-1"' in row.prompt and "valid_ai_healthcare" in row.prompt
    payload = json.loads(row.prompt.split("Rows:\n")[1])
    assert payload == [{"row_id": "row-1", "text": "AI in hospitals"}, {"row_id": "row-2", "text": 'say "hi"\n'}]
    assert forecast_usage(build_requests(df), MODEL).first().input_tokens == len(row.prompt) // 4


def usage(spark, *rows):
    return spark.createDataFrame(
        list(rows), "model string, input_tokens bigint, cached_input_tokens bigint, output_tokens bigint, usage_source string"
    )


def test_costs(spark):
    prices = spark.createDataFrame([(MODEL, 0.75, 0.075, 4.5)], PRICES)
    one = usage(spark, (MODEL, 60_000, 60_000, 4_000, "openai_api_usage"), (MODEL, 40_000, 0, 6_000, "openai_api_usage"))
    row = price_usage(sum_usage(one), prices).first()
    assert (row.uncached_input_tokens, row.input_cost_usd, row.cached_input_cost_usd) == (40_000, 0.03, 0.0045)
    assert (row.output_cost_usd, row.estimated_cost_usd, row.usage_source) == (0.045, 0.0795, "openai_api_usage")
    for source in ("estimated_tokenizer", "mixed"):
        assert sum_usage(usage(spark, (MODEL, 1, 0, 1, source))).first().usage_source == "mixed"
    with pytest.raises(Exception, match="no price for model: other"):
        price_usage(sum_usage(usage(spark, ("other", 1, 0, 1, "x"))), prices).collect()


def test_distribution_drops_blanks_and_sorts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,), ("b",)], "v string")
    assert [tuple(r) for r in distribution(df, "v").collect()] == [("a", 1), ("b", 2)]


# ---- preprocessing ---------------------------------------------------------


def test_preprocessing_is_incremental(spark, store):
    first = extraction(spark, {"platform": "reddit", "id": "1", "text": "a"}, {"platform": "reddit", "id": "2", "text": "b"})
    stats = metrics_of(run_preprocessing(spark, store, "r1", RUN_TS, first))
    assert stats[("new_rows_added", "")] == 2 and stats[("platform_distribution", "reddit")] == 2
    more = extraction(spark, {"platform": "reddit", "id": "2", "text": "again"}, {"platform": "x", "id": "2", "text": "c"})
    stats = metrics_of(run_preprocessing(spark, store, "r2", RUN_TS, more))
    assert (stats[("output_rows", "")], stats[("new_rows_added", "")], stats[("skipped_existing_rows", "")]) == (2, 1, 1)
    stats = metrics_of(run_preprocessing(spark, store, "r3", RUN_TS, more))
    assert stats[("new_rows_added", "")] == 0
    master = read_master(spark, store, "standardized", STANDARDIZED)
    assert rows_of(master, "platform", "id", "text") == [("reddit", "1", "a"), ("reddit", "2", "b"), ("x", "2", "c")]
    state = read_state(spark, store, "preprocessing")
    assert rows_of(state, "record_key", "processed_at_utc")[0] == ("reddit|post|1|1", RUN_TS)
    assert state.count() == 3
    # Force mode may repeat rows in the master; the limit counts input rows.
    stats = metrics_of(run_preprocessing(spark, store, "r4", RUN_TS, more, force=True, limit=1))
    assert stats[("input_rows", "")] == 1 and stats[("new_rows_added", "")] == 1
    assert read_master(spark, store, "standardized", STANDARDIZED).count() == 4


def test_crash_between_master_and_state_loses_and_repeats_nothing(spark, store, monkeypatch):
    rows = extraction(spark, {"platform": "reddit", "id": "1", "text": "a"}, {"platform": "reddit", "id": "2", "text": "b"})
    real = store_module.state_rows

    def broken(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(store_module, "state_rows", broken)
    with pytest.raises(KeyboardInterrupt):
        run_preprocessing(spark, store, "r1", RUN_TS, rows)
    monkeypatch.setattr(store_module, "state_rows", real)
    more = extraction(spark, {"platform": "reddit", "id": "1", "text": "a"}, {"platform": "reddit", "id": "3", "text": "c"})
    stats = metrics_of(run_preprocessing(spark, store, "r2", RUN_TS, more))
    assert stats[("new_rows_added", "")] == 1
    assert rows_of(read_master(spark, store, "standardized", STANDARDIZED), "id") == [("1",), ("2",), ("3",)]


# ---- classification --------------------------------------------------------


def test_provided_label_bypasses_the_labeller(spark, store):
    rows = standardized(spark, {"id": "m1", "text": "short text", "provided_language_label": "cebuano", "provided_classification_label": " valid_ai_healthcare "})
    stats = metrics_of(run_classification(spark, store, "r", RUN_TS, MATCHER, MODEL, rows, labeller=lambda r: responses(spark)))
    assert stats[("rows_sent_to_gpt", "")] == 0
    out = read_master(spark, store, "classification_all", CLASSIFICATION).first()
    assert (out.model_used, out.model_classification, out.available_terms) == ("provided_label", "valid_ai_healthcare", "provided_label")
    assert (out.provided_language_label, out.classified_at_utc) == ("cebuano", RUN_TS)
    assert read_master(spark, store, "classification_valid_only", CLASSIFICATION).count() == 1


def test_prefilter_only(spark, store):
    rows = standardized(
        spark,
        {"id": "m1", "text": "AI for hospital triage"},
        {"id": "m2", "text": "AI coding tools are great"},
        {"id": "m3", "text": "any", "provided_classification_label": "valid_ai_healthcare"},
        {"id": "m4", "text": "nothing"},
        {"id": "m4", "text": "repeat"},
    )
    stats = metrics_of(run_classification(spark, store, "r", RUN_TS, MATCHER, MODEL, rows, prefilter_only=True))
    assert [stats[(m, "")] for m in ("input_rows", "new_rows_processed", "skipped_existing_rows")] == [5, 4, 1]
    assert [stats[(m, "")] for m in ("provided_label_rows", "rule_filtered_rows", "gpt_candidate_rows")] == [1, 2, 1]
    assert rows_of(read_master(spark, store, "classification_all", CLASSIFICATION), "id", "model_used", "model_classification") == [
        ("m1", "prefilter_only", "valid_ai_healthcare"),
        ("m2", "prefilter_only", "invalid_ai_only"),
        ("m3", "prefilter_only", "provided_label"),
        ("m4", "prefilter_only", "invalid_neither"),
    ]
    assert rows_of(read_master(spark, store, "classification_valid_only", CLASSIFICATION), "id") == [("m1",)]


def test_valid_only_tables_exist_when_empty(spark, store):
    run_classification(spark, store, "r", RUN_TS, MATCHER, MODEL, standardized(spark, {"id": "a", "text": "x"}), prefilter_only=True)
    assert read_table(spark, store.snapshot("classification", "r", "classification_valid_only"), CLASSIFICATION).count() == 0


def test_full_run_with_responses(spark, store):
    texts = {f"m{i}": f"AI in hospital {i}" for i in range(7)}
    rows = standardized(spark, *[{"id": k, "text": v} for k, v in texts.items()], {"id": "n", "text": "health"})

    def labeller(requests):
        batches = {r.batch_id: json.loads(r.prompt.split("Rows:\n")[1]) for r in requests.collect()}
        assert sorted(len(b) for b in batches.values()) == [1, 2, 2, 2]
        out = []
        for number, (batch, items) in enumerate(sorted(batches.items())):
            ids = [i["row_id"] for i in items]
            if number == 0:
                body = answer(
                    {"row_id": ids[0], "model_classification": "unsure"},
                    {"row_id": ids[0], "model_classification": "valid_ai_healthcare", "reason": "last wins"},
                    {"row_id": ids[1], "model_classification": "made up"},
                    {"row_id": "stranger", "model_classification": "unsure"},
                    17,
                )
                out.append({"batch_id": batch, "body": body, "usage": '{"input_tokens": 100, "output_tokens": 10}'})
            elif number == 1:
                out.append({"batch_id": batch, "status": "error", "error_type": "Timeout", "message": "slow"})
            elif number == 2:
                out.append({"batch_id": batch, "body": '{"results": "none"}', "usage": '{"prompt_tokens": 5}'})
            else:
                out.append({"batch_id": batch, "body": "not json"})
        return responses(spark, *out)

    prices = spark.createDataFrame([(MODEL, 1.0, 0.1, 2.0)], PRICES)
    stats = metrics_of(
        run_classification(spark, store, "r", RUN_TS, MATCHER, MODEL, rows, labeller=labeller, batch_size=2, prices=prices)
    )
    assert stats[("rows_sent_to_gpt", "")] == 7 and stats[("new_rows_processed", "")] == 8
    out = read_master(spark, store, "classification_all", CLASSIFICATION)
    got = {(r.model_used, r.model_classification): r["count"] for r in out.groupBy("model_used", "model_classification").count().collect()}
    default = "invalid_confusing_or_insufficient"
    assert got == {
        (MODEL, "valid_ai_healthcare"): 1,
        (MODEL, default): 3,
        ("gpt_error_fallback", default): 3,
        ("rules_terms_filter", "invalid_health_only"): 1,
    }
    errors = spark.read.parquet(store.quarantine())
    assert sorted((r.stage, r.error_type) for r in errors.collect()) == [
        ("classification", "Timeout"), ("classification", "Timeout"), ("classification", "UnparsedResponse"),
    ]
    cost = spark.read.json(store.snapshot("classification", "r", "cost")).first()
    assert (cost.input_tokens, cost.output_tokens, cost.estimated_cost_usd) == (105, 10, 0.000125)


def test_pending_batches_are_collected_later(spark, store):
    rows = standardized(spark, {"id": "a", "text": "AI hospital"}, {"id": "b", "text": "none"})
    stats = metrics_of(run_classification(spark, store, "r1", RUN_TS, MATCHER, MODEL, rows))
    assert stats[("new_rows_processed", "")] == 1
    again = metrics_of(run_classification(spark, store, "r2", RUN_TS, MATCHER, MODEL, rows))
    assert again[("new_rows_processed", "")] == 0
    request = spark.read.parquet(f"{store.root}/requests/classification/prompts").filter("n_rows > 0").first()
    key = json.loads(request.prompt.split("Rows:\n")[1])[0]["row_id"]
    body = answer({"row_id": key, "model_classification": "valid_ai_healthcare"})
    done = collect_classification(spark, store, "r3", RUN_TS, MODEL, responses(spark, {"batch_id": request.batch_id, "body": body}))
    assert rows_of(done, "id", "model_classification") == [("a", "valid_ai_healthcare")]
    repeat = collect_classification(spark, store, "r4", RUN_TS, MODEL, responses(spark, {"batch_id": request.batch_id, "body": body}))
    assert repeat.count() == 0


# ---- language --------------------------------------------------------------


def test_ladder(spark):
    long = "a text that is long enough"
    rows = spark.createDataFrame(
        [
            ("short", "hi"),
            ("cue", "may ari nga bag-o diri"),
            ("unscored", long),
            ("foreign", long),
            ("mixed", long),
            ("low", long),
            ("ok", long),
            ("late", long),
        ],
        "row_key string, text string",
    )
    scores = spark.createDataFrame(
        [
            ("short", "en", 0.99),
            ("cue", "en", 0.99),
            ("foreign", "de", 0.99),
            ("mixed", "en", 0.55),
            ("mixed", "tl", 0.40),
            ("low", "en", 0.60),
            ("low", "tl", 0.10),
            ("ok", "en", 0.90),
            # The only mapped code comes fourth, after the cut to three.
            ("late", "de", 0.4),
            ("late", "fr", 0.3),
            ("late", "es", 0.2),
            ("late", "en", 0.1),
        ],
        "row_key string, code string, score double",
    )
    settings = LanguageSettings()
    out = decide(rows, scores, settings).withColumn("batch", goes_to_batch(F.col("reason"), settings))
    got = {r.row_key: (r.reason, r.language_label, r.batch) for r in out.collect()}
    assert got == {
        "short": ("too_short", "out_of_scope", False),
        "cue": ("possible_hiligaynon", "out_of_scope", True),
        "unscored": ("fasttext_model_unavailable", "out_of_scope", True),
        "foreign": ("unsupported_language", "out_of_scope", False),
        "mixed": ("possible_mixed_language", "out_of_scope", True),
        "low": ("low_confidence", "out_of_scope", True),
        "ok": (None, "english", False),
        "late": ("unsupported_language", "out_of_scope", False),
    }
    off = LanguageSettings(use_cues=False, batch_low_confidence=False)
    out = decide(rows, scores, off).withColumn("batch", goes_to_batch(F.col("reason"), off))
    got = {r.row_key: (r.reason, r.batch) for r in out.collect()}
    assert got["cue"] == (None, False) and got["low"] == ("low_confidence", False)
    assert {r.reason for r in decide(rows, None, off).collect()} == {"too_short", "fasttext_model_unavailable"}


def test_scorer_shuffle_path_agrees_with_broadcast(spark, monkeypatch):
    from talkloom.operators import langid

    labelled = spark.createDataFrame([("en", "the cat and the dog"), ("tl", "ang pusa at ang aso")], "code string, text string")
    texts = spark.createDataFrame([("1", "the dog"), ("2", "ang aso"), ("3", "zz"), ("4", "qqqqq"), ("5", "")], "row_key string, text string")
    profile = train_profile(labelled)
    broad = rows_of(score_texts(texts, profile))
    monkeypatch.setattr(langid, "MAX_BROADCAST_PROFILE", 0)
    assert rows_of(score_texts(texts, profile)) == broad
    monkeypatch.setattr(langid, "FREQUENT_GRAMS", 1)  # nearly all grams by shuffle
    assert rows_of(score_texts(texts, profile)) == broad
    top = {k: c for k, c, _ in sorted(broad, key=lambda r: r[2])}
    assert top == {"1": "en", "2": "tl", "3": "und", "4": "und", "5": "und"}


def test_cues_are_looked_up_in_one_folded_text(spark):
    from talkloom.operators.langid import early_reason

    settings = LanguageSettings(cues=("a.b", "subong", "ss("))
    texts = ["what is A.B to us all", "what is a-b to us all", "karon kag SUBONG man ini", "die Straß( und mehr", "a.b"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(1).select("text", early_reason(F.col("text"), settings).alias("reason"))
    cue = "possible_hiligaynon"
    assert {r.text: r.reason for r in rows.collect()} == dict(zip(texts, [cue, None, cue, cue, "too_short"]))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("foldCase") == 1


@pytest.mark.parametrize("n", [1, 2, 3, 8])  # the numbers of 8 such characters no longer fit 64 bits
def test_ngrams_are_counted_before_they_are_exploded(spark, n):
    from collections import Counter

    from talkloom.operators.langid import ngrams

    many = "".join(chr(0x4E00 + k) for k in range(400))
    texts = {"1": "a" * 1000, "2": "l'été ß straße été l'été", "3": "x\U0001f600\U0001f600yx\U0001f600\U0001f600y", "4": many, "5": ""}
    rows = spark.createDataFrame([*texts.items(), ("6", None)], "row_key string, text string").repartition(1)
    wanted = []
    for key, text in [*texts.items(), ("6", "")]:
        counts = Counter(text[i : i + n] for i in range(len(text) - n + 1))
        wanted += [(key, g, t) for g, t in counts.items()] or [(key, None, None)]
    found = [tuple(r) for r in ngrams(rows, n).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    joint = ngrams(rows.withColumn("row_key", F.when(F.col("row_key") > "1", F.lit("z"))), n, combine=True)
    assert joint.filter("row_key is null").collect()[0].times == 1001 - n
    assert joint.filter("row_key = 'z'").agg(F.sum("times")).first()[0] == sum(w[2] or 0 for w in wanted if w[0] > "1")


def test_scorer_has_no_limit_of_languages_and_keeps_a_gram_of_all_texts_out_of_the_shuffle(spark):
    profile = spark.createDataFrame([("the", "c0000"), *[(f"{k:03d}", f"c{k:04d}") for k in range(1000)]], "gram string, code string")
    texts = spark.createDataFrame([(str(k), f"the{k:03d}") for k in range(1000)], "row_key string, text string")
    broad = rows_of(score_texts(texts, profile, keep_votes=True))
    shuffled = score_texts(texts, profile, keep_votes=True, broadcast_rows=0)
    assert rows_of(shuffled) == broad
    assert sorted(r[0] for r in broad if r[1] != "c0000" or r[0] == "0") == sorted(str(k) for k in range(1000))


def test_language_run(spark, store):
    text = "the hospital uses AI for every patient"
    rows = standardized(
        spark,
        {"id": "m1", "text": "short text", "provided_language_label": "cebuano"},
        {"id": "m2", "text": "hi"},
        {"id": "m3", "text": text},
        {"id": "m4", "text": "ang doktor nga nagagamit"},
        {"id": "m5", "text": "unang wika at second one"},
    )

    def scorer(texts):
        # A scorer of the user's own: any frame (row_key, code, score).
        assert {r.text for r in texts.collect()} == {text, "unang wika at second one"}
        english = texts.select("row_key", F.lit("en").alias("code"), F.when(F.col("text") == text, 0.9).otherwise(0.5).alias("score"))
        return english.unionByName(texts.select("row_key", F.lit("tl").alias("code"), F.when(F.col("text") == text, 0.1).otherwise(0.4).alias("score")))

    stats = metrics_of(run_language(spark, store, "r", RUN_TS, MODEL, rows, scorer=scorer))
    assert stats[("new_rows_processed", "")] == 3
    requests = spark.read.parquet(f"{store.root}/requests/language_detection/prompts")
    request = requests.first()
    assert "language_detected" in request.prompt and request.n_rows == 2
    ids = [i["row_id"] for i in json.loads(request.prompt.split("Rows:\n")[1])]
    body = answer(
        {"row_id": [i for i in ids if "m4" in i][0], "language_detected": ["tagalog", "hiligaynon", "english", "cebuano"]},
        {"row_id": [i for i in ids if "m5" in i][0], "language_detected": ["french", "tagalog"]},
    )
    done = collect_language(spark, store, "r2", RUN_TS, MODEL, responses(spark, {"batch_id": request.batch_id, "body": body}))
    assert done.count() == 2
    out = read_master(spark, store, "language_detection", LANGUAGE)
    assert rows_of(out, "id", "language_detected", "language_label", "model_classification") == [
        ("m1", '["cebuano"]', "cebuano", "provided_label"),
        ("m2", "[]", "out_of_scope", "fasttext"),
        ("m3", '["english"]', "english", "fasttext"),
        ("m4", '["tagalog", "hiligaynon", "english"]', "mixed_english_tagalog_hiligaynon", MODEL),
        ("m5", '["tagalog"]', "out_of_scope", MODEL),
    ]


def test_failed_language_batch(spark, store):
    rows = standardized(spark, {"id": "m1", "text": "long enough text"})
    labeller = lambda r: r.select("batch_id").selectExpr("batch_id", "'error' status", "'' body", "'' usage", "'E' error_type", "'m' message")
    prices = spark.createDataFrame([(MODEL, 1.0, 0.1, 2.0)], PRICES)
    stats = metrics_of(run_language(spark, store, "r", RUN_TS, MODEL, rows, labeller=labeller, prices=prices))
    assert stats[("detector_distribution", "gpt_error_fallback")] == 1
    assert stats[("language_label_distribution", "out_of_scope")] == 1
    assert spark.read.parquet(store.quarantine()).first().id_or_query == "m1"


# ---- tables ----------------------------------------------------------------


def test_old_layouts_read_in_the_new_one(spark, tmp_path):
    from talkloom.schemas import text_schema

    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "old", "gone")], "id string, text string, dropped string").write.parquet(path)
    append_table(spark.createDataFrame([("2", "new", "provided")], "id string, text string, label string"), path)
    assert append_table(spark.createDataFrame([], "id string"), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()
    assert rows_of(read_table(spark, path, text_schema(("id", "text", "label")))) == [("1", "old", ""), ("2", "new", "provided")]
    assert read_table(spark, str(tmp_path / "none"), STANDARDIZED).count() == 0


def test_csv_tables(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('text,id\n"two\nlines, ""q""",1\n ,2\n', encoding="utf-8")
    assert rows_of(read_table(spark, str(path), STANDARDIZED, "csv"), "id", "text", "category") == [("1", 'two\nlines, "q"', ""), ("2", " ", "")]
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    assert read_table(spark, str(tmp_path / "empty.csv"), STANDARDIZED, "csv").count() == 0


def test_value_files(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("ids\n abc \n\nx\nabc\n", encoding="utf-8")
    values = read_value_file(spark, str(tmp_path / "ids.csv"), "id", fallback="ids")
    assert [r.value for r in values.orderBy("pos").collect()] == ["abc", "x", "abc"]
    assert read_value_file(spark, str(tmp_path / "none.csv"), "id").count() == 0


def test_state_takes_any_key_function(spark):
    rows = standardized(spark, {"id": "1"})
    state = state_rows(rows, "mine", RUN_TS, F.concat(F.lit("k:"), F.col("id")))
    assert [tuple(r) for r in state.collect()] == [("mine", "k:1", "facebook", "1", "1", RUN_TS)]


def test_summary_document(spark, store):
    run_preprocessing(spark, store, "r", RUN_TS, extraction(spark, {"platform": "reddit", "id": "1", "text": "a"}))
    lines = spark.read.json(store.snapshot("preprocessing", "r", "summary"))
    doc = summary_document(lines.selectExpr("metric", "coalesce(key,'') key", "value")).first()
    assert doc.counters["new_rows_added"] == 1
    assert json.loads(doc.distributions["platform_distribution"]) == {"reddit": 1}


# ---- runs that were gone through -------------------------------------------


def test_stages_chain_and_reread_only_what_grew(spark, store):
    from talkloom.plans.store import unread_runs

    first = extraction(spark, {"platform": "reddit", "id": "1", "text": "AI hospital"}, {"platform": "reddit", "id": "2", "text": "b"})
    run_preprocessing(spark, store, "p1", RUN_TS, first)
    stats = metrics_of(run_classification(spark, store, "c1", RUN_TS, MATCHER, MODEL, prefilter_only=True))
    assert (stats[("input_rows", "")], stats[("new_rows_processed", "")]) == (2, 2)
    master = read_master(spark, store, "standardized", STANDARDIZED)
    assert unread_runs(spark, store, "classification", master)[0].count() == 0
    more = extraction(spark, {"platform": "reddit", "id": "3", "text": "c"}, {"platform": "reddit", "id": "1", "text": "again"})
    run_preprocessing(spark, store, "p2", RUN_TS, more)
    unread, sizes = unread_runs(spark, store, "classification", read_master(spark, store, "standardized", STANDARDIZED))
    assert rows_of(unread, "id") == [("3",)] and rows_of(sizes) == [("p2", 1)]
    stats = metrics_of(run_classification(spark, store, "c2", RUN_TS, MATCHER, MODEL, prefilter_only=True))
    assert [stats[(m, "")] for m in ("input_rows", "new_rows_processed", "skipped_existing_rows")] == [3, 1, 2]
    # A run that is added to under its old name is read again, whole.
    run_preprocessing(spark, store, "p1", RUN_TS, extraction(spark, {"platform": "reddit", "id": "4", "text": "d"}))
    unread, _ = unread_runs(spark, store, "classification", read_master(spark, store, "standardized", STANDARDIZED))
    assert rows_of(unread, "id") == [("1",), ("2",), ("4",)]
    stats = metrics_of(run_classification(spark, store, "c3", RUN_TS, MATCHER, MODEL, prefilter_only=True))
    assert [stats[(m, "")] for m in ("input_rows", "new_rows_processed", "skipped_existing_rows")] == [4, 1, 3]
    stats = metrics_of(run_language(spark, store, "l1", RUN_TS, MODEL))
    assert stats[("input_rows", "")] == 1
    assert read_master(spark, store, "classification_all", CLASSIFICATION).count() == 4


def test_history_is_shuffled_only_for_large_batches(spark):
    from talkloom.operators.dedup import relevant_history, skip_seen

    seen = spark.range(1000).selectExpr("concat('k', id) record_key")
    batch = spark.range(990, 1010).selectExpr("concat('k', id) record_key")
    for limit in (None, 10):
        kept = skip_seen(batch, relevant_history(seen, batch, limit))
        assert rows_of(kept) == [(f"k{i}",) for i in range(1000, 1010)]
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert limit is not None or "BroadcastHashJoin" in plan


def test_repeats_are_dropped_on_every_path(spark):
    from talkloom.operators.dedup import drop_repeats

    unique = spark.range(50).selectExpr("concat('k', id) record_key", "id pos", "'first' v")
    again = spark.range(10, 5000).selectExpr("case when id % 3 = 0 then 'k7' else concat('k', id % 40) end record_key", "id + 100 pos", "'later' v")
    wanted = rows_of(unique)
    assert rows_of(drop_repeats(unique, "record_key", ["pos"])) == wanted
    for limit in (None, 10):
        assert rows_of(drop_repeats(unique.unionByName(again), "record_key", ["pos"], limit)) == wanted
