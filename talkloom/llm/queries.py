"""One query per operator over the driver tables, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from talkloom.llm import bbit_minhash, context_mixing, decontaminate, ecoc_language, exact_dedup, filter_audit, jaccard_join, packing, ring_sharding, spelling_variants, toxicity_knn, training_order, url_filter
from talkloom.llm.work import Work


TOKENIZER = "word_bpe_49k.json"


def tokenizer() -> str:
    """The place of the public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(3) == 1
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    index = toxicity_knn.fit(docs, docs.where(~held_out).join(labels, "doc_id").withColumnRenamed("doc_id", "id"))
    scored = toxicity_knn.score(docs, index)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    digest = F.sha2(exact_dedup.normalised(F.col("text")).cast("binary"), 256)
    return exact_dedup.mark_duplicates(docs.withColumn("text_sha256", digest), carry=("text_sha256",))


OP2_SQL = r"""WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256 FROM n"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.find_passages(documents(spark, sf_dir).select("doc_id", "text"), benchmark)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = documents(spark, sf_dir).select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = ring_sharding.shard_rows(docs, shards=24, carry=("size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(documents(spark, sf_dir).select("doc_id", "text"))


def similarity_sql(width: int, percent: int, columns: str) -> str:
    """All pairs by their common shingles, then everything reachable; quadratic, for small tables."""
    return rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, p.b FROM r JOIN p ON r.other = p.a),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, {columns} FROM s JOIN c USING (doc_id)"""


OP5_SQL = similarity_sql(5, 75, "component_id")
OP11_SQL = similarity_sql(4, 80, "component_id, doc_id = component_id AS kept")

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)


OP6_SQL = r"""WITH p AS (
  SELECT page_id, row_number() OVER () AS n,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
r(h, q, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT n, max(struct_pack(l := length(h || q), r := h || q, v := v)) AS best FROM p JOIN r
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY n)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM p LEFT JOIN m USING (n)"""


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark)
    held_out = remainder(7) == 2
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = context_mixing.train(docs.where(~held_out), work)
    scored = context_mixing.score(docs, model, work)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "bits_per_byte")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(3) == 1
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = ecoc_language.fit(docs.where(~held_out & F.col("text").isNotNull()))
    scored = ecoc_language.predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous", "codeword_bits")


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shard files into the shared folder; returns where each document went."""
    where, manifest, _ = training_order.materialise(documents(spark, sf_dir).select("doc_id", "text"), tokenizer(), key=20260101)
    return where.join(manifest.select("shard", "first_slot", "file_bytes", "file_crc32"), "shard")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"), tokenizer())


def op11_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(documents(spark, sf_dir).select("doc_id", "text"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return filter_audit.audit_text_filters(documents(spark, sf_dir).select("doc_id", "text", "lang"), labels)


OP13_SQL = r"""WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  CASE WHEN len(words) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END ||
  CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END ||
  CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS f
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, f, count(*) AS docs, count_if(good) AS good, count_if(toxic) AS toxic FROM m GROUP BY part, f),
o(filter_order) AS (SELECT '' UNION ALL SELECT filter_order || x FROM o, unnest(['A', 'B', 'C', 'D', 'E']) AS u(x) WHERE NOT contains(filter_order, x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
  FROM o, range(1, 6) AS r(step) WHERE length(filter_order) = 5),
r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, any_value(x) AS x,
  coalesce(sum(docs) FILTER (translate(f, before || x, '') = f), 0) AS kept,
  coalesce(sum(docs) FILTER (contains(f, x) AND translate(f, before, '') = f), 0) AS removed,
  coalesce(sum(docs) FILTER (contains(f, x) AND translate(f, before, '') <> f), 0) AS redundant,
  coalesce(sum(docs) FILTER (f = x), 0) AS unique_fails,
  coalesce(sum(good) FILTER (contains(f, x) AND translate(f, before, '') = f), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (contains(f, x) AND translate(f, before, '') = f), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_sharding": op4_sharding,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_url_filter": op6_url_filter,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_language_id": op8_language_id,
    "op9_training_order": op9_training_order,
    "op10_packing": op10_packing,
    "op11_near_dedup": op11_near_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {"op2_exact_dedup": OP2_SQL, "op5_jaccard_join": OP5_SQL, "op6_url_filter": OP6_SQL, "op11_near_dedup": OP11_SQL, "op13_filter_audit": OP13_SQL}
