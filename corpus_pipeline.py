"""Corpus pipeline over ``documents``: language ID, exact dedup, n-gram Jaccard join, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on every row it is given; all but the last return
the columns of ``docs`` and only leave rows out. Rows are told apart by a number fixed when
the stage writes its input down, so null and repeated ids are handled like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from talkloom.llm import decontaminate, ecoc_language, exact_dedup, jaccard_join, packing
from talkloom.llm.queries import tokenizer
from talkloom.llm.work import Work, internal, small

ROW, KEY, LANGUAGE, SCORE, DOUBT, BITS = internal("row", "key", "language", "score", "doubt", "bits")
#: A text is rejected if its best language is less likely than this, or if it has none.
LEAST_SCORE = 0.5


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the rows numbered in ``rows`` (broadcast where their counted size allows)."""
    return docs.join(small(rows.select(ROW).distinct(), 16), ROW, "left_anti").drop(ROW)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts without a recognisable language (null, no letter, or no likely one)."""
    model = ecoc_language.fit(docs.where(F.col("text").isNotNull()).select("text", "lang"))
    judged = ecoc_language.predict(docs, model, names=(LANGUAGE, SCORE, DOUBT, BITS))
    return judged.where((F.col(LANGUAGE) != ecoc_language.UNKNOWN) & (F.col(SCORE) >= LEAST_SCORE)).select(*docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the row of the smallest id of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the row of the smallest id of each component of similar texts."""
    work = Work(spark)
    rows = work.keep(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    keyed = rows.withColumn(KEY, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(ROW).alias("row")))
    found = jaccard_join.similar_components(keyed, KEY)
    others = work.keep(found.where(F.col("component_id") != F.col(KEY)).select(F.col(f"{KEY}.row").alias(ROW)), "others")
    return without(rows, others).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts that hold a passage of the benchmark."""
    work = Work(spark)
    rows = work.keep(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = work.keep(decontaminate.find_passages(rows, benchmark, id_col=ROW).select(ROW), "hits")
    return without(rows, hits).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining texts in training sequences."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", dedup),
    ("jaccard_join", near_dedup),
    ("decontamination", decontaminated),
    ("packing", packed),
]
#: Learned languages and column generation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
