"""Input order from paths and row numbers, and the grid of the job product."""

from pyspark.sql import functions as F

from talkloom.operators.dedup import first_wins
from talkloom.plans.store import file_order, ordered_source
from talkloom.sources.jobs import subreddit_jobs
from tests.conftest import rows_of


def write(spark, folder):
    """Two files of unequal size: the larger one, which Spark scans first, comes second by name."""
    spark.range(5).select(F.lit("key").alias("k"), F.concat(F.lit("a"), "id").alias("v")).coalesce(1).write.parquet(f"{folder}/n=1")
    many = spark.range(200_000).select(F.when(F.col("id") < 3, "key").otherwise(F.col("id").cast("string")).alias("k"), F.concat(F.lit("b"), "id").alias("v"))
    many.coalesce(1).write.parquet(f"{folder}/n=2")


def test_the_first_row_does_not_depend_on_how_a_scan_is_cut(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, folder)
    firsts = []
    for cut in ("128m", "64k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
        rows = ordered_source(spark.read.parquet(folder))
        firsts.append(first_wins(rows, "k", ["run_id", "row_ord"]).filter("k = 'key'").first().v)
        assert rows.count() == 200_005 and rows.select("row_ord").distinct().count() == 200_005
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert firsts == ["a0", "a0"]


def test_rows_that_are_no_scan_keep_their_order(spark, tmp_path):
    made = spark.createDataFrame([("x",), ("y",)], "v string")
    assert file_order(made) is None and [r.v for r in ordered_source(made).orderBy("row_ord").collect()] == ["x", "y"]
    placed = made.withColumn("row_ord", F.array(F.lit(7)))
    assert ordered_source(placed).select("row_ord").distinct().collect()[0][0] == [7]


def test_product_of_jobs_on_a_grid(spark):
    def values(n):
        return spark.range(n).select(F.array("id").alias("pos"), F.concat(F.lit("v"), "id").alias("value"))

    made = subreddit_jobs(values(37), values(53), block=10)
    pairs = rows_of(made, "subreddit", "keyword")
    assert len(pairs) == 37 * 53 and len(set(pairs)) == 37 * 53
    assert subreddit_jobs(values(37), values(0), block=10).count() == 0
    assert rows_of(subreddit_jobs(values(2), values(2)), "subreddit", "keyword") == [("v0", "v0"), ("v0", "v1"), ("v1", "v0"), ("v1", "v1")]
