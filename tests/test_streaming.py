from pyspark.sql import functions as F

from talkloom.plans.preprocessing import run_preprocessing
from talkloom.plans.store import Store, read_master, read_state
from talkloom.schemas import EXTRACTION, STANDARDIZED
from talkloom.streaming.runner import bounded_first_wins, read_landing, stream_preprocessing
from tests.conftest import RUN_TS, rows_of


def land(spark, path, first, last):
    columns = {c: F.lit("") for c in EXTRACTION.fieldNames()}
    columns.update(platform=F.lit("reddit"), id=F.col("id").cast("string"), text=F.concat(F.lit("t"), F.col("id")))
    spark.range(first, last).select(*[columns[c].alias(c) for c in EXTRACTION.fieldNames()]).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    streamed, batched = Store(str(tmp_path / "s")), Store(str(tmp_path / "b"))
    land(spark, landing, 0, 20)
    land(spark, landing, 10, 30)

    def run():
        source = read_landing(spark, landing, files_per_batch=1)
        stream_preprocessing(spark, streamed, "r", RUN_TS, source, checkpoint).awaitTermination(300)

    run()
    run_preprocessing(spark, batched, "r", RUN_TS, spark.read.schema(EXTRACTION).parquet(landing), summarize=False)
    columns = STANDARDIZED.fieldNames()
    wanted = rows_of(read_master(spark, batched, "standardized", STANDARDIZED), *columns)
    assert len(wanted) == 30
    assert rows_of(read_master(spark, streamed, "standardized", STANDARDIZED), *columns) == wanted
    land(spark, landing, 25, 35)
    run()
    assert read_master(spark, streamed, "standardized", STANDARDIZED).count() == 35
    assert read_state(spark, streamed, "preprocessing").count() == 35
    assert read_master(spark, streamed, "standardized", STANDARDIZED).select("run_id").distinct().count() == 3


def test_watermark_variant_keeps_late_repeats(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "platform string, category string, id string, associated_id string, at timestamp"
    for number, (id_, at) in enumerate([("1", "2026-01-01 00:00:00"), ("1", "2026-01-01 00:05:00"), ("2", "2026-01-03 00:00:00"), ("3", "2026-01-03 00:00:30"), ("1", "2026-01-03 00:01:00")]):
        df = spark.createDataFrame([("x", "post", id_, id_, at)], "platform string, category string, id string, associated_id string, at string")
        df.withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(f"{folder}/{number}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    query = (
        bounded_first_wins(stream, "at", "1 hour").writeStream.format("memory").queryName("bounded").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    assert rows_of(spark.table("bounded"), "id") == [("1",), ("1",), ("2",), ("3",)]
