"""The keyed seen-set of a stream: first copy wins, its size is that of the keys, entries expire."""

import time

from pyspark.sql import functions as F

from talkloom.streaming.seen_state import keyed_first_wins
from tests.conftest import rows_of

SCHEMA = "id string, text string, row_ord array<long>"


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, out, checkpoint, ttl_ms=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    first = keyed_first_wins(stream, F.col("id"), "row_ord", ttl_ms)
    query = first.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    ended = query.awaitTermination(60)
    query.stop()
    assert ended
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_first_copy_wins_across_batches_and_restarts(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    land(spark, folder, "1", [(str(k), "first", [0, k]) for k in range(20)] + [("3", "later", [0, 99]), ("4", "earlier", [0, 1])])
    time.sleep(1.1)
    land(spark, folder, "2", [(str(k), "second", [1, k]) for k in range(10, 30)])
    sizes = run(spark, folder, out, checkpoint)
    assert max(sizes) == 30  # one entry a key, not one a row
    land(spark, folder, "3", [(str(k), "third", [2, k]) for k in range(25, 35)])
    assert max(run(spark, folder, out, checkpoint)) == 35
    got = dict(rows_of(spark.read.schema(SCHEMA).parquet(out), "id", "text"))
    want = {str(k): "first" if k < 20 else "second" if k < 30 else "third" for k in range(35)} | {"4": "earlier"}
    assert got == want and spark.read.parquet(out).count() == 35


def test_keys_expire(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    land(spark, folder, "1", [("a", "one", [0])])
    run(spark, folder, out, checkpoint, ttl_ms=1_000)
    time.sleep(2.5)
    land(spark, folder, "2", [("a", "two", [1])])
    run(spark, folder, out, checkpoint, ttl_ms=1_000)
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert rows_of(spark.read.schema(SCHEMA).parquet(out), "text") == [("one",), ("two",)]
