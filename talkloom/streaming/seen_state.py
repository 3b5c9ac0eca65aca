"""A seen-set that grows with the stream, as keyed state of the query itself.

The alternative to the seen-tables of ``runner`` where a stream stands alone: each key has one entry in
a RocksDB state store, on the executors' disks and in the checkpoint, so memory does not grow with the keys, a
restart goes on where it stopped, and no history is scanned. ``ttl`` bounds the state: a key that has not been
seen for so long counts as new again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY = "record_key"


class FirstRow(StatefulProcessor):
    """Passes the first row of a key, by ``order`` among those that come together; nothing once the key is known."""

    def __init__(self, order: str, ttl_ms: int | None = None):
        self.order, self.ttl_ms = order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "times long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.seen.get()
        first, count = None, 0
        for row in rows:  # one row is held, however many a key has
            count += 1
            if first is None or row[self.order] < first[self.order]:
                first = row
        self.seen.update(((known[0] if known else 0) + count,))
        if known is None:
            yield first

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession, ttl: bool = False) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if ttl:  # else a stream over what is available asks for one more batch for ever, to let entries expire
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")


def keyed_first_wins(rows: DataFrame, key: Column, order: str, ttl_ms: int | None = None) -> DataFrame:
    """A stream's rows without those whose key came before, in this micro-batch or any earlier one.

    ``order`` is a column that orders rows of one micro-batch. Null keys are one key. With ``ttl_ms``, a key is
    forgotten that long after it was last seen; entries are removed by batches that bring rows.
    """
    use_rocksdb(rows.sparkSession, ttl_ms is not None)
    keyed = rows.withColumn(KEY, key)
    mode = "none" if ttl_ms is None else "processingTime"
    return keyed.groupBy(KEY).transformWithState(FirstRow(order, ttl_ms), keyed.schema, "append", mode)
