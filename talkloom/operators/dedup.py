"""First-wins deduplication and skipping of records that were seen before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from talkloom.session import settle


def first_wins(df: DataFrame, key: str, order_by: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of every key.

    ``row_number() = 1`` lets Spark put a group limit below the exchange, so each map
    task forwards at most one row per key: a key that holds a third of all rows
    costs one row per task in the shuffle.
    """
    window = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def skip_seen(df: DataFrame, seen: DataFrame | None, key: str = "record_key") -> DataFrame:
    """Rows whose key is not in ``seen(record_key)``; ``None`` is force mode.

    No hint is given here: pass ``seen`` through ``relevant_history`` first, which
    broadcasts what it has measured to be small.
    """
    if seen is None:
        return df
    known = seen.select(F.col("record_key").alias("_known"))
    return df.join(known, F.col(key) == F.col("_known"), "left_anti")


# Key tables of up to this many bytes are broadcast; the figure is measured first.
MAX_BROADCAST_KEY_BYTES = 64 * 1024 * 1024


def _key_bytes(keys: DataFrame) -> int:
    return keys.agg(F.sum(F.octet_length("record_key") + 32)).first()[0] or 0


def relevant_history(seen: DataFrame, batch_keys: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """The part of the history a batch can meet, found with keys alone.

    Small batch: its keys are broadcast and the history is filtered as it is scanned.
    Large batch: history and keys meet in a shuffle, both without their texts. Either way
    the overlap is written out and, where its measured size allows, broadcast to the
    anti-join that follows, so that the texts of the batch stay where they are.
    """
    limit = MAX_BROADCAST_KEY_BYTES if max_bytes is None else max_bytes
    keys = batch_keys.select("record_key")
    small = _key_bytes(keys) <= limit
    overlap = settle(seen.join(F.broadcast(keys) if small else keys, "record_key", "left_semi"))
    return F.broadcast(overlap) if _key_bytes(overlap) <= limit else overlap


def drop_repeats(
    df: DataFrame, key: str, order_by: Sequence[Column | str], max_bytes: int | None = None
) -> DataFrame:
    """``first_wins`` for input that hardly repeats, such as a master table.

    Repeated keys are looked for among the keys alone. Without any, the rows pass as they
    are; with few, only the rows of those keys are shuffled.
    """
    limit = MAX_BROADCAST_KEY_BYTES if max_bytes is None else max_bytes
    counted = df.groupBy(F.col(key).alias("record_key")).count()
    repeated = settle(counted.filter("count > 1").select("record_key"))
    size = _key_bytes(repeated)
    if size == 0:
        return df
    if size > limit:
        return first_wins(df, key, order_by)
    listed = F.broadcast(repeated.select(F.col("record_key").alias("_repeated")))
    same = F.col(key) == F.col("_repeated")
    return df.join(listed, same, "left_anti").unionByName(
        first_wins(df.join(listed, same, "left_semi"), key, order_by)
    )


def first_rows(df: DataFrame, limit: int | None, order_by: Sequence[Column | str]) -> DataFrame:
    """The first ``limit`` input rows, before anything is skipped."""
    if limit is None:
        return df
    return df.orderBy(*order_by).limit(limit)
