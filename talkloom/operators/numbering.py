"""Dense row numbers without a global sort, and batches of N built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def number_rows(df: DataFrame, key: str, column: str = "row_no", bucket_digits: int = 3) -> DataFrame:
    """0-based dense numbers in the order of ``md5(key), key``.

    The leading hex digits of the digest cut that order into even ranges. Ranges are
    numbered in parallel and shifted by the row counts of the ranges before them; the
    table of shifts has at most ``16 ** bucket_digits`` rows, so it can be broadcast
    whatever the size of ``df``. Keys should be unique.
    """
    if not 1 <= bucket_digits <= 4:
        raise ValueError("bucket_digits must be 1..4")
    tagged = df.withColumn("_digest", F.md5(key)).withColumn("_range", F.substring("_digest", 1, bucket_digits))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        df.select(F.substring(F.md5(key), 1, bucket_digits).alias("_range"))
        .groupBy("_range")
        .count()
        .select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("_range").orderBy("_digest", key)
    return (
        tagged.join(F.broadcast(shifts), "_range")
        .withColumn(column, F.col("_shift") + F.row_number().over(inside) - 1)
        .drop("_digest", "_range", "_shift")
    )


def assign_batches(df: DataFrame, key: str, size: int, prefix: Column | str = "") -> DataFrame:
    """Consecutive groups of ``size`` rows: ``batch_id`` and place in the batch (``ord``)."""
    size = max(int(size), 1)
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    numbered = number_rows(df, key, "_row_no")
    return numbered.select(
        *df.columns,
        F.concat(prefix, F.lpad(F.floor(F.col("_row_no") / size).cast("string"), 12, "0")).alias("batch_id"),
        (F.col("_row_no") % size).cast("int").alias("ord"),
    )
