"""Gapless ranks inside cells, with hot cells split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

PARTS = 16


def ranked(df: DataFrame, cell: str, unique: str, order: list[str], name: str = "rank", parts: int = PARTS) -> tuple[DataFrame, DataFrame]:
    """(df with ``name``: place of the row in its cell from 0, the counts of the cells).

    ``df`` must be a written table and ``unique`` differ in every row: a cell is dealt by its
    hash into ``parts`` parts that are ranked apart and shifted by the counts before them,
    so a cell that holds a third of all rows is still sorted in ``parts`` tasks. The order
    runs by part, then by ``order`` and ``unique``.
    """
    part, ahead, n = "__talkloom_part", "__talkloom_ahead", "__talkloom_n"
    parted = df.withColumn(part, F.pmod(F.xxhash64(F.col(unique)), F.lit(parts)).cast("int"))
    counts = parted.groupBy(cell, part).agg(F.count("*").alias(n))
    before = Window.partitionBy(cell).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn(ahead, F.coalesce(F.sum(n).over(before), F.lit(0))).drop(n)
    inside = Window.partitionBy(cell, part).orderBy(*order, unique)
    rows = parted.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    rows = rows.join(shifts, [cell, part]).withColumn(name, F.col(name) + F.col(ahead)).drop(part, ahead)
    return rows, df.groupBy(cell).agg(F.count("*").alias("n"))
