"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

A text whose normalised length nobody shares is unique and looked at no further; of
the rest, one whose (length, prefix hash) nobody shares is unique too; the full hash is
computed only for texts that survive both. Counts are combined before every shuffle and
no text is shuffled while the surviving keys can be broadcast (their size is counted;
beyond the bound they are joined by shuffle).

Null text counts as empty. Columns of the input are kept whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from talkloom.llm.work import Work, internal, small

PREFIX_CHARS = 64
KEEP, SIZE, KEPT = "keep_id", "group_size", "kept"
LEN, PREFIX, FULL, LIVE, ROW, FIRST, TIES = internal("len", "prefix", "full", "live", "row", "first", "ties")


def normalised(text: Column) -> Column:
    """Null as empty, every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def surviving(docs: DataFrame, text: str, work: Work) -> DataFrame:
    """(length, prefix hash) of texts that share both: the keys that need a full hash."""
    norm = normalised(F.col(text))
    keys = docs.select(F.length(norm).alias(LEN), F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias(PREFIX))
    keys = work.keep(keys.groupBy(LEN, PREFIX).agg(F.count("*").alias("n")), "keys")
    lengths = keys.groupBy(LEN).agg(F.sum("n").alias("n")).where("n > 1").select(LEN)
    shared = keys.join(lengths, LEN, "left_semi").where("n > 1").select(LEN, PREFIX)
    return work.keep(shared.withColumn(LIVE, F.lit(True)), "shared")


def refined(docs: DataFrame, text: str, work: Work) -> DataFrame:
    """``docs`` with length, prefix hash and, for surviving texts only, the full hash."""
    norm = normalised(F.col(text))
    rows = docs.withColumn(LEN, F.length(norm)).withColumn(PREFIX, F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)))
    rows = rows.join(small(surviving(docs, text, work), 32), [LEN, PREFIX], "left")
    return rows.withColumn(FULL, F.when(F.col(LIVE), F.sha2(norm.cast("binary"), 256))).drop(LIVE)


def grouped(rows: DataFrame, id_col: str) -> DataFrame:
    """Groups of equal texts with two rows or more."""
    return (
        rows.where(F.col(FULL).isNotNull())
        .groupBy(LEN, PREFIX, FULL)
        .agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(ROW).alias("row"))).alias(FIRST), F.count("*").alias(SIZE))
        .where(F.col(SIZE) > 1)
    )


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, ``carry`` columns, keep_id, group_size, kept.

    Of equal texts the row with the smallest id stays (null ids last); of repeated
    rows with that id exactly one stays. An empty table gives no rows.
    """
    work = Work(docs.sparkSession)
    wide = docs.select(id_col, text, *carry)
    rows = refined(wide, text, work).select(id_col, *carry, LEN, PREFIX, FULL, F.monotonically_increasing_id().alias(ROW))
    rows = work.keep(rows, "rows")  # row numbers are fixed from here on
    groups = grouped(rows, id_col).select(FULL, FIRST, SIZE)
    # rows without a full hash are unique: they stay out of the join, where they would meet in one task
    hashed = rows.where(F.col(FULL).isNotNull()).join(groups, FULL, "left")
    out = hashed.unionByName(rows.where(F.col(FULL).isNull()), allowMissingColumns=True)
    alone = F.col(FIRST).isNull()
    return out.select(
        id_col,
        *carry,
        F.when(alone, F.col(id_col)).otherwise(F.col(FIRST)["id"]).alias(KEEP),
        F.coalesce(F.col(SIZE), F.lit(1).cast("long")).alias(SIZE),
        (alone | (F.col(FIRST)["row"] == F.col(ROW))).alias(KEPT),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; repeated rows stay once.

    Texts are not shuffled: rows find their group in a counted broadcast. Only where an
    id repeats inside a group do those rows meet, already reduced inside each task.
    """
    work = Work(docs.sparkSession)
    columns = docs.columns
    rows = refined(docs, text, work)
    slim = work.keep(rows.select(id_col, LEN, PREFIX, FULL).where(F.col(FULL).isNotNull()), "hashed")
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"))
    firsts = slim.groupBy(LEN, PREFIX, FULL).agg(F.min(key).alias(FIRST), F.count("*").alias("n")).where("n > 1").select(FULL, FIRST)
    firsts = work.keep(firsts, "firsts")
    ties = slim.groupBy(FULL, id_col).agg(F.count("*").alias("n")).where("n > 1").select(FULL, F.lit(True).alias(TIES)).distinct()
    groups = work.keep(firsts.join(ties, FULL, "left"), "groups")
    out = rows.join(small(groups, 120), FULL, "left").where(F.col(FIRST).isNull() | F.col(FIRST)["id"].eqNullSafe(F.col(id_col)))
    single = out.where(F.col(TIES).isNull())
    if groups.where(TIES).isEmpty():
        return single.select(*columns)
    others = [F.first(c).alias(c) for c in columns]
    once = out.where(F.col(TIES)).groupBy(FULL).agg(*others).select(*columns)
    return single.select(*columns).unionByName(once)
