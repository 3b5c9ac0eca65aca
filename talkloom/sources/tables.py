"""Stage tables and input lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from talkloom.functions.keys import extraction_key, row_key
from talkloom.functions.text import blank_if_null, strip

CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_table(
    spark: SparkSession, path: str, schema: StructType, source: str = "parquet"
) -> DataFrame:
    """A stage table in its declared layout; a missing path is an empty table.

    Files written under an older layout need no rewrite: their missing columns read
    as blank and dropped ones are not read at all.
    """
    reader = spark.read
    try:
        if source == "csv":
            # Header names decide; the order of columns in the file does not matter.
            return conform(reader.options(**CSV_OPTIONS).csv(path), schema.fieldNames(), schema)
        return conform(reader.schema(schema).format(source).load(path), schema.fieldNames(), schema)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return spark.createDataFrame([], schema)
        raise


def conform(df: DataFrame, columns: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Exactly ``columns``, in order: text ones blank where missing, extras ignored."""
    text = {f.name for f in schema if f.dataType.typeName() == "string"} if schema else set(columns)
    present = set(df.columns)

    def pick(name: str) -> Column:
        if name not in present:
            return F.lit("" if name in text else None).alias(name)
        return (blank_if_null(name) if name in text else F.col(name)).alias(name)

    return df.select([pick(c) for c in columns])


def read_values(df: DataFrame, column: str, order_by: Sequence[Column | str]) -> DataFrame:
    """One input list: stripped, blanks dropped, duplicates and order kept (``pos``)."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], "pos array<bigint>, value string")
    pos = F.array(*[F.col(c).cast("bigint") if isinstance(c, str) else c for c in order_by])
    return df.select(pos.alias("pos"), strip(column).alias("value")).filter("value <> ''")


def read_value_file(spark: SparkSession, path: str, column: str, fallback: str | None = None) -> DataFrame:
    """An input list from a CSV file; ``fallback`` is used when ``column`` yields nothing."""
    try:
        df = spark.read.option("header", True).option("escape", '"').csv(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return spark.createDataFrame([], "pos array<bigint>, value string")
        raise
    df = df.select("*", "_metadata.file_block_start")
    order = ["file_block_start", F.monotonically_increasing_id()]
    values = read_values(df, column, order)
    if fallback is not None and values.isEmpty():
        return read_values(df, fallback, order)
    return values


def state_keys(state: DataFrame) -> DataFrame:
    """Keys of a state table; blank keys do not count."""
    return state.filter("record_key <> ''").select("record_key")


def master_keys(master: DataFrame, key: Column) -> DataFrame:
    """Keys derived from a master table; a key of blank parts still counts."""
    return master.select(key.alias("record_key"))


def seen_keys(
    master: DataFrame, state: DataFrame, key: Callable[[], Column] | Column = row_key
) -> DataFrame:
    """Master keys and state keys together.

    Left as a plain union: an anti-join does not care about repeats, so a distinct
    would only add a shuffle of the whole history.
    """
    column = key() if callable(key) else key
    return master_keys(master, column).unionByName(state_keys(state))


def extraction_seen(master: DataFrame, state: DataFrame) -> DataFrame:
    return seen_keys(master, state, extraction_key)
