"""Work tables: intermediate results written to the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A table is broadcast only when its counted rows stay below this many bytes.
BROADCAST_BYTES = 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only where it is unset and Spark runs locally."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="talkloom-work-")


class Work:
    """A folder for the tables of one operator run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/talkloom-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and continue from the copy: lineage ends here and lost executors cost nothing."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit; otherwise unchanged, to be joined by shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def internal(*names: str) -> list[str]:
    """Column names that cannot clash with those of a user's table."""
    return [f"__talkloom_{n}" for n in names]
