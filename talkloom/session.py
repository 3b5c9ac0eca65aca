"""Session settings the jobs rely on, and the one place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that change results, so every stage sets them itself.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated object key keeps its last value instead of voiding the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    for name, value in RESULT_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written copy.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; a private
    one is made only where that is unset (local runs).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="talkloom-checkpoint-"))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few files the parallelism of the session.

    A file of one row group is read by one task, and so is all text work above it. A
    table of many files already has its tasks and is left alone, so nothing large is
    ever shuffled here. Select the needed columns first.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= tasks else df.repartition(tasks)
