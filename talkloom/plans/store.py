"""Where stage tables live and how a stage commits its rows.

Commit order: run snapshot, master, valid-only rows, state. The snapshot is the one place where the
stage's plan is evaluated; the others are fed from the written files, so a lost
executor can not make them disagree. Every step replaces its own output and is marked when it is
through (``commits``): after a lost driver the next run of the stage first carries the open
commit to its end, so nothing is lost, repeated or worked out twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from talkloom.functions.keys import row_key
from talkloom.functions.text import blank_if_null, null_if_blank
from talkloom.plans.commits import DONE, MASTER, SNAPSHOT, STATE as STATE_STEP, VALID, Commit, CommitLog
from talkloom.schemas import QUARANTINE, ROW_ORD, STATE, STATE_COLUMNS
from talkloom.session import settle
from talkloom.sources.tables import conform, read_table

_TECHNICAL = [T.StructField(ROW_ORD, T.ArrayType(T.LongType())), T.StructField("run_id", T.StringType())]
ORDER = ("run_id", ROW_ORD)


@dataclass(frozen=True)
class Store:
    """A folder (any Spark file system) that holds the tables of one corpus."""

    root: str

    def master(self, table: str) -> str:
        return f"{self.root}/master/{table}"

    def state(self, stage: str) -> str:
        return f"{self.root}/state/{stage}"

    def snapshot(self, stage: str, run_id: str, table: str) -> str:
        return f"{self.root}/{stage}/{run_id}/{table}"

    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


def stage_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + _TECHNICAL)


def read_master(spark: SparkSession, store: Store, table: str, schema: T.StructType) -> DataFrame:
    """A master table with its columns, the input order and the run that added each row."""
    return read_table(spark, store.master(table), stage_schema(schema))


def read_state(spark: SparkSession, store: Store, stage: str) -> DataFrame:
    return read_table(spark, store.state(stage), STATE)


def _consumed_path(store: Store, stage: str) -> str:
    return f"{store.root}/state/{stage}_consumed"


_CONSUMED = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("rows", T.LongType())])


def run_sizes(master: DataFrame) -> DataFrame:
    """(run_id, rows) of a master table, from partition values and row counts alone."""
    return master.groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"))


def unread_runs(spark: SparkSession, store: Store, stage: str, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(master rows a stage has not gone through, sizes of the runs they come from).

    A stage reads the whole master of the stage before it and skips what it has seen.
    Runs it went through completely hold nothing else, so their partitions are not
    scanned again. A run counts as gone through only while it has the same number of
    rows; masters only grow, so a run that was added to is read again.
    """
    consumed = read_table(spark, _consumed_path(store, stage), _CONSUMED)
    # One short row per run on the driver, the same list Spark keeps of the partitions.
    done = {(r["run_id"], r["rows"]) for r in consumed.collect()}
    sizes = [(r["run_id"], r["rows"]) for r in run_sizes(master).collect()]
    unread = [s for s in sizes if s not in done]
    rows = master.filter(F.col("run_id").isin([run for run, _ in unread])) if len(unread) < len(sizes) else master
    return rows, spark.createDataFrame(unread, _CONSUMED)


def mark_consumed(sizes: DataFrame, store: Store, stage: str) -> None:
    append_table(sizes, _consumed_path(store, stage))


def file_order(df: DataFrame) -> DataFrame | None:
    """A scan of Parquet files with ``row_ord``: place of the file among the sorted paths, row in the file.

    However the scan is cut and packed into tasks, a row has the same place. The places are a table with a
    row per file, numbered by Spark. None where the rows do not come from such files.
    """
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return None
    paths = placed.select("_path").distinct()
    files = paths.withColumn("_file", F.row_number().over(Window.orderBy("_path")).cast("bigint"))
    return placed.join(files, "_path").withColumn(ROW_ORD, F.array("_file", "_row")).select(*df.columns, ROW_ORD)


def ordered_source(df: DataFrame) -> DataFrame:
    """A stage input with its order columns; plain Parquet files are ordered by path and row, others as scanned."""
    if ROW_ORD not in df.columns:
        placed = file_order(df)
        df = placed if placed is not None else df.withColumn(ROW_ORD, F.array(F.monotonically_increasing_id()))
    if "run_id" not in df.columns:
        df = df.withColumn("run_id", F.lit(""))
    return df


def write_table(df: DataFrame, path: str, columns) -> None:
    """Overwrite with exactly ``columns``: blank where missing, extras ignored."""
    conform(df, columns).write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, columns) -> None:
    """A table as CSV that ``read_table(..., "csv")`` and any RFC 4180 reader gives back:
    line breaks, quotes and outer blanks survive, missing values are empty cells."""
    conform(df, columns).write.mode("overwrite").options(
        header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def append_table(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Append and return the number of rows; no rows create nothing."""
    rows = df.count()
    if rows == 0:
        return 0
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return rows


def state_rows(rows: DataFrame, stage: str, run_ts: str | Column, key: Column | None = None) -> DataFrame:
    """State table rows: one per record, all with the timestamp of the run."""
    present = set(rows.columns)
    values = {
        "stage": F.lit(stage),
        "record_key": key if key is not None else (F.col("record_key") if "record_key" in present else row_key()),
        "processed_at_utc": run_ts if isinstance(run_ts, Column) else F.lit(run_ts),
    }
    for name in ("platform", "id", "associated_id"):
        values[name] = blank_if_null(name) if name in present else F.lit("")
    return rows.select(*[values[c].alias(c) for c in STATE_COLUMNS])


@dataclass(frozen=True)
class Sink:
    """Where the rows of one stage go. ``key`` and ``valid`` give columns, made when they are needed."""

    stage: str
    table: str
    schema: T.StructType
    key: Callable[[], Column] | None = None
    partition_by: str | None = None
    valid_table: str | None = None
    valid: Callable[[], Column] | None = None


def snapshot_path(store: Store, sink: Sink, run_id: str, attempt: int, table: str | None = None) -> str:
    """Where an attempt keeps its rows; a repeated run leaves the rows of its first attempt alone."""
    run = run_id if attempt == 0 else f"{run_id}/attempt-{attempt}"
    return store.snapshot(sink.stage, run, table or sink.table)


def read_snapshots(spark: SparkSession, store: Store, sink: Sink, run_id: str) -> DataFrame:
    """The rows of all attempts of a run."""
    schema = T.StructType(sink.schema.fields + _TECHNICAL[:1])
    rows = None
    for attempt in CommitLog(spark, store.root, sink.stage).attempts(run_id):
        part = read_table(spark, snapshot_path(store, sink, run_id, attempt), schema)
        rows = part if rows is None else rows.unionByName(part)
    return spark.createDataFrame([], schema) if rows is None else rows


def recover(spark: SparkSession, store: Store, sink: Sink) -> list[str]:
    """Carry commits that were cut short to their end, before a stage looks at what it has seen."""
    ended = []
    for commit in CommitLog(spark, store.root, sink.stage).left_open():
        if commit.done(SNAPSHOT):
            finish(spark, store, sink, commit)
            ended.append(commit.run_id)
        else:
            commit.drop()
    return ended


def is_committed(spark: SparkSession, store: Store, stage: str, run_id: str) -> bool:
    return CommitLog(spark, store.root, stage).through(run_id)


def commit_rows(rows: DataFrame, store: Store, sink: Sink, run_id: str, run_ts: str) -> DataFrame:
    """Write one stage's new rows to snapshot, master and state; returns the snapshot.

    Each step replaces what it wrote before as a whole and is marked when it is through, so a repeat after a
    crash at any point writes every row once.
    """
    recover(rows.sparkSession, store, sink)
    return finish(rows.sparkSession, store, sink, write_snapshot(rows, store, sink, run_id, run_ts))


def write_snapshot(rows: DataFrame, store: Store, sink: Sink, run_id: str, run_ts: str) -> Commit:
    """The first step of a commit: from here on it will be carried to its end, by this run or by the next."""
    commit = CommitLog(rows.sparkSession, store.root, sink.stage).next(run_id)
    commit.begin()
    path = snapshot_path(store, sink, run_id, commit.attempt)
    out = rows.select(*sink.schema.fieldNames(), ROW_ORD).withColumn("processed_at_utc", F.lit(run_ts))
    if sink.partition_by is not None:
        # A blank platform would otherwise become Hive's default partition.
        part = F.coalesce(null_if_blank(sink.partition_by), F.lit("unknown"))
        out.withColumn(f"{sink.partition_by}_part", part).write.mode("overwrite").partitionBy(f"{sink.partition_by}_part").parquet(path)
    else:
        out.write.mode("overwrite").parquet(path)
    commit.mark(SNAPSHOT)
    return commit


def finish(spark: SparkSession, store: Store, sink: Sink, commit: Commit) -> DataFrame:
    """The steps after the snapshot, all fed from it; those marked are left out. Returns the attempt's rows."""
    stamped = read_snapshots(spark, store, sink, commit.run_id).withColumn("run_id", F.lit(commit.run_id))
    if not commit.done(MASTER):
        replace_run(stamped, store.master(sink.table))
        commit.mark(MASTER)
    own = read_table(
        spark,
        snapshot_path(store, sink, commit.run_id, commit.attempt),
        T.StructType([*sink.schema.fields, *_TECHNICAL[:1], T.StructField("processed_at_utc", T.StringType())]),
    )
    if sink.valid_table is not None and not commit.done(VALID):
        # Both valid-only tables exist even when nothing was valid.
        valid_copy = snapshot_path(store, sink, commit.run_id, commit.attempt, sink.valid_table)
        own.drop("processed_at_utc").filter(sink.valid()).write.mode("overwrite").parquet(valid_copy)
        write_valid(stamped, store, sink)
        commit.mark(VALID)
    if not commit.done(STATE_STEP):
        key = sink.key() if sink.key is not None else None
        state = state_rows(own, sink.stage, F.col("processed_at_utc"), key)
        # An attempt has a folder of its own, so writing it again replaces it.
        state.write.mode("overwrite").parquet(f"{store.state(sink.stage)}/commit={quote(commit.run_id, safe='')}@{commit.attempt}")
        commit.mark(STATE_STEP)
    commit.mark(DONE)
    return own.drop("processed_at_utc")


def replace_run(stamped: DataFrame, path: str) -> None:
    """Write the rows of one run as its partition, in place of what was there; no rows create nothing."""
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def write_valid(stamped: DataFrame, store: Store, sink: Sink) -> None:
    """The valid-only rows of one run. Runs without any are known by their commit alone and are never looked at again."""
    replace_run(stamped.filter(sink.valid()), store.master(sink.valid_table))


def commit_stage(
    rows: DataFrame,
    store: Store,
    stage: str,
    table: str,
    schema: T.StructType,
    run_id: str,
    run_ts: str,
    key: Column | None = None,
    partition_by: str | None = None,
    valid_table: str | None = None,
    valid_filter: Column | None = None,
) -> DataFrame:
    """``commit_rows`` for a sink described by its parts."""
    sink = Sink(stage, table, schema, None if key is None else lambda: key, partition_by, valid_table, lambda: valid_filter)
    return commit_rows(rows, store, sink, run_id, run_ts)


def quarantine(errors: DataFrame, store: Store) -> int:
    # Counted and written, hence evaluated once.
    return append_table(settle(conform(errors, QUARANTINE.fieldNames())), store.quarantine())


def write_summary(metrics: DataFrame, store: Store, stage: str, run_id: str, name: str = "summary") -> DataFrame:
    """Summary rows, sorted by metric and key, as JSON lines of the run."""
    path = store.snapshot(stage, run_id, name)
    stamped = metrics.select(F.lit(stage).alias("stage"), F.lit(run_id).alias("run_id"), "*")
    stamped.orderBy(*[c for c in ("metric", "key", "model_used") if c in metrics.columns]).write.mode("overwrite").json(path)
    return metrics.sparkSession.read.schema(stamped.schema).json(path)
