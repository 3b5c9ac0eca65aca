"""What waits for a labeller: candidates and responses as tables that only grow.

Candidates are written before they are sent and never replaced; what waits is every
candidate whose key is in neither master nor state. A forced run asks for keys that are there already:
its candidates wait until a commit has taken the answer to their own batch (``settled``). So a run that takes a labeller also
takes the batches that an earlier run left, for want of one or after a failure. Responses
are written before they are used: a labeller is called once a batch, labels, errors and cost
speak of the same answer, and an answer whose run was lost is not paid for again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from talkloom.operators.batches import build_requests
from talkloom.operators.dedup import drop_repeats, relevant_history, skip_seen
from talkloom.operators.numbering import assign_batches
from talkloom.plans.commits import CommitLog
from talkloom.plans.store import Store
from talkloom.schemas import REQUEST, RESPONSE
from talkloom.session import settle
from talkloom.sources.tables import conform, read_table

Labeller = Callable[[DataFrame], DataFrame]

_SETTLED = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("attempt", T.IntegerType())])
_KEPT = T.StructType([*RESPONSE.fields, T.StructField("call", T.StringType())])


@dataclass(frozen=True)
class LabelQueue:
    spark: SparkSession
    store: Store
    stage: str
    candidate: T.StructType
    instructions: str
    answer_format: str

    def path(self, kind: str, run_id: str | None = None) -> str:
        root = f"{self.store.root}/requests/{self.stage}/{kind}"
        return root if run_id is None else f"{root}/run_id={run_id}"

    def candidates(self) -> DataFrame:
        return read_table(self.spark, self.path("candidates"), self.candidate)

    def put(self, rows: DataFrame, run_id: str, batch_size: int, forced: bool = False) -> DataFrame:
        """Add ``rows`` in batches of their own; returns them as written.

        A repeated run id adds to what its first attempt left. Prompts are derived from
        all candidates of the run id, so a replay completes them.
        """
        place = self.path("candidates", run_id)
        before = read_table(self.spark, place, self.candidate).count()
        prefix = f"{run_id}-{before}-" if before else f"{run_id}-"
        rows = rows.withColumn("forced", F.lit(run_id if forced else ""))
        batched = assign_batches(rows.withColumn("row_id", F.col("record_key")), "record_key", batch_size, prefix)
        batched.select(*self.candidate.fieldNames()).write.mode("append").parquet(place)
        written = read_table(self.spark, place, self.candidate)
        self._requests(written).write.mode("overwrite").parquet(self.path("prompts", run_id))
        return written.filter(F.col("batch_id").startswith(prefix)) if before else written

    def waiting(self, seen: DataFrame) -> DataFrame:
        """Candidates without a committed row, one of every key, and those of forced runs without a settled batch.

        Written down once: requests, answers, errors and counters of a run read the same rows.
        """
        rows = self.candidates()
        plain = rows.filter("forced = ''")
        plain = skip_seen(plain, relevant_history(seen, plain.select("record_key")))
        forced = rows.filter("forced <> ''").join(self._settled(), "batch_id", "left_anti")
        pending = F.concat_ws("|", "record_key", F.when(F.col("forced") != "", F.col("forced")))
        both = plain.unionByName(forced).withColumn("pending", pending)
        return settle(drop_repeats(both, "pending", ("batch_id", "ord")).drop("pending"))

    def settle(self, sent: DataFrame, responses: DataFrame, run_id: str) -> None:
        """Note which forced batches the commit that follows takes; it holds from that commit's snapshot on."""
        taken = sent.filter("forced <> ''").select("batch_id").distinct().join(responses.select("batch_id").distinct(), "batch_id", "left_semi")
        attempt = self._log.next(run_id).attempt
        taken.withColumn("attempt", F.lit(attempt)).write.mode("overwrite").parquet(f"{self.path('settled', run_id)}/taken={attempt}")

    def _settled(self) -> DataFrame:
        noted = read_table(self.spark, self.path("settled"), _SETTLED)
        commits = noted.select("run_id", "attempt").distinct().collect()  # one row per run that answered forced ones
        whole = [(r["run_id"], r["attempt"]) for r in commits if r["attempt"] in self._log.attempts(r["run_id"])]
        return noted.join(F.broadcast(self.spark.createDataFrame(whole, "run_id string, attempt int")), ["run_id", "attempt"]).select("batch_id")

    @property
    def _log(self) -> CommitLog:
        return CommitLog(self.spark, self.store.root, self.stage)

    def ask(self, waiting: DataFrame, labeller: Labeller, run_id: str) -> DataFrame:
        """Send the batches that have no good answer yet; returns the new responses."""
        answered = read_table(self.spark, self.path("responses"), _KEPT).filter("status = 'ok'").select("batch_id").distinct()
        offered = self.path("offers", run_id)
        self._requests(waiting.join(answered, "batch_id", "left_anti")).write.mode("overwrite").parquet(offered)
        return self.keep(labeller(read_table(self.spark, offered, REQUEST)), run_id)

    def keep(self, responses: DataFrame, run_id: str) -> DataFrame:
        """Write responses down, which is the only time their plan runs; returns the copy."""
        call = uuid.uuid4().hex
        place = self.path("responses", run_id)
        conform(responses, RESPONSE.fieldNames(), RESPONSE).withColumn("call", F.lit(call)).write.mode("append").parquet(place)
        return read_table(self.spark, place, _KEPT).filter(F.col("call") == call)

    def responses(self, waiting: DataFrame) -> DataFrame:
        """All kept responses to the batches of ``waiting``."""
        kept = read_table(self.spark, self.path("responses"), _KEPT)
        return kept.join(waiting.select("batch_id").distinct(), "batch_id", "left_semi")

    def answered(self, waiting: DataFrame, responses: DataFrame) -> DataFrame:
        """The waiting rows whose batch has a response."""
        return waiting.join(responses.select("batch_id").distinct(), "batch_id", "left_semi")

    def _requests(self, rows: DataFrame) -> DataFrame:
        return build_requests(rows, self.instructions, self.answer_format)
