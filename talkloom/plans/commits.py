"""Which steps of which commits are through.

A commit is one attempt of one run of one stage. Its steps are marked by empty files, made and listed through
the file system that Spark itself uses, so a marker is there or not and costs no job:

    commits/<stage>/<run>/<attempt>.<step>      the step's data is written as a whole
    commits/<stage>/open/<run>@<attempt>        the commit was begun and is not through

A stage looks into ``open`` before it does anything: a commit that was cut short after its snapshot is carried to its
end from that snapshot, whichever run it belongs to; one without a whole snapshot has committed nothing and
is dropped. Nothing else of earlier runs is listed or read. One writer per stage at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

SNAPSHOT, MASTER, VALID, STATE, DONE = STEPS = ("snapshot", "master", "valid", "state", "done")


@dataclass(frozen=True)
class Folder:
    """A folder of markers on any Hadoop file system."""

    spark: SparkSession
    path: str

    def _at(self, name: str = ""):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def names(self) -> list[str]:
        files, place = self._at()
        return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []

    def has(self, name: str) -> bool:
        files, place = self._at(name)
        return files.exists(place)

    def put(self, name: str) -> None:
        files, place = self._at(name)
        files.create(place, True).close()

    def take(self, name: str) -> None:
        files, place = self._at(name)
        files.delete(place, False)


@dataclass(frozen=True)
class Commit:
    """One attempt of a run."""

    log: CommitLog
    run_id: str
    attempt: int

    @property
    def _name(self) -> str:
        return f"{quote(self.run_id, safe='')}@{self.attempt}"

    def done(self, step: str) -> bool:
        return self.log.run(self.run_id).has(f"{self.attempt}.{step}")

    def mark(self, step: str) -> None:
        self.log.run(self.run_id).put(f"{self.attempt}.{step}")
        if step == DONE:
            self.drop()

    def begin(self) -> None:
        self.log.open.put(self._name)

    def drop(self) -> None:
        self.log.open.take(self._name)


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    root: str
    stage: str

    @property
    def open(self) -> Folder:
        return Folder(self.spark, f"{self.root}/commits/{self.stage}/open")

    def run(self, run_id: str) -> Folder:
        return Folder(self.spark, f"{self.root}/commits/{self.stage}/runs/{quote(run_id, safe='')}")

    def attempts(self, run_id: str) -> list[int]:
        """Attempts of a run whose snapshot is whole."""
        return sorted(int(n.partition(".")[0]) for n in self.run(run_id).names() if n.endswith(f".{SNAPSHOT}"))

    def through(self, run_id: str) -> bool:
        """Whether some attempt of the run came to its end."""
        return any(n.endswith(f".{DONE}") for n in self.run(run_id).names())

    def next(self, run_id: str) -> Commit:
        """A new attempt; its number follows the last whole snapshot of the run."""
        return Commit(self, run_id, max(self.attempts(run_id), default=-1) + 1)

    def left_open(self) -> list[Commit]:
        out = []
        for name in self.open.names():
            run, _, attempt = name.rpartition("@")
            out.append(Commit(self, unquote(run), int(attempt)))
        return out
