"""Batches that are planned, read and committed in turn, so that a failed one is read again alike.

A plan is a small or large table that says what a batch reads. It is written aside and published by one
rename before anything is read by it, and a commit names it done. One reader at a time uses a state folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class PlannedBatches:
    """Plans `plan-<n>` and commits `commit-<n>` of one folder; subclasses plan and read."""

    def __init__(self, spark: SparkSession, state: str) -> None:
        self.spark, self.state = spark, state.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.state).getFileSystem(spark._jsc.hadoopConfiguration())

    def _plan(self, number: int) -> bool:
        """Publish the plan of a batch; False, and no plan, if there is nothing to read."""
        raise NotImplementedError

    def _rows(self, number: int) -> DataFrame:
        """What a published plan reads."""
        raise NotImplementedError

    def _numbers(self, prefix: str) -> list[int]:
        root = self._path(self.state)
        if not self._files.exists(root):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(root)]
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def _folder(self, number: int) -> str:
        return f"{self.state}/plan-{number}"

    def _publish(self, plan: DataFrame, number: int, wanted: Callable[[DataFrame], bool] | None = None) -> bool:
        """Write a plan and rename it into place, if what was written is `wanted`."""
        aside = f"{self.state}/_planning-{uuid.uuid4().hex}"
        plan.write.parquet(aside)
        if wanted is not None and not wanted(self.spark.read.schema(plan.schema).parquet(aside)):
            self._files.delete(self._path(aside), True)
            return False
        target = self._path(self._folder(number))
        if self._files.exists(target) or not self._files.rename(self._path(aside), target):
            raise RuntimeError(f"another reader has planned batch {number}")
        return True

    def committed(self) -> int:
        """Number of the last batch that was committed; -1 if none was."""
        return max(self._numbers("commit-"), default=-1)

    def next(self) -> tuple[int, DataFrame] | None:
        """(number, rows) of the next batch, or of the one that was planned and not committed; None if idle."""
        number = self.committed() + 1
        if number not in self._numbers("plan-") and not self._plan(number):
            return None
        return number, self._rows(number)

    def commit(self, number: int) -> None:
        """Name a batch done. Its plan is the state of the next; older plans and commits are removed."""
        self._files.create(self._path(f"{self.state}/commit-{number}"), True).close()
        for prefix in ("plan-", "commit-"):
            for old in self._numbers(prefix):
                if old < number - 1:
                    self._files.delete(self._path(f"{self.state}/{prefix}{old}"), True)

    def drain(self, sink: Callable[[DataFrame, int], None]) -> int:
        """Hand batches to `sink` until there is nothing to read; each is committed after it. Returns how many."""
        done = 0
        while (batch := self.next()) is not None:
            number, rows = batch
            sink(rows, number)
            self.commit(number)
            done += 1
        return done
