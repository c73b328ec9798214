"""Aggregates over a growing table, kept as partial states that each update merges."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallywatch.session import child_names, remove

#: Versions that stay for readers which opened them before a switch.
KEPT = 3


@dataclass(frozen=True)
class Aggregate:
    """How rows become a state, two states become one, and a state becomes the result."""

    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame, DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunningTable:
    """The result over all batches taken so far.

    A version is a folder with the state, the result and, written last, the names of
    the batches it covers. That list is the commit: readers open the newest version that
    has it, so they never see half a result, and a stopped update is done again from the
    version before. One writer at a time.
    """

    spark: SparkSession
    path: str
    aggregate: Aggregate

    def latest(self) -> int:
        """Newest finished version; 0 before the first."""
        numbers = sorted((int(n.split("=")[1]) for n in child_names(self.spark, self.path) if n.startswith("version=")), reverse=True)
        return next((n for n in numbers if "_SUCCESS" in child_names(self.spark, f"{self._folder(n)}/covered")), 0)

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def covered(self) -> list[str]:
        """Batches in the newest version: one short row each."""
        version = self.latest()
        return sorted(r["batch"] for r in self.spark.read.parquet(f"{self._folder(version)}/covered").collect()) if version else []

    def read(self) -> DataFrame:
        version = self.latest()
        if version == 0:
            raise ValueError(f"no finished version in {self.path}")
        return self.spark.read.parquet(f"{self._folder(version)}/result")

    def update(self, batches: list[str], read: Callable[[list[str]], DataFrame]) -> list[str]:
        """Merge the batches that are not covered yet; returns them. ``read`` is asked for their rows only."""
        version = self.latest()
        known = self.covered()
        new = sorted(set(batches) - set(known))
        if not new and version:
            return []
        state = self.aggregate.partial(read(new))
        if version:
            state = self.aggregate.merge(self.spark.read.parquet(f"{self._folder(version)}/state"), state)
        folder = self._folder(version + 1)
        state.write.mode("overwrite").parquet(f"{folder}/state")
        self.aggregate.finish(self.spark.read.parquet(f"{folder}/state")).write.mode("overwrite").parquet(f"{folder}/result")
        names = self.spark.createDataFrame([(b,) for b in [*known, *new]], "batch string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{folder}/covered")
        if version + 1 > KEPT:
            remove(self.spark, self._folder(version + 1 - KEPT))
        return new
