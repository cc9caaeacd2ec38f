"""Small marks beside a checkpoint: running totals that outlast a restart, and which sinks a micro-batch has reached."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession

from tidemark.operators.summary import observe_ingest
from tidemark.schema import PROGRESS_EVERY
from tidemark.session import file_system, files_under, read_small, write_small


def _numbers(spark: SparkSession, home: str) -> list[int]:
    return sorted({int(n.rsplit("/batch=", 1)[1].split("/")[0]) for n, _, _ in files_under(spark, home) if "/batch=" in n})


def _forget(spark: SparkSession, home: str, batch_id: int) -> None:
    """Drop marks of micro-batches before the last one, which may run again."""
    for old in [n for n in _numbers(spark, home) if n < batch_id][:-1]:
        fs, path = file_system(spark, f"{home}/batch={old}")
        fs.delete(path, True)


class Ledger:
    """Totals of observed metrics by micro-batch; each mark holds the sums up to its micro-batch.

    A micro-batch that runs again replaces its mark, so nothing counts twice.
    """

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home

    def _before(self, batch_id: int | None) -> dict[str, int]:
        numbers = [n for n in _numbers(self.spark, self.home) if batch_id is None or n < batch_id]
        return json.loads(read_small(self.spark, f"{self.home}/batch={numbers[-1]}/totals.json")) if numbers else {}

    def add(self, batch_id: int, counts: dict[str, int]) -> tuple[dict[str, int], dict[str, int]]:
        """Totals before and after a micro-batch."""
        before = self._before(batch_id)
        after = {k: before.get(k, 0) + counts.get(k, 0) for k in {**before, **counts}}
        write_small(self.spark, f"{self.home}/batch={batch_id}/totals.json", json.dumps(after))
        _forget(self.spark, self.home, batch_id)
        return before, after

    def totals(self) -> dict[str, int]:
        return self._before(None)


class Observed:
    """Counts the checked rows of every micro-batch while a sink writes them (no pass of their own) and enters them in a ledger."""

    def __init__(self, ledger: Ledger):
        self.ledger, self.pending = ledger, {}

    def watch(self, checked: DataFrame, batch_id: int) -> DataFrame:
        self.pending[batch_id] = seen = Observation()
        return observe_ingest(checked, seen)

    def enter(self, batch_id: int) -> list[int]:
        """To be called once the micro-batch is written. Every thousandth good record that it brought."""
        before, after = self.ledger.add(batch_id, self.pending.pop(batch_id).get)
        first = before.get("good_records", 0) // PROGRESS_EVERY + 1
        return [n * PROGRESS_EVERY for n in range(first, after["good_records"] // PROGRESS_EVERY + 1)]


class Once:
    """Which sinks of a fan-out have a micro-batch already."""

    def __init__(self, home: str):
        self.home = home

    def _mark(self, batch_id, sink: int) -> str:
        return f"{self.home}/batch={str(batch_id).split('-')[0]}/{batch_id}-sink={sink}"

    def done(self, spark: SparkSession, batch_id, sink: int) -> bool:
        fs, path = file_system(spark, self._mark(batch_id, sink))
        return fs.exists(path)

    def mark(self, spark: SparkSession, batch_id, sink: int) -> None:
        write_small(spark, self._mark(batch_id, sink), "done")
        _forget(spark, self.home, int(str(batch_id).split("-")[0]))
