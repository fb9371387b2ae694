"""What a flow did, table by table; one failing table does not stop the others."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from zonewright.session import shuffles_cleared

# Tables of one flow that are written at the same time.
PARALLEL_TABLES = 4


@dataclass
class TableResult:
    table: str
    rows: int | None = None
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


class Skipped(RuntimeError):
    """A table was not tried, as what it is made from is not there."""


class FlowFailed(RuntimeError):
    """At least one table of a flow failed."""


@dataclass
class FlowReport:
    results: list[TableResult] = field(default_factory=list)
    metrics: dict[str, int] = field(default_factory=dict)

    def run(self, table: str, step: Callable[[], int]) -> None:
        """Run one table's step and note its row count or its error."""
        try:
            self.results.append(TableResult(table, rows=step()))
        except Exception as failure:  # noqa: BLE001 - reported, and raised by finish()
            self.results.append(TableResult(table, error=f"{type(failure).__name__}: {failure}"))

    def run_all(
        self,
        spark: SparkSession,
        steps: Mapping[str, Callable[[], int]],
        parallel: int = PARALLEL_TABLES,
    ) -> None:
        """Run independent tables side by side, so that one table's last tasks and
        commits do not leave the executors idle. Results keep the given order. Shuffle
        files go with the query that made them."""
        with shuffles_cleared(spark), ThreadPoolExecutor(max_workers=parallel) as pool:
            for _ in pool.map(
                inheritable_thread_target(spark)(lambda item: self.run(*item)), steps.items()
            ):
                pass
        order = {table: i for i, table in enumerate(steps)}
        self.results.sort(key=lambda r: order.get(r.table, -1))

    def finish(self) -> FlowReport:
        """The report itself, or ``FlowFailed`` that names every failed table."""
        failed = [r for r in self.results if not r.ok]
        if failed:
            raise FlowFailed("; ".join(f"{r.table}: {r.error}" for r in failed))
        return self
