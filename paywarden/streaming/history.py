"""A table of the batches that streaming queries have run, kept beyond Spark's own last hundred."""

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from paywarden.sources.readers import table_exists
from paywarden.streaming.lifecycle import ran_batch

BATCHES = "name STRING, query STRING, batch BIGINT, rows BIGINT, duration_ms BIGINT, started_at STRING"


@dataclass
class BatchHistory:
    """Batches of the watched queries, appended to the table at `path` while they run.

    The queries are asked for what they have just done, several times a second, as
    listeners in Python would need a callback port. A batch that was pushed out of their
    memory between two looks is known by the gap in the numbers: its row has null rows.
    """

    spark: SparkSession
    path: str
    every_seconds: float = 60.0  # between appends
    look_seconds: float = 0.05
    clock: Callable[[], float] = time.monotonic
    _last: dict[str, int] = field(default_factory=dict)
    _new: list[tuple] = field(default_factory=list)
    _appended: float = field(default=float("-inf"))

    def look(self, query: StreamingQuery) -> None:
        """Note the batches that a query has finished since the last look."""
        for p in query.recentProgress:
            if not ran_batch(p):
                continue
            known = self._last.get(query.id)
            if known is not None and p.batchId <= known:
                continue
            for missed in range(p.batchId if known is None else known + 1, p.batchId):
                self._new.append((query.name, str(query.id), missed, None, None, None))
            self._last[query.id] = p.batchId
            self._new.append((query.name, str(query.id), p.batchId, p.numInputRows, p.batchDuration, p.timestamp))

    def flush(self) -> int:
        """Append what was noted; how many batches."""
        noted, self._new, self._appended = self._new, [], self.clock()
        if noted:
            self.spark.createDataFrame(noted, BATCHES).coalesce(1).write.mode("append").parquet(self.path)
        return len(noted)

    def watch(self, query: StreamingQuery) -> None:
        """Wait for a query to end and keep its batches; an error of the query is raised after that."""
        self._appended = self.clock()
        try:
            while not query.awaitTermination(self.look_seconds):
                self.look(query)
                if self.clock() - self._appended >= self.every_seconds:
                    self.flush()
        finally:
            self.look(query)
            self.flush()

    def read(self) -> DataFrame:
        """All batches that were ever kept there. A query that is restarted goes on with its numbers."""
        if not table_exists(self.spark, self.path, BATCHES):
            return self.spark.createDataFrame([], BATCHES)
        return self.spark.read.schema(BATCHES).parquet(self.path)
