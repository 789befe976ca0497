"""An aggregate kept up to date part by part.

Each landed part is aggregated once, into partial sums and counts that can be added up.
Reading adds what is there; old parts are never read again. A compaction adds the
partials of many parts into one table, so that reading stays cheap.

Every write goes to a folder of its own, named by the part or by a number, that counts only when
it is complete. So a part that is added twice counts once, and a write that is cut off is
made again; there is one writer at a time.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Partials:
    """Partial aggregates below `path`.

    partial  makes them from the rows of a part: the columns `keys`, then `sums`
    keys     columns of a group
    sums     columns that add up
    schema   of both, as DDL
    """

    spark: SparkSession
    path: str
    partial: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    sums: Sequence[str]
    schema: str

    def add(self, part: str, rows: DataFrame) -> bool:
        """Add a part; whether it was new."""
        if part in self.parts() or part in self.covered():
            return False
        self.partial(rows).select(*self.keys, *self.sums).write.mode("overwrite").parquet(f"{self.path}/parts/{part}")
        return True

    def parts(self) -> list[str]:
        """The parts that lie by themselves."""
        return self._complete("parts")

    def covered(self) -> set[str]:
        """The parts that the newest compacted table holds."""
        base = self._base()
        return set() if base is None else {r["part"] for r in self._read(f"{base}/covers", "part STRING").collect()}

    def read(self) -> DataFrame:
        """The aggregate of all parts."""
        base, covered = self._base(), self.covered()
        # A part may be covered and still lie by itself.
        paths = [f"{self.path}/parts/{p}" for p in self.parts() if p not in covered]
        paths += [] if base is None else [f"{base}/sums"]
        rows = self._read(paths, self.schema) if paths else self.spark.createDataFrame([], self.schema)
        types = {f.name: f.dataType for f in rows.schema.fields}
        added = rows.groupBy(*self.keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in self.sums])
        return added

    def compact(self) -> int:
        """Add all partials into a new table that covers them; how many parts it covers."""
        covers = sorted(self.covered() | set(self.parts()))
        number = 1 + max((int(n) for n in self._complete("bases", "covers")), default=0)
        base = f"{self.path}/bases/{number}"
        self.read().write.mode("overwrite").parquet(f"{base}/sums")
        # Written last: with it the new table counts.
        names = self.spark.createDataFrame([(p,) for p in covers], "part STRING")
        names.coalesce(1).write.mode("overwrite").parquet(f"{base}/covers")
        return len(covers)

    def _base(self) -> str | None:
        numbers = self._complete("bases", "covers")
        return f"{self.path}/bases/{max(numbers, key=int)}" if numbers else None

    def _complete(self, kind: str, inner: str = "") -> list[str]:
        """Names of the complete folders of a kind: those whose job has left its mark."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(folder):
            return []
        mark = "/".join(x for x in (inner, "_SUCCESS") if x)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(f.getPath().getName() for f in store.listStatus(folder) if store.exists(path(f.getPath(), mark)))

    def _read(self, paths: str | list[str], schema: str | StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))
