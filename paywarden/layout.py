"""Where the tables, checkpoints and model of one pipeline live, and where
scratch runs go."""

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


# The folder names below the root.


@dataclass(frozen=True)
class Layout:
    """Paths below one root. Every writing query has a checkpoint of its own."""

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def source(self) -> str:
        return self._at("source")

    @property
    def bronze(self) -> str:
        return self._at("bronze")

    @property
    def parsed(self) -> str:
        return self._at("silver", "transactions_parsed")

    @property
    def enriched(self) -> str:
        return self._at("silver", "transactions_enriched")

    @property
    def unparsed(self) -> str:
        return self._at("silver", "lines_unparsed")

    @property
    def skipped(self) -> str:
        return self._at("silver", "transactions_skipped")

    @property
    def notified(self) -> str:
        return self._at("gold", "transactions_notified")

    @property
    def outbox(self) -> str:
        return self._at("gold", "alert_outbox")

    @property
    def archive(self) -> str:
        return self._at("archive")

    @property
    def history(self) -> str:
        return self._at("state", "batches")

    @property
    def account_parts(self) -> str:
        return self._at("state", "account_counts")

    @property
    def account_summary(self) -> str:
        return self._at("state", "account_summary")

    @property
    def model(self) -> str:
        return self._at("model")

    def checkpoint(self, hop: str) -> str:
        return self._at("checkpoints", hop)


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session may go without it: there a folder on this machine is
    visible to every task.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def new_layout(spark: SparkSession) -> Layout:
    """A layout in a folder no other run uses."""
    return Layout(f"{shared_root(spark)}/run-{uuid.uuid4().hex}")
