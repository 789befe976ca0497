"""The streaming pipeline: raw text -> bronze -> parsed -> enriched -> scored and
notified -> alert outbox. Each arrow is a query of its own that reads the table
of the one before, so any of them can be stopped, restarted or moved alone.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from paywarden.functions import notification as note
from paywarden.functions.records import content_key
from paywarden.layout import Layout
from paywarden.operators.enrich import KEY, hot_share, join_by_shuffle
from paywarden.operators.hitters import Frequent, refreshed, stream_counters
from paywarden.operators.hops import parse_records, refine, to_bronze, unparsed_lines
from paywarden.operators.sizing import BROADCAST_BYTES, measured_bytes
from paywarden.plans.training import known_categories, unscorable
from paywarden.schemas import BRONZE, FEATURES, RAW, RECORD, with_key
from paywarden.sources.landing import archive_files, landed_files
from paywarden.sources.readers import Admission, stream_table, stream_text, table_exists
from paywarden.streaming.history import BatchHistory
from paywarden.streaming.lifecycle import await_table
from paywarden.streaming.runner import AVAILABLE_NOW, start_hop


# Name of the key that records without an id get.
ROW_KEY = "row_key"
# Hops whose tables are partitioned.
PARTITIONED = {"bronze": ["dataset"], "account_counts": ["batch"]}


def notify(scored: DataFrame) -> DataFrame:
    """Scored rows with their notification status."""
    return scored.withColumn("notify_user", note.status())


def outbox(notified: DataFrame, key: Sequence[str], at: Column | None = None) -> DataFrame:
    """One alert per predicted fraud: text, webhook body, and whether there is
    anywhere to deliver it. `key` names the columns that identify the alert."""
    return (
        notified.filter(note.is_fraud())
        .withColumn("message", note.message(F.current_timestamp() if at is None else at))
        .select(
            *key,
            "userid",
            "webhook_url",
            note.deliverable().alias("deliverable"),
            "message",
            note.payload("message").alias("payload"),
        )
    )


@dataclass
class Pipeline:
    """The hops over one layout.

    key        columns in the records, before the record fields, that identify a row;
               without any, a hash of the record is added as `row_key`
    members    static member list, or None to leave the enrichment out
    model      fitted pipeline, or None to stop after the enrichment
    admission  limit on the input of one micro-batch, for every hop
    fmt        table format, streaming-capable
    name       prefix of the query names
    archive    whether landed files go to the archive folder once they are ingested
    history    whether `run` keeps a table of all batches
    """

    spark: SparkSession
    layout: Layout
    record: StructType = RECORD
    key: Sequence[str] = ()
    members: DataFrame | None = None
    model: PipelineModel | None = None
    admission: Admission = Admission()
    fmt: str = "parquet"
    name: str = "paywarden"
    broadcast_bytes: int = BROADCAST_BYTES
    archive: bool = False
    history: bool = False

    def bronze(self) -> DataFrame:
        # The source cleans up after a batch when it begins the next one.
        clean = {"cleanSource": "archive", "sourceArchiveDir": self.layout.archive} if self.archive else None
        return to_bronze(stream_text(self.spark, self.layout.source, self.admission, clean=clean))

    @property
    def row_key(self) -> list[str]:
        return list(self.key) or [ROW_KEY]

    @property
    def parsed_schema(self) -> StructType:
        return self.record if self.key else with_key(self.record, ROW_KEY, StringType())

    def parsed(self) -> DataFrame:
        rows = parse_records(self._read(self.layout.bronze, BRONZE), self.record)
        return rows if self.key else rows.select(content_key(*rows.columns).alias(ROW_KEY), "*")

    def unparsed(self) -> DataFrame:
        return unparsed_lines(self._read(self.layout.bronze, BRONZE), self.record).hint("rebalance")

    def enriched(self) -> DataFrame:
        refined = refine(self._read(self.layout.parsed, self.parsed_schema), self.row_key)
        if self.members is None:
            return refined
        if not self.shuffled:
            return refined.join(F.broadcast(self.members), KEY, "left")
        hot = self.frequent_accounts().shares(hot_share(self.spark))
        return join_by_shuffle(refined, self.members, hot)

    @cached_property
    def shuffled(self) -> bool:
        """Whether the member list measures too much to be broadcast."""
        return self.members is not None and measured_bytes(self.members) > self.broadcast_bytes

    @property
    def counters(self) -> int:
        """Of a summary: four for each account that can be hot, so none is missed, and a thousand at least."""
        return max(1_024, round(4 / hot_share(self.spark)))

    def account_counts(self) -> DataFrame:
        """The frequent accounts of each part of the parsed rows."""
        return stream_counters(self._read(self.layout.parsed, self.parsed_schema), F.col(KEY), self.counters)

    def frequent_accounts(self) -> Frequent:
        """The frequent accounts of all that was counted so far, kept between runs."""
        return refreshed(self.spark, self.layout.account_parts, self.layout.account_summary, self.counters)

    def skipped(self, enriched: StructType) -> DataFrame:
        """What the model leaves out: a missing input or an unknown category."""
        rows = self._read(self.layout.enriched, enriched)
        known = known_categories(self.model)
        return rows.filter(unscorable(rows, known, FEATURES)).hint("rebalance")

    def notified(self, enriched: StructType) -> DataFrame:
        return notify(self.model.transform(self._read(self.layout.enriched, enriched)))

    def outbox(self, notified: StructType) -> DataFrame:
        alerts = outbox(self._read(self.layout.notified, notified), self.row_key)
        # Frauds are rare: gather them, or every scan task writes a tiny file.
        return alerts.hint("rebalance")

    def run(self) -> list[StreamingQuery]:
        """Process what is there now, hop after hop, and end.

        A run takes all files that are there when it begins, so these are archived after it; a run that
        was cut off before leaves them to the next.
        """
        files = landed_files(self.spark, self.layout.source) if self.archive else []
        kept = self.batches() if self.history else None
        settle = kept.watch if kept else StreamingQuery.awaitTermination
        queries = self._start(AVAILABLE_NOW, lambda query, there: settle(query))
        for query in queries:
            settle(query)
        if files:
            archive_files(self.spark, files, self.layout.archive)
        return queries

    def batches(self) -> BatchHistory:
        """The batches of all runs that kept them."""
        return BatchHistory(self.spark, self.layout.history)

    def start(self, trigger: dict) -> list[StreamingQuery]:
        """Start all hops to run side by side. The next hop is started once its
        input exists: at once after a restart, else when the hop before has
        written its table, however long that takes."""
        return self._start(trigger, await_table)

    def _hops(self) -> Iterator[tuple[str, str, Callable[[StructType], DataFrame], bool]]:
        """Label, table path, the stream given the schema of the hop before, and
        whether the next hop reads it; side tables are read by nobody here."""
        yield "bronze", self.layout.bronze, lambda _: self.bronze(), True
        yield "lines_unparsed", self.layout.unparsed, lambda _: self.unparsed(), False
        yield "transactions_parsed", self.layout.parsed, lambda _: self.parsed(), True
        if self.shuffled:
            yield "account_counts", self.layout.account_parts, lambda _: self.account_counts(), False
        yield "transactions_enriched", self.layout.enriched, lambda _: self.enriched(), True
        if self.model is not None:
            if known_categories(self.model) is not None:
                yield "transactions_skipped", self.layout.skipped, self.skipped, False
            yield "transactions_notified", self.layout.notified, self.notified, True
            if self.members is not None:
                yield "alert_outbox", self.layout.outbox, self.outbox, True

    def _start(
        self, trigger: dict, settle: Callable[[StreamingQuery, Callable[[], bool]], object]
    ) -> list[StreamingQuery]:
        queries: list[StreamingQuery] = []
        schema, before = RAW, None
        try:
            for label, path, stream_of, feeds in self._hops():
                if before is not None:
                    source, input_path = before
                    # A stream learns the partitions of its source when it starts, so
                    # the one partitioned table must have rows by then.
                    filled = source.name.endswith("_bronze")
                    settle(source, lambda: table_exists(self.spark, input_path, schema, self.fmt, filled))
                if label == "transactions_enriched" and self.shuffled and trigger == AVAILABLE_NOW:
                    # A run that ends counts first. One that goes on takes the accounts known when it starts.
                    queries[-1].awaitTermination()
                stream = stream_of(schema)
                query = start_hop(
                    stream,
                    path,
                    self.layout.checkpoint(label),
                    name=f"{self.name}_{label}",
                    fmt=self.fmt,
                    trigger=trigger,
                    partition_by=PARTITIONED.get(label, ()),
                )
                queries.append(query)
                if feeds:
                    schema, before = stream.schema, (query, path)
        except BaseException:
            for query in queries:
                query.stop()
            raise
        return queries

    def _read(self, path: str, schema: StructType) -> DataFrame:
        return stream_table(self.spark, path, schema, self.fmt, self.admission)
