import time

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from paywarden import inputs
from paywarden.inputs import KEY, KEYED_RECORD
from paywarden.operators.enrich import join_members
from paywarden.operators.hops import multiplex, parse_records, refine, to_bronze
from paywarden.operators.prepare import training_frame
from paywarden.plans import training
from paywarden.plans.pipeline import ROW_KEY, Pipeline, notify
from paywarden.plans.views import register_views
from paywarden.sources.landing import archive_files, landed_files
from paywarden.sources.readers import Admission, freshness, read_table, stream_text
from paywarden.sources.writers import export_json_lines
from paywarden.streaming.history import BatchHistory
from paywarden.streaming.lifecycle import hop_counts, progress_frame, stop_queries, stop_when_idle
from paywarden.streaming.runner import CONTINUAL, preview, run_hop, start_hop, to_console
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def given(spark, sf):
    return inputs.transactions(spark, sf)


@pytest.fixture(scope="module")
def members(spark, sf):
    return inputs.members(spark, sf)


@pytest.fixture(scope="module")
def model(given):
    return training.fit(training_frame(given).drop(KEY), tuning=None).model


def land(df, layout, files=1):
    """Append the rows as `files` JSON-lines files to the source folder."""
    text = df.select(F.to_json(F.struct("*")).alias("data")).repartition(files)
    text.write.mode("append").text(layout.source)


def job(spark, layout, members=None, **options):
    return Pipeline(
        spark, layout, record=KEYED_RECORD, key=[KEY], members=members, **options
    )


def test_one_file_per_batch(spark, given, layout):
    land(given, layout, files=3)
    raw = stream_text(spark, layout.source, Admission(max_files=1))
    query = run_hop(to_bronze(raw), layout.bronze, layout.checkpoint("bronze"), name="one_file")
    batches = rows(progress_frame(spark, [query]), "name", "batchId", "numInputRows")
    assert [b[:2] for b in batches] == [("one_file", 0), ("one_file", 1), ("one_file", 2)]
    assert sum(n for *_, n in batches) == given.count()
    bronze = read_table(spark, layout.bronze)
    assert bronze.columns == ["receipt_time", "dataset", "data"]
    assert bronze.select("receipt_time").distinct().count() == 3  # one stamp per batch


def test_two_datasets_in_one_table(spark, given, layout):
    """Each dataset is read back alone, from its own partition."""
    land(given, layout)
    other = layout.source + "_invoices"
    spark.createDataFrame([('{"step":1}',), ('{"step":2}',)], "data STRING").write.text(other)
    both = multiplex(
        {"transactions": stream_text(spark, layout.source), "invoices": stream_text(spark, other)}
    )
    run_hop(both, layout.bronze, layout.checkpoint("bronze"), partition_by=["dataset"])
    bronze = read_table(spark, layout.bronze)
    assert bronze.count() == given.count() + 2
    assert rows(parse_records(bronze, KEYED_RECORD)) == rows(given)
    assert rows(parse_records(bronze, dataset="invoices"), "step") == [(1,), (2,)]


def test_partitioned_table_needs_no_sort(spark, given, layout):
    land(given, layout)
    bronze = to_bronze(stream_text(spark, layout.source))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    run_hop(bronze, layout.bronze, layout.checkpoint("bronze"), partition_by=["dataset"])
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    pruned = read_table(spark, layout.bronze).filter("dataset = 'transactions'")
    assert pruned.count() == given.count()
    assert "PartitionFilters: [isnotnull(dataset" in plan(pruned)


def test_bytes_per_batch_and_one_limit_only(spark, given, layout):
    land(given, layout, files=4)
    raw = stream_text(spark, layout.source, Admission(max_bytes=100_000))
    query = run_hop(to_bronze(raw), layout.bronze, layout.checkpoint("bronze"))
    assert len(query.recentProgress) > 1
    assert read_table(spark, layout.bronze).count() == given.count()
    with pytest.raises(ValueError):
        Admission(max_files=1, max_bytes=1).options()
    assert Admission().options() == {}


def test_stream_gives_the_batch_result(spark, given, members, model, layout):
    land(given, layout, files=3)
    job(spark, layout, members, model=model, admission=Admission(max_files=2)).run()
    refined = refine(given, [KEY])
    enriched = join_members(refined, members)
    plain = [KEY, "amount", "userid", "prediction", "notify_user"]
    assert rows(read_table(spark, layout.parsed)) == rows(given)
    assert rows(read_table(spark, layout.enriched)) == rows(enriched)
    assert rows(read_table(spark, layout.notified), *plain) == rows(
        notify(model.transform(enriched)), *plain
    )
    scored = read_table(spark, layout.notified)
    assert {"features", "rawPrediction", "probability"} <= set(scored.columns)


def test_large_member_list_in_a_stream(spark, given, members, layout):
    land(given, layout, files=2)
    job(spark, layout, members, broadcast_bytes=0).run()
    assert rows(read_table(spark, layout.enriched)) == rows(
        join_members(refine(given, [KEY]), members)
    )


def test_restart_takes_each_row_once(spark, given, members, model, layout):
    first, later = given.filter("event_id < 600"), given.filter("event_id >= 600")
    run = lambda: job(spark, layout, members, model=model).run()
    alerts = lambda: rows(read_table(spark, layout.outbox), KEY)
    land(first, layout)
    run()
    assert rows(read_table(spark, layout.enriched), KEY) == rows(first, KEY)
    early = alerts()
    assert early
    run()  # nothing new
    assert rows(read_table(spark, layout.enriched), KEY) == rows(first, KEY)
    assert alerts() == early
    land(later, layout)
    queries = run()
    assert rows(read_table(spark, layout.notified), KEY) == rows(given, KEY)
    assert queries[0].recentProgress[-1].numInputRows == later.count()
    assert len(alerts()) == len(set(alerts())) > len(early)  # no alert twice
    fraud = read_table(spark, layout.notified).filter("prediction = 1")
    assert alerts() == rows(fraud, KEY)


def test_a_repeated_batch_is_not_seen_twice(spark, given, layout):
    """A batch whose commit got lost is written again, and still counts once."""
    land(given, layout)
    raw = lambda: to_bronze(stream_text(spark, layout.source))
    run_hop(raw(), layout.bronze, layout.checkpoint("bronze"))
    before = rows(read_table(spark, layout.bronze))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    commits = hadoop.Path(layout.checkpoint("bronze") + "/commits")
    files = commits.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in ("0", ".0.crc"):
        files.delete(hadoop.Path(commits, name), False)
    run_hop(raw(), layout.bronze, layout.checkpoint("bronze"))
    assert rows(read_table(spark, layout.bronze)) == before


def test_rare_alerts_are_gathered(spark, given, members, model, layout):
    """Many input files, few alerts: one output file per batch, not one per task."""
    land(given, layout, files=6)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task per file
    try:
        job(spark, layout, members, model=model).run()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert data_files(spark, layout.notified) == 6
    assert data_files(spark, layout.outbox) == 1


def data_files(spark, path):
    """Number of data files of a table."""
    return len({r[0] for r in read_table(spark, path).select("_metadata.file_path").collect()})


def test_blank_and_broken_lines_travel_as_empty_rows(spark, layout):
    lines = spark.createDataFrame([('{"event_id":1,"step":30}',), ("",), ("oops",)], "data STRING")
    lines.write.text(layout.source)
    job(spark, layout).run()
    assert rows(read_table(spark, layout.enriched), KEY, "hour") == [(1, 6), (None, None), (None, None)]


def test_side_by_side_queries_stop_when_idle(spark, given, members, model, layout):
    land(given, layout, files=2)
    running = job(spark, layout, members, model=model, name="live").start(CONTINUAL)
    assert len(running) == 7 and all(q.isActive for q in running)
    extra = given.withColumn(KEY, F.col(KEY) + 1_000_000)
    land(extra, layout)
    idle = stop_when_idle(running, idle_seconds=4, check_seconds=0.5)
    assert idle > 4
    assert not any(q.isActive for q in running)
    assert read_table(spark, layout.notified).count() == 2 * given.count()


def test_a_continual_job_restarts_without_new_input(spark, given, members, model, layout):
    land(given, layout)
    for _ in range(2):
        running = job(spark, layout, members, model=model, name="again").start(CONTINUAL)
        stop_when_idle(running, idle_seconds=3, check_seconds=0.5)
    assert read_table(spark, layout.notified).count() == given.count()


def test_files_of_any_age_are_read(spark, given, sf, layout):
    for half, days in ((0, 0), (1, 30)):
        inputs.land_half(spark, sf, layout, half, days)
        run_hop(to_bronze(stream_text(spark, layout.source)), layout.bronze, layout.checkpoint("bronze"))
    assert read_table(spark, layout.bronze).count() == given.count()


def test_counts_do_not_depend_on_the_kept_progress(spark, given, layout):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        land(given, layout, files=5)
        job(spark, layout, admission=Admission(max_files=1)).run()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    counts = hop_counts(spark, {"a": layout.bronze, "b": layout.parsed, "c": layout.enriched})
    assert rows(counts) == [(h, given.count()) for h in "abc"]


def test_lines_that_are_no_records_have_a_side_table(spark, layout):
    lines = spark.createDataFrame([('{"event_id":1,"step":30}',), ("",), ("oops",), ("[1]",)], "data STRING")
    lines.write.text(layout.source)
    job(spark, layout).run()
    side = read_table(spark, layout.unparsed)
    assert rows(side, "dataset", "data") == [("transactions", ""), ("transactions", "[1]"), ("transactions", "oops")]
    assert side.filter("receipt_time IS NULL").count() == 0


def test_scored_and_skipped_make_all_rows(spark, given, members, model, layout):
    gaps = given.withColumn("type", F.when(F.col(KEY) % 9 == 0, None).when(F.col(KEY) % 9 == 1, "NEW").otherwise(F.col("type")))
    land(gaps.withColumn("amount", F.when(F.col(KEY) % 7 != 0, F.col("amount"))), layout)
    job(spark, layout, members, model=model).run()
    scored, skipped = read_table(spark, layout.notified), read_table(spark, layout.skipped)
    assert skipped.count() > 0
    assert rows(scored.select(KEY).union(skipped.select(KEY))) == rows(given.select(KEY))


def test_records_without_id_get_a_key(spark, given, members, layout):
    land(given.drop(KEY), layout)
    rule = SQLTransformer(statement="SELECT *, CASE WHEN amount > 100 THEN 1D ELSE 0D END AS prediction FROM __THIS__")
    Pipeline(spark, layout, members=members, model=PipelineModel([rule])).run()
    alerts = read_table(spark, layout.outbox)
    assert alerts.columns[0] == ROW_KEY and alerts.filter(f"length({ROW_KEY}) = 64").count() == alerts.count() > 0


def test_idle_clock_restarts_with_new_input(spark, given, layout):
    land(given, layout)
    query = start_hop(
        to_bronze(stream_text(spark, layout.source)), layout.bronze,
        layout.checkpoint("bronze"), trigger=CONTINUAL,
    )
    start = time.monotonic()
    stop_when_idle([query], idle_seconds=1, check_seconds=0.2)
    assert time.monotonic() - start > 1
    assert read_table(spark, layout.bronze).count() == given.count()


def test_a_long_batch_is_not_cut_off(spark, layout):
    spark.range(1).selectExpr("'x' AS data").write.text(layout.source)
    slow = stream_text(spark, layout.source).withColumn(
        "slept", F.expr("reflect('java.util.concurrent.locks.LockSupport', 'parkNanos', 5000000000L)")
    )
    query = start_hop(slow, layout.bronze, layout.checkpoint("bronze"), trigger=CONTINUAL)
    stop_when_idle([query], idle_seconds=1, check_seconds=0.2)
    assert read_table(spark, layout.bronze).count() == 1


def test_a_failing_query_is_reported(spark, layout):
    spark.createDataFrame([("x",)], "data STRING").write.text(layout.source)
    broken = stream_text(spark, layout.source).select(F.raise_error(F.lit("broken")).alias("data"))
    query = start_hop(broken, layout.bronze, layout.checkpoint("bronze"), trigger=CONTINUAL)
    good = start_hop(stream_text(spark, layout.source), layout.parsed, layout.checkpoint("good"), trigger=CONTINUAL)
    with pytest.raises(Exception, match="broken"):
        stop_when_idle([good, query], idle_seconds=30, check_seconds=0.2)
    assert not good.isActive


def test_stop_by_name(spark, given, layout):
    land(given, layout)
    raw = to_bronze(stream_text(spark, layout.source))
    mine = start_hop(raw, layout.bronze, layout.checkpoint("a"), name="mine_a", trigger=CONTINUAL)
    other = start_hop(raw, layout.parsed, layout.checkpoint("b"), name="other", trigger=CONTINUAL)
    assert stop_queries(spark, "mine_") == ["mine_a"]
    assert not mine.isActive and other.isActive
    assert stop_queries(spark) == ["other"]
    assert spark.streams.active == []


def test_status_and_last_progress(spark, given, layout):
    land(given, layout)
    query = run_hop(
        to_bronze(stream_text(spark, layout.source)), layout.bronze, layout.checkpoint("bronze")
    )
    assert query.lastProgress.numInputRows == given.count()
    assert query.status["isDataAvailable"] is False


def test_preview_and_console(spark, given, layout):
    land(given, layout)
    raw = stream_text(spark, layout.source)
    assert preview(raw, "peek").count() == given.count() == spark.table("peek").count()
    assert preview(raw, "few", rows=7).count() == 7
    read = []
    for _ in range(2):  # with its checkpoint, a second console has nothing left to print
        console = to_console(raw, layout.checkpoint("console"), rows=3)
        console.awaitTermination()
        read.append(sum(p.numInputRows for p in console.recentProgress))
    assert read == [given.count(), 0]


def test_batches_are_kept_beyond_those_that_spark_keeps(spark, given, layout):
    land(given, layout, files=9)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        runs = job(spark, layout, admission=Admission(max_files=1), history=True, name="long")
        queries = runs.run()
        land(given.limit(5), layout)
        runs.run()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert all(len(q.recentProgress) <= 2 for q in queries)
    kept = runs.batches().read()
    bronze = kept.where("name = 'long_bronze'").orderBy("batch").collect()
    assert [r["batch"] for r in bronze] == list(range(len(bronze))) and len(bronze) >= 9
    assert sum(r["rows"] for r in bronze) == given.count() + 5
    assert all(r["duration_ms"] >= 0 and r["started_at"] for r in bronze)
    assert kept.select("name").distinct().count() == len(queries)


def test_a_batch_between_two_looks_leaves_a_gap(spark, layout):
    class Progress:
        def __init__(self, batch, rows):
            self.batchId, self.numInputRows, self.batchDuration, self.timestamp = batch, rows, 1, "t"
            self.durationMs = {"addBatch": 1}

    class Query:
        name, id = "q", "id"

    history = BatchHistory(spark, layout.history)
    assert history.read().count() == 0 and history.flush() == 0
    for seen in ([Progress(3, 5), Progress(4, 6)], [Progress(4, 6), Progress(5, 1)], [Progress(8, 2)], []):
        Query.recentProgress = seen
        history.look(Query)
    assert history.flush() == 6
    assert rows(history.read(), "batch", "rows") == [(3, 5), (4, 6), (5, 1), (6, None), (7, None), (8, 2)]


def test_landed_files_go_to_the_archive(spark, given, layout):
    runs = job(spark, layout, archive=True, name="archived")
    for half in (0, 1):
        land(given.where(F.col(KEY) % 2 == half), layout, files=2)
        assert len(landed_files(spark, layout.source)) == 2
        runs.run()
        assert landed_files(spark, layout.source) == []
    runs.run()
    archived = spark.read.option("recursiveFileLookup", True).schema("data STRING").text(layout.archive)
    assert archived.count() == given.count() == read_table(spark, layout.bronze).count()
    assert landed_files(spark, layout.source + "/nowhere") == []
    land(given.limit(1), layout)
    (file,) = landed_files(spark, layout.source)
    assert archive_files(spark, [file, file], layout.archive) == 1  # the second time it is gone


def test_views_over_a_stream(spark, given, members, model, layout):
    land(given, layout)
    names = register_views(
        spark, stream_text(spark, layout.source), members, model, prefix="live_"
    )
    assert all(spark.table(name).isStreaming == (name != "live_members") for name in names)
    query = spark.sql("""
        SELECT nameOrig, hour, prediction,
               live_notify_status(prediction, userid, webhook_url) AS status
        FROM live_transactions_scored""")
    assert query.isStreaming
    run_hop(query, layout.enriched, layout.checkpoint("sql"))
    got = read_table(spark, layout.enriched)
    want = refine(parse_records(to_bronze(given.select(F.to_json(F.struct("*")).alias("data")))))
    assert rows(got, "nameOrig", "hour") == rows(want, "nameOrig", "hour")
    assert rows(got.select("prediction", "status").distinct()) == [
        (0.0, "Valid transaction"), (1.0, "Notification sent"),
    ]


def test_freshness(spark, given, layout):
    export_json_lines(given, layout.source)
    before = freshness(spark, layout.source).first()
    assert before["files"] >= 1 and before["bytes"] > 0
    time.sleep(1.1)
    land(given, layout)
    after = freshness(spark, layout.source).first()
    assert after["files"] > before["files"] and after["newest"] > before["newest"]


def test_freshness_of_an_empty_folder(spark, tmp_path):
    assert tuple(freshness(spark, str(tmp_path)).first()) == (0, 0, None)
