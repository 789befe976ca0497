import pytest

from paywarden import inputs
from paywarden.schemas import MEMBERS, RECORD
from paywarden.sources.readers import (
    count_rows, path_relation, read_members_csv, read_table, read_transactions_csv, stream_table,
)
from paywarden.sources.writers import export_csv
from tests.conftest import plan, rows


def test_declared_and_inferred_csv_agree(spark, sf, layout):
    given = inputs.transactions(spark, sf).drop("event_id")
    export_csv(given, layout.source)
    declared = read_transactions_csv(spark, layout.source)
    inferred = read_transactions_csv(spark, layout.source, schema=None)
    assert declared.schema == RECORD
    assert [f.dataType for f in inferred.schema] == [f.dataType for f in RECORD]
    assert rows(declared) == rows(inferred) == rows(given)


def test_few_columns_of_a_csv(spark, sf, layout):
    given = inputs.transactions(spark, sf).drop("event_id")
    export_csv(given, layout.source)
    scan = read_transactions_csv(spark, layout.source)
    assert scan.count() == given.count()
    assert rows(scan, "amount", "type") == rows(given, "amount", "type")


def test_reordered_header_fails(spark, layout):
    members = spark.createDataFrame([("C1", "u", "w")], MEMBERS)
    export_csv(members.select("userid", "nameOrig", "webhook_url"), layout.source)
    with pytest.raises(Exception, match="header|schema"):
        read_members_csv(spark, layout.source).collect()


def test_members_csv(spark, layout):
    members = spark.createDataFrame([("C1", "u", "w"), ("C2", None, "x")], MEMBERS)
    export_csv(members, layout.source)
    got = read_members_csv(spark, layout.source)
    assert got.schema == MEMBERS and rows(got) == rows(members)


def test_count_by_path(spark, sf):
    path = f"{sf}/events.parquet"
    assert count_rows(spark, path).first()["n"] == read_table(spark, path).count()
    assert path_relation("/a/b", "delta") == "delta.`/a/b`"
    with pytest.raises(ValueError):
        path_relation("/a`; DROP")


def test_count_reads_no_column(spark, sf):
    assert "ReadSchema: struct<>" in plan(count_rows(spark, f"{sf}/events.parquet"))


def test_stream_table_needs_no_first_look(spark, layout):
    """The schema is given, so the table is not opened to find it."""
    spark.range(1).selectExpr("'x' AS data").write.parquet(layout.bronze)
    got = stream_table(spark, layout.bronze, inputs.KEYED_RECORD)
    assert got.isStreaming and got.columns[0] == "event_id"


def test_silver_scan_is_pruned(spark, sf, layout):
    from paywarden.operators.hops import refine

    inputs.transactions(spark, sf).write.parquet(layout.parsed)
    text = plan(refine(read_table(spark, layout.parsed)))
    schema = text.rsplit("ReadSchema: ", 1)[1].split("\n")[0]
    assert "isFraud" not in schema and "isFlaggedFraud" not in schema and "event_id" not in schema


def test_json_fields_not_asked_for_are_not_parsed(spark, sf, layout):
    from paywarden.operators.hops import parse_records
    from paywarden.schemas import BRONZE

    bronze = spark.sql("SELECT current_timestamp() AS receipt_time, d AS dataset, '{}' AS data "
                       "FROM VALUES ('transactions'), ('invoices') AS t(d)")
    bronze.write.partitionBy("dataset").parquet(layout.bronze)
    text = plan(parse_records(spark.read.schema(BRONZE).parquet(layout.bronze)).select("step"))
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "from_json(StructField(step,IntegerType,true)," in optimized
    assert "PartitionFilters: [isnotnull(dataset" in text
