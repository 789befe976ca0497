import pytest
from pyspark.sql import functions as F

from paywarden import inputs
from paywarden.functions.records import (
    content_key, decode_record, encode_record, hash_bound, hash_prefix,
)
from paywarden.operators.hops import parse_records, to_bronze, unparsed
from paywarden.schemas import RAW, RECORD
from tests.conftest import rows

N = len(RECORD.fields)


@pytest.mark.parametrize(
    "text, step, kind",
    [
        ('{"step":5,"type":"A"}', 5, "A"),
        ("not json", None, None),
        ("", None, None),
        (None, None, None),
        ('{"step":"x","type":"A"}', None, "A"),
        ('{"step":1.0,"type":"A"}', None, "A"),
        ('{"STEP":2}', None, None),
        ('[{"step":9}]', None, None),
    ],
)
def test_json_edge_cases(spark, text, step, kind):
    bronze = to_bronze(spark.createDataFrame([(text,)], RAW))
    got = parse_records(bronze).collect()
    assert len(got) == 1  # no line is lost
    assert (got[0]["step"], got[0]["type"]) == (step, kind)
    assert unparsed(parse_records(bronze)).count() == (step is None and kind is None)


def test_encode_then_decode_is_the_identity(spark, sf):
    given = inputs.transactions(spark, sf)
    text = given.select(encode_record().alias("data"))
    back = text.select(decode_record("data", inputs.KEYED_RECORD).alias("r")).select("r.*")
    assert rows(back) == rows(given)


def test_nulls_are_written_out(spark):
    text = spark.sql("SELECT CAST(NULL AS INT) AS a, 'x' AS b").select(encode_record()).first()[0]
    assert text == '{"a":null,"b":"x"}'


def test_other_datasets_stay_out(spark):
    raw = spark.createDataFrame([('{"step":1}',)], RAW)
    both = to_bronze(raw).union(to_bronze(raw, "invoices"))
    assert parse_records(both).count() == 1


def test_content_key_tells_rows_apart(spark, sf):
    given = inputs.transactions(spark, sf).withColumn("id", content_key())
    assert given.select("id").distinct().count() == given.count()
    assert given.filter(F.length("id") != 64).count() == 0


def test_hash_prefix_is_uniform_and_stable(spark):
    ids = spark.range(20000)
    quarter = ids.filter(hash_prefix("id") < hash_bound(0.25))
    assert abs(quarter.count() / 20000 - 0.25) < 0.02
    assert rows(quarter) == rows(ids.repartition(13).filter(hash_prefix("id") < hash_bound(0.25)))
    assert hash_bound(1.0) is None and hash_bound(0.0) == "00000000"
