import tempfile

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", False)
        .config("spark.ui.showConsoleProgress", False)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def layout(spark):
    from paywarden.layout import new_layout

    return new_layout(spark)


def rows(df, *order):
    """Rows as tuples in a comparable order."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().toString()
