import pytest

from paywarden import catalog
from paywarden.layout import Layout, new_layout, shared_root


def test_layout_paths():
    layout = Layout("s3://bucket/home/")
    assert layout.source == "s3://bucket/home/source"
    assert layout.bronze == "s3://bucket/home/bronze"
    assert layout.parsed == "s3://bucket/home/silver/transactions_parsed"
    assert layout.enriched == "s3://bucket/home/silver/transactions_enriched"
    assert layout.checkpoint("bronze") == "s3://bucket/home/checkpoints/bronze"


def test_runs_share_the_named_folder_but_no_path(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    a, b = new_layout(spark), new_layout(spark)
    assert a.root != b.root and a.root.startswith(root) and b.root.startswith(root)


@pytest.mark.parametrize(
    "user, name", [("a.b@c.org", "demo_a_b_c_org_db"), ("root", "demo_root_db"), ("Ünal 1", "demo__nal_1_db")]
)
def test_database_name(user, name):
    assert catalog.database_name("demo", user) == name


def test_project_names_are_cleaned(spark, tmp_path):
    home = catalog.prepare_home(spark, str(tmp_path), "my-app")
    try:
        assert home.database.startswith("my_app_") and spark.catalog.currentDatabase() == home.database
    finally:
        spark.sql("USE default")
        catalog.prepare_home(spark, str(tmp_path), "my-app", "cleanup")


def test_home_modes(spark, tmp_path):
    names = lambda: {d.name for d in spark.catalog.listDatabases()}
    home = catalog.prepare_home(spark, str(tmp_path), "demo")
    try:
        assert home.user == catalog.current_user(spark)
        assert spark.catalog.currentDatabase() == home.database
        spark.range(3).write.saveAsTable("kept")
        again = catalog.prepare_home(spark, str(tmp_path), "demo", "setup")
        assert again == home and spark.table("kept").count() == 3
        fresh = catalog.prepare_home(spark, str(tmp_path), "demo", "reset")
        assert fresh.database == home.database and fresh.layout != home.layout
        assert not spark.catalog.tableExists("kept")
        assert catalog.prepare_home(spark, str(tmp_path), "demo") == fresh  # a reset lasts
    finally:
        spark.sql("USE default")
        catalog.prepare_home(spark, str(tmp_path), "demo", "cleanup")
    assert home.database not in names()
    with pytest.raises(ValueError):
        catalog.prepare_home(spark, str(tmp_path), "demo", "erase")


def test_tuning_follows_cores_and_input(spark):
    width = lambda: int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = width()
    try:
        cores = spark.sparkContext.defaultParallelism
        assert catalog.tune_session(spark) == width() == cores
        assert catalog.tune_session(spark, input_bytes=1 << 40) == width() == 1024
        assert catalog.tune_session(spark, input_bytes=100 << 40) == 20_000
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
        spark.conf.set("spark.sql.shuffle.partitions", 500)
        assert catalog.widen_shuffles(spark, 1 << 30) == width() == 500  # never narrower
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
