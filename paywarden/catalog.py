"""Database, home folder and session settings of a user."""

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from paywarden.layout import Layout

# The modes, the form of a database name, and what it may not hold.
MODES = ("setup", "reset", "cleanup")
DATABASE = "{project}_{user}_db"
ILLEGAL = "[^a-zA-Z0-9]"
# Property of a database that holds the root of its layout.
HOME = "paywarden.home"


@dataclass(frozen=True)
class Home:
    user: str
    database: str
    layout: Layout


def current_user(spark: SparkSession) -> str:
    return spark.sql("SELECT current_user() AS user").first()["user"]


def database_name(project: str, user: str) -> str:
    """Name made from project and user, with `_` for what it may not hold."""
    return DATABASE.format(project=re.sub(ILLEGAL, "_", project), user=re.sub(ILLEGAL, "_", user))


def prepare_home(spark: SparkSession, base: str, project: str, mode: str = "setup") -> Home:
    """Database and home folder of the session user.

    `setup`    creates and uses the database, and keeps what is in the home folder.
    `reset`    drops the database first, and starts in a new home folder.
    `cleanup`  drops the database and all its tables.

    No folder is deleted: a run that starts over gets a new one, so a wrong
    path can never remove data.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    user = current_user(spark)
    database = database_name(project, user)
    home = f"{base.rstrip('/')}/{user}/{project}"
    if mode == "reset":
        home = f"{home}/{uuid.uuid4().hex}"
    if mode != "setup":
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    if mode != "cleanup":
        # The database remembers its home, so that a later setup goes on in it.
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` WITH DBPROPERTIES ('{HOME}' = '{home}')")
        spark.sql(f"USE `{database}`")
        home = _property(spark, database, HOME) or home
    return Home(user, database, Layout(home))


def _property(spark: SparkSession, database: str, name: str) -> str | None:
    """A property of a database, from its description: ((name,value), (name,value))."""
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`").collect()
    text = next((r["info_value"] for r in rows if r["info_name"] == "Properties"), "")
    found = re.search(rf"\({re.escape(name)},([^()]*)\)", text)
    return found[1] if found else None


@contextmanager
def settings_kept(spark: SparkSession, *names: str) -> Iterator[None]:
    """Settings of the session are afterwards as they were before."""
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# The settings that `tune_session` sets.
TUNED = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.enabled",
    "spark.sql.execution.arrow.pyspark.enabled",
)


def tune_session(spark: SparkSession, input_bytes: int = 0) -> int:
    """Set the shuffle width to one partition per core, or wider for a large
    input. Adaptive execution stays on and merges partitions that turn out small."""
    spark.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.adaptive.enabled", True)
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", True)
    return widen_shuffles(spark, input_bytes)


def widen_shuffles(
    spark: SparkSession, input_bytes: int, partition_bytes: int = 1 << 30, most: int = 20_000
) -> int:
    """Raise the shuffle width, if it is lower, to one partition per
    `partition_bytes` of input; adaptive execution can merge partitions but not
    add any. The driver tracks map tasks times partitions, hence a limit: above
    it partitions grow, and sorts and aggregates spill.
    """
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(most, -(-input_bytes // partition_bytes))
    if wanted > width:
        spark.conf.set("spark.sql.shuffle.partitions", wanted)
        return wanted
    return width
