"""Every operator as a query over the given tables, with the same result in SQL
wherever SQL can say it.

Queries that write (streams, exports, models) use a new folder below
`spark.checkpoint.dir` and return the table they read back.
"""

import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce, wraps

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paywarden import inputs
from paywarden.catalog import TUNED, prepare_home, settings_kept, tune_session, widen_shuffles
from paywarden.functions import notification as note
from paywarden.functions.features import party_pair
from paywarden.functions.records import decode_record
from paywarden.inputs import KEY, KEYED_RECORD, MEMBERS_SQL, TRANSACTIONS_SQL, table
from paywarden.layout import Layout, new_layout, shared_root
from paywarden.operators import categories, curves, evaluate, gold, profile, sample
from paywarden.operators.enrich import join_members
from paywarden.operators.hops import multiplex, parse_records, refine, to_bronze
from paywarden.operators.impute import impute
from paywarden.operators.partials import Partials
from paywarden.operators.prepare import LABEL, label_frame, training_frame
from paywarden.plans import training
from paywarden.plans.pipeline import ROW_KEY, Pipeline, notify, outbox
from paywarden.plans.views import register_views
from paywarden.schemas import BRONZE, TRANSACTIONS
from paywarden.sources.readers import (
    Admission, count_rows, freshness, read_members_csv, read_table, read_transactions_csv,
    stream_table, stream_text, table_exists,
)
from paywarden.sources.writers import export_csv, export_json_lines, load_model, materialise, save_model, staged
from paywarden.streaming.daily import late_events, run_daily_active
from paywarden.streaming.lifecycle import await_table, hop_counts, stop_queries, stop_when_idle
from paywarden.streaming.runner import CONTINUAL, preview, run_hop, start_hop

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; `sql` may use the tables
    `transactions` and `members` besides the given ones."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
            given = str(sf_dir).rstrip("/")
            widen_shuffles(spark, given_bytes(spark, given))
            return fn(spark, given)

        QUERIES[fn.__name__] = sized
        if sql is not None:
            head = "WITH " + ",\n".join([TRANSACTIONS_SQL, MEMBERS_SQL])
            body = sql.strip()
            ORACLE[fn.__name__] = (
                f"{head},\n{body[len('WITH '):]}" if body.startswith("WITH ") else f"{head}\n{body}"
            )
        return fn

    return register


_GIVEN_BYTES: dict[tuple[str, str], int] = {}


def given_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the given tables, from file status, looked up once per application."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _GIVEN_BYTES:
        _GIVEN_BYTES[place] = freshness(spark, sf_dir).first()["bytes"]
    return _GIVEN_BYTES[place]


# --- SQL fragments shared by several checks ---------------------------------

REFINED = """step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest,
       concat(substr(nameOrig, 1, 1), substr(nameDest, 1, 1)) AS transaction, step % 24 AS hour"""
LABELLED = """CASE WHEN isFraud = 1 THEN 1 ELSE 0 END AS label, event_id, step, type, amount,
       oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest,
       concat(substr(nameOrig, 1, 1), substr(nameDest, 1, 1)) AS transaction"""
ENRICHED = f"""SELECT nameOrig, event_id, t.* EXCLUDE (event_id, nameOrig), userid, webhook_url
FROM (SELECT event_id, {REFINED} FROM transactions) t LEFT JOIN members USING (nameOrig)"""
# Rank of each category: by falling frequency, then by name.
CATEGORY_RANKS = f"""WITH labelled AS (SELECT {LABELLED}, step % 24 AS hour FROM transactions),
types AS (SELECT type, row_number() OVER (ORDER BY count(*) DESC, type) - 1 AS type_rank
          FROM labelled GROUP BY type),
pairs AS (SELECT transaction, row_number() OVER (ORDER BY count(*) DESC, transaction) - 1 AS pair_rank
          FROM labelled GROUP BY transaction)"""
# Scores by a fixed rule, for operators that only need some prediction.
RULED = "SELECT *, CASE WHEN amount > 100 THEN 1 ELSE 0 END AS prediction FROM transactions"


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.transactions(spark, sf_dir).withColumn(
        "prediction", F.when(F.col("amount") > 100, 1.0).otherwise(0.0)
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training frame with the row key."""
    return training_frame(inputs.transactions(spark, sf_dir))


# Labels are taken away by a fixed rule, as the given tables have no null.
UNLABELLED = "event_id % 37 = 5"


def in_band(kept: Column, all_rows: Column, share: float) -> Column:
    """Whether a random share of some rows is within five standard deviations of its size."""
    return F.abs(kept - all_rows * share) <= 5 * F.sqrt(all_rows * (share * (1 - share))) + 1


# --- profiling and preparation ----------------------------------------------


@query("SELECT isFraud, count(*) AS count FROM transactions GROUP BY isFraud")
def class_balance(spark, sf_dir):
    return profile.class_balance(inputs.transactions(spark, sf_dir))


@query(f"SELECT {LABELLED} FROM transactions WHERE NOT ({UNLABELLED})")
def label_frame_rows(spark, sf_dir):
    """Rows without a label are left out, and not taken for class 0."""
    rows = inputs.transactions(spark, sf_dir)
    return label_frame(rows.withColumn("isFraud", F.when(~F.expr(UNLABELLED), F.col("isFraud"))))


@query(f"SELECT {LABELLED}, step % 24 AS hour FROM transactions WHERE isFraud IS NOT NULL")
def training_frame_rows(spark, sf_dir):
    return labelled(spark, sf_dir)


# Missing values are put in by a fixed rule, as the given tables have none.
HOLED = """SELECT label, event_id,
       CASE WHEN event_id % 60 = 11 THEN NULL ELSE step END AS step,
       CASE WHEN event_id % 40 = 3 THEN NULL ELSE type END AS type,
       CASE WHEN event_id % 50 = 7 THEN NULL WHEN event_id % 50 = 8 THEN CAST('NaN' AS DOUBLE)
            ELSE amount END AS amount,
       CASE WHEN event_id % 30 = 2 THEN NULL ELSE transaction END AS transaction"""


def holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return label_frame(inputs.transactions(spark, sf_dir)).select(
        "label",
        "event_id",
        F.when(event % 60 != 11, F.col("step")).alias("step"),
        F.when(event % 40 != 3, F.col("type")).alias("type"),
        F.when(event % 50 == 8, float("nan"))
        .when(event % 50 != 7, F.col("amount"))
        .alias("amount"),
        F.when(event % 30 != 2, F.col("transaction")).alias("transaction"),
    )


@query(f"""WITH holed AS ({HOLED} FROM (SELECT {LABELLED} FROM transactions))
SELECT count(*) FILTER (label IS NULL) AS label, count(*) FILTER (event_id IS NULL) AS event_id,
       count(*) FILTER (step IS NULL) AS step, count(*) FILTER (type IS NULL) AS type,
       count(*) FILTER (amount IS NULL OR isnan(amount)) AS amount,
       count(*) FILTER (transaction IS NULL) AS transaction
FROM holed""")
def missing_profile(spark, sf_dir):
    return profile.missing_profile(holed(spark, sf_dir))


@query(f"""WITH holed AS ({HOLED} FROM (SELECT {LABELLED} FROM transactions)),
means AS (SELECT avg(step) AS mean_step, avg(amount) FILTER (NOT isnan(amount)) AS mean_amount FROM holed),
type_mode AS (SELECT type AS mode_type FROM holed WHERE type IS NOT NULL
              GROUP BY type ORDER BY count(*) DESC, type LIMIT 1),
pair_mode AS (SELECT transaction AS mode_pair FROM holed WHERE transaction IS NOT NULL
              GROUP BY transaction ORDER BY count(*) DESC, transaction LIMIT 1)
SELECT label, event_id, round(coalesce(CAST(step AS DOUBLE), mean_step), 6) AS step,
       coalesce(type, mode_type) AS type,
       round(CASE WHEN amount IS NULL OR isnan(amount) THEN mean_amount ELSE amount END, 6) AS amount,
       coalesce(transaction, mode_pair) AS transaction
FROM holed, means, type_mode, pair_mode""")
def impute_mean_mode(spark, sf_dir):
    filled = impute(holed(spark, sf_dir), exclude=(LABEL, KEY))
    return filled.withColumns({c: F.round(c, 6) for c in ("step", "amount")})


@query(f"SELECT event_id, {REFINED} FROM transactions")
def silver_refine(spark, sf_dir):
    return refine(inputs.transactions(spark, sf_dir), [KEY])


@query("""SELECT concat(substr(nameOrig, 1, 1), substr(nameDest, 1, 1)) AS transaction, count(*) AS count
FROM transactions GROUP BY 1""")
def party_pair_counts(spark, sf_dir):
    rows = inputs.transactions(spark, sf_dir).select(party_pair().alias("transaction"))
    return profile.class_balance(rows, "transaction")


@query("""SELECT step % 24 AS hour, count(*) AS count, CAST(sum(isFraud) AS BIGINT) AS frauds,
       sum(isFraud) / count(*) AS fraud_rate
FROM transactions GROUP BY 1""")
def hour_profile(spark, sf_dir):
    return profile.hour_profile(labelled(spark, sf_dir))


@query(f"SELECT * FROM (SELECT {LABELLED}, step % 24 AS hour FROM transactions) WHERE hour = 0")
def midnight_hour(spark, sf_dir):
    return labelled(spark, sf_dir).filter(F.col("hour") == 0)


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_parse(spark, sf_dir):
    parsed = decode_record("props", "k INT").getField("k")
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("k"))


# --- scans and sinks ----------------------------------------------------------


@query("SELECT * FROM transactions")
def json_roundtrip(spark, sf_dir):
    layout = inputs.land_transactions(spark, sf_dir)
    lines = spark.read.schema("data STRING").text(layout.source)
    return lines.select(decode_record("data", KEYED_RECORD).alias("r")).select("r.*")


@query("SELECT * EXCLUDE (event_id) FROM transactions")
def csv_scan(spark, sf_dir):
    path = new_layout(spark).source
    export_csv(inputs.transactions(spark, sf_dir).drop(KEY), path)
    return read_transactions_csv(spark, path)


@query("SELECT * FROM transactions")
def csv_scan_inferred(spark, sf_dir):
    path = new_layout(spark).source
    export_csv(inputs.transactions(spark, sf_dir), path)
    inferred = read_transactions_csv(spark, path, schema=None)
    return inferred.withColumn(KEY, F.col(KEY).cast("bigint"))


@query("SELECT * FROM members")
def members_csv(spark, sf_dir):
    path = new_layout(spark).source
    export_csv(inputs.members(spark, sf_dir), path)
    return read_members_csv(spark, path)


@query("SELECT * FROM members ORDER BY nameOrig LIMIT 5")
def member_preview(spark, sf_dir):
    return inputs.members(spark, sf_dir).orderBy("nameOrig").limit(5)


@query("SELECT count(*) AS rows FROM transactions")
def cached_count(spark, sf_dir):
    kept, rows = materialise(labelled(spark, sf_dir))
    try:
        return spark.createDataFrame([(rows,)], "rows BIGINT")
    finally:
        kept.unpersist()


@query("SELECT true AS files_agree, true AS bytes_agree, count(*) AS lines FROM transactions")
def source_files(spark, sf_dir):
    """File status against what a read of the folder sees: files with lines, bytes, and lines."""
    source = inputs.land_transactions(spark, sf_dir).source
    status = freshness(spark, f"{source}/part-*").first()
    lines = spark.read.schema("data STRING").text(source)
    seen = lines.agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("seen"),
        F.sum(F.octet_length("data") + 1).alias("length"),
        F.count("*").alias("lines"),
    )
    return seen.select(
        (F.col("seen") == status["files"]).alias("files_agree"),
        (F.col("length") == status["bytes"]).alias("bytes_agree"),
        "lines",
    )


@query("""SELECT *, true AS own_database, true AS legal_name, true AS of_the_user, true AS settings_back FROM transactions""")
def home_table(spark, sf_dir):
    """A table in a database of the user's own, made anew, tuned for, written, found again by a later
    set-up, and cleaned up; the session is afterwards as it was."""
    before = spark.catalog.currentDatabase()
    tuned = {name: spark.conf.get(name, None) for name in TUNED}
    root = shared_root(spark)
    project = f"my-app {uuid.uuid4().hex}"  # of this run alone, as a reset drops the database of the name
    try:
        with settings_kept(spark, *TUNED):
            home = prepare_home(spark, root, project, "reset")
            tune_session(spark)
            path = f"{home.layout.root}/transactions"
            inputs.transactions(spark, sf_dir).write.option("path", path).saveAsTable("transactions")
        again = prepare_home(spark, root, project, "setup")
        same = again == home and spark.catalog.tableExists(f"`{home.database}`.transactions")
        legal = re.fullmatch(r"my_app_[0-9a-f]{32}_[a-zA-Z0-9_]+_db", home.database) is not None
        user = spark.sparkContext.sparkUser()
        owned = home.user == user and home.layout.root.startswith(f"{root}/{user}/{project}/")
        prepare_home(spark, root, project, "cleanup")
        back = tuned == {name: spark.conf.get(name, None) for name in TUNED}
        found = {"own_database": same, "legal_name": legal, "of_the_user": owned, "settings_back": back}
        return read_table(spark, path).withColumns({name: F.lit(value) for name, value in found.items()})
    finally:
        spark.sql(f"USE `{before}`")


# --- member enrichment --------------------------------------------------------


@query(ENRICHED)
def member_enrich(spark, sf_dir):
    refined = refine(inputs.transactions(spark, sf_dir), [KEY])
    return join_members(refined, inputs.members(spark, sf_dir))


@query(ENRICHED)
def member_enrich_shuffled(spark, sf_dir):
    """The join for a member list that is too large to broadcast."""
    refined = refine(inputs.transactions(spark, sf_dir), [KEY])
    return join_members(refined, inputs.members(spark, sf_dir), broadcast_bytes=0)


# --- sampling and splitting -----------------------------------------------------


def sample_checks(rows: DataFrame, drawn: DataFrame, shares: dict[int, float]) -> DataFrame:
    """Per class: rows, whether the sample holds nothing else and nothing twice, and about its share of them."""
    ids = drawn.select(KEY, F.lit(1).alias("drawn"))
    found = rows.join(ids, KEY, "left").groupBy("isFraud").agg(
        F.count_distinct(KEY).alias("rows"), F.count("drawn").alias("kept"),
        F.count_distinct(F.when(F.col("drawn") == 1, F.col(KEY))).alias("once"),
    )
    within = F.when(F.lit(False), F.lit(False))
    for label, part in shares.items():
        within = within.when(F.col("isFraud") == label, in_band(F.col("kept"), F.col("rows"), part))
    return found.select(
        "isFraud", "rows", (F.col("once") == F.col("kept")).alias("once"), within.alias("about_its_share")
    )


BY_CLASS = "SELECT isFraud, count(*) AS rows, true AS once, true AS about_its_share FROM transactions GROUP BY isFraud"


def drawn_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.transactions(spark, sf_dir)
    return sample.stratified_sample(
        rows, "isFraud", training.TRAIN_FRACTIONS, seed=training.TRAIN_SAMPLE_SEED
    )


@query(BY_CLASS)
def stratified_sample(spark, sf_dir):
    """The balanced training sample, checked against the rows it is drawn from."""
    rows = inputs.transactions(spark, sf_dir)
    return sample_checks(rows, drawn_sample(spark, sf_dir), training.TRAIN_FRACTIONS)


@query("SELECT event_id FROM transactions WHERE isFraud = 1")
def stratified_sample_fraud(spark, sf_dir):
    """The class with fraction 1 comes through whole."""
    return drawn_sample(spark, sf_dir).filter(F.col("isFraud") == 1).select(KEY)


@query(BY_CLASS)
def export_sample(spark, sf_dir):
    """The sample for export, as it comes back from its JSON lines."""
    rows = inputs.transactions(spark, sf_dir)
    drawn = sample.stratified_sample(rows, "isFraud", training.EXPORT_FRACTIONS, seed=0)
    layout = new_layout(spark)
    export_json_lines(drawn, layout.source)
    lines = spark.read.schema("data STRING").text(layout.source)
    return sample_checks(rows, lines.select(decode_record("data", KEYED_RECORD).alias("r")).select("r.*"), training.EXPORT_FRACTIONS)


@query(f"""SELECT * FROM transactions
WHERE isFraud = 1 OR (isFraud = 0 AND substr(md5(concat('0:', CAST(event_id AS VARCHAR))), 1, 8)
                                      < '{round(0.004 * 2**32):08x}')""")
def stratified_sample_hash(spark, sf_dir):
    rows = inputs.transactions(spark, sf_dir)
    return sample.stratified_sample_by_key(rows, "isFraud", training.TRAIN_FRACTIONS, KEY)


@query("SELECT 2 AS parts, count(*) AS rows, true AS about_their_shares FROM transactions")
def split_sizes(spark, sf_dir):
    """The parts of the random split: how many, their rows together, and whether the first has its share."""
    train, test = sample.random_split(
        labelled(spark, sf_dir), training.SPLIT_WEIGHTS, training.SPLIT_SEED
    )
    parts = train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
    sizes = parts.groupBy("part").agg(F.count("*").alias("rows"))
    first = F.sum(F.when(F.col("part") == "train", F.col("rows")))
    share = training.SPLIT_WEIGHTS[0] / sum(training.SPLIT_WEIGHTS)
    return sizes.agg(
        F.count("*").cast("int").alias("parts"), F.sum("rows").alias("rows"),
        in_band(first, F.sum("rows"), share).alias("about_their_shares"),
    )


@query("SELECT event_id FROM transactions")
def split_complete(spark, sf_dir):
    """The parts of the random split together: each row exactly once."""
    train, test = sample.random_split(
        labelled(spark, sf_dir), training.SPLIT_WEIGHTS, training.SPLIT_SEED
    )
    return train.select(KEY).union(test.select(KEY))


@query(f"""SELECT event_id,
       CASE WHEN substr(md5(concat('42:', CAST(event_id AS VARCHAR))), 1, 8)
                 < '{round(0.8 * 2**32):08x}' THEN 'train' ELSE 'test' END AS part
FROM transactions""")
def split_hash(spark, sf_dir):
    train, test = sample.split_by_key(
        inputs.transactions(spark, sf_dir).select(KEY), training.SPLIT_WEIGHTS, KEY, training.SPLIT_SEED
    )
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


# --- features -------------------------------------------------------------------


def stages_fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    """The separate feature stages fitted on, and applied to, the training frame."""
    rows = labelled(spark, sf_dir)
    model = training.stage_featuriser(rows.drop(KEY)).fit(rows.drop(KEY))
    return model.transform(rows), model.stages


@query(f"""{CATEGORY_RANKS}
SELECT event_id, type, transaction, CAST(type_rank AS DOUBLE) AS type_index,
       CAST(pair_rank AS DOUBLE) AS transaction_index
FROM labelled JOIN types USING (type) JOIN pairs USING (transaction)""")
def string_index(spark, sf_dir):
    rows, _ = stages_fitted(spark, sf_dir)
    return rows.select(KEY, "type", "transaction", "type_index", "transaction_index")


# The account is a category with very many values.
ACCOUNT_RANKS = """SELECT nameOrig AS value, count(*) AS count,
       row_number() OVER (ORDER BY count(*) DESC, nameOrig) - 1 AS rank FROM transactions GROUP BY 1"""


@query(ACCOUNT_RANKS)
def category_ranks(spark, sf_dir):
    """Ranks of all accounts by their frequency, found range by range."""
    return categories.category_ranks(inputs.transactions(spark, sf_dir), "nameOrig")


INDEXED = f"""WITH ranks AS ({ACCOUNT_RANKS})
SELECT event_id, nameOrig, CAST(rank AS DOUBLE) AS account_index
FROM transactions JOIN ranks ON nameOrig = value"""


@query(INDEXED)
def string_index_ranked(spark, sf_dir):
    """The exact index of a category, with no list of its values on the driver."""
    rows = inputs.transactions(spark, sf_dir).select(KEY, "nameOrig")
    return categories.with_ranks(rows, "nameOrig", categories.category_ranks(rows, "nameOrig"), "account_index")


@query(INDEXED)
def string_index_shuffled(spark, sf_dir):
    """The same index for ranks that are too large to broadcast."""
    rows = inputs.transactions(spark, sf_dir).select(KEY, "nameOrig")
    ranks = categories.category_ranks(rows, "nameOrig")
    return categories.with_ranks(rows, "nameOrig", ranks, "account_index", broadcast_bytes=0)


SLOTS = 64


def slot_sql(column: str) -> str:
    return f"CAST(CAST('0x' || substr(md5('{column}=' || {column}), 1, 12) AS BIGINT) % {SLOTS} AS BIGINT)"


HASHED = ("nameOrig", "type")


@query(f"SELECT event_id, {', '.join(f'{slot_sql(c)} AS slot_{c}' for c in HASHED)} FROM transactions")
def hashed_slots(spark, sf_dir):
    """Slots of an account and a type by hash."""
    rows = inputs.transactions(spark, sf_dir).select(KEY, *HASHED)
    return categories.hashed_counts(rows, HASHED, SLOTS).drop(*HASHED)


@query(f"""WITH counted AS ({" UNION ALL ".join(f"SELECT {slot_sql(c)} AS slot, count(*) AS rows FROM transactions GROUP BY 1, {c}" for c in HASHED)})
SELECT slot, count(*) AS values, CAST(sum(rows) AS BIGINT) AS rows, max(rows) AS most_frequent
FROM counted GROUP BY slot HAVING count(*) > 1""")
def hashed_collisions(spark, sf_dir):
    """Which slots several values share, and how many rows that concerns."""
    return categories.collisions(inputs.transactions(spark, sf_dir), HASHED, SLOTS)


# One row per slot of a one-hot vector: all categories but the last, which is all zeros.
TYPE_SLOTS = "[CAST(type_rank = k AS DOUBLE) for k in range((SELECT count(*) - 1 FROM types))]"
PAIR_SLOTS = "[CAST(pair_rank = k AS DOUBLE) for k in range((SELECT count(*) - 1 FROM pairs))]"


def slots_sql(*columns: str) -> str:
    """Slots of some vectors, as rows (event_id, label, vector, slot, value)."""
    return "\nUNION ALL ".join(
        f"""SELECT event_id, label, '{name}' AS vector, CAST(unnest(range(len(v))) AS INTEGER) AS slot, unnest(v) AS value
FROM (SELECT event_id, label, {vector} AS v FROM labelled JOIN types USING (type) JOIN pairs USING (transaction))"""
        for name, vector in zip(columns[::2], columns[1::2])
    )


def slots(rows: DataFrame, **vectors: str) -> DataFrame:
    """The same rows from vector columns, whatever their length."""
    parts = [
        rows.select(KEY, LABEL, F.lit(name).alias("vector"), F.posexplode(vector_to_array(column)).alias("slot", "value"))
        for name, column in vectors.items()
    ]
    return reduce(DataFrame.unionAll, parts)


@query(f"{CATEGORY_RANKS}\n{slots_sql('type', TYPE_SLOTS, 'transaction', PAIR_SLOTS)}")
def one_hot(spark, sf_dir):
    rows, _ = stages_fitted(spark, sf_dir)
    return slots(rows, type="type_hot", transaction="transaction_hot")


BALANCES = "oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest"
STAGE_SLOTS = f"""list_concat(list_concat({TYPE_SLOTS}, {PAIR_SLOTS}),
    [CAST(step AS DOUBLE), amount, {BALANCES}, CAST(hour AS DOUBLE)])"""
FORMULA_SLOTS = f"""list_concat(list_concat(list_concat([CAST(step AS DOUBLE)], {TYPE_SLOTS}),
    list_concat([amount, {BALANCES}], {PAIR_SLOTS})), [CAST(hour AS DOUBLE)])"""


@query(f"{CATEGORY_RANKS}\n{slots_sql('features', STAGE_SLOTS)}")
def feature_vector(spark, sf_dir):
    """The whole assembled vector, slot by slot."""
    rows, _ = stages_fitted(spark, sf_dir)
    return slots(rows, features="features")


@query(f"{CATEGORY_RANKS}\n{slots_sql('features', FORMULA_SLOTS)}")
def formula_features(spark, sf_dir):
    """The whole vector of the formula, slot by slot."""
    rows = labelled(spark, sf_dir)
    return slots(training.formula_featuriser().fit(rows.drop(KEY)).transform(rows), features="features")


# --- model ------------------------------------------------------------------------


_FITTED: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, make: Callable[[SparkSession, str], object]) -> object:
    """What `make` gives, made once per application and folder: models, and paths of saved ones."""
    place = (spark.sparkContext.applicationId, sf_dir, make)
    if place not in _FITTED:
        _FITTED[place] = make(spark, sf_dir)
    return _FITTED[place]


def balanced(rows: DataFrame) -> DataFrame:
    """All frauds, and few of the many others: what a model is fitted on."""
    return sample.stratified_sample_by_key(rows, LABEL, training.TRAIN_FRACTIONS, KEY)


def _plain_model(spark: SparkSession, sf_dir: str) -> training.Trained:
    rows = labelled(spark, sf_dir)
    train, _ = sample.split_by_key(rows, training.SPLIT_WEIGHTS, KEY, training.SPLIT_SEED)
    return training.fit(balanced(train).drop(KEY), tuning=None, seen=rows)


def trained(spark: SparkSession, sf_dir: str) -> tuple[training.Trained, DataFrame]:
    """A model fitted on the balanced sample of 80 % of the rows, and the other 20 %."""
    _, test = sample.split_by_key(labelled(spark, sf_dir), training.SPLIT_WEIGHTS, KEY, training.SPLIT_SEED)
    return once(spark, sf_dir, _plain_model), test


def plain(scored: DataFrame, *columns: str) -> DataFrame:
    """Scores without vector columns."""
    fraud = vector_to_array("probability")[1].alias("fraud_probability")
    return scored.select(*columns, fraud, "prediction")


TEST_PART = f"substr(md5(concat('42:', CAST(event_id AS VARCHAR))), 1, 8) >= '{round(0.8 * 2**32):08x}'"
SAMPLE_PART = f"(isFraud = 1 OR substr(md5(concat('0:', CAST(event_id AS VARCHAR))), 1, 8) < '{round(0.004 * 2**32):08x}')"


def judged(scored: DataFrame) -> DataFrame:
    """Keys and labels of scored rows, and whether the prediction is what the probability says."""
    fraud = F.col("fraud_probability")
    agrees = fraud.between(0, 1) & (F.col("prediction") == F.when(fraud > 0.5, 1.0).otherwise(0.0))
    return plain(scored, KEY, LABEL).select(KEY, LABEL, agrees.alias("agrees"))


@query(f"SELECT event_id, isFraud AS label, true AS agrees FROM transactions WHERE {TEST_PART}")
def train_score(spark, sf_dir):
    """The rows that the model was not fitted on, scored."""
    fitted, test = trained(spark, sf_dir)
    return judged(fitted.model.transform(test))


def _tuned_model(spark: SparkSession, sf_dir: str) -> training.Trained:
    rows = labelled(spark, sf_dir)
    train, _ = sample.split_by_key(balanced(rows), training.SPLIT_WEIGHTS, KEY, training.SPLIT_SEED)
    return training.fit(train.drop(KEY), seen=rows)


@query(f"SELECT event_id, isFraud AS label, true AS agrees FROM transactions WHERE {TEST_PART} AND {SAMPLE_PART}")
def tuned_score(spark, sf_dir):
    """Balance, split, tune over grid and folds, and score the test part with the best model."""
    _, test = sample.split_by_key(balanced(labelled(spark, sf_dir)), training.SPLIT_WEIGHTS, KEY, training.SPLIT_SEED)
    return judged(once(spark, sf_dir, _tuned_model).model.transform(test))


@query(f"SELECT count(*) AS support, true AS consistent FROM transactions WHERE {TEST_PART} AND {SAMPLE_PART}")
def tuned_report(spark, sf_dir):
    """The report on that test part: its support, and whether its accuracy is that of the metrics."""
    _, test = sample.split_by_key(balanced(labelled(spark, sf_dir)), training.SPLIT_WEIGHTS, KEY, training.SPLIT_SEED)
    scored = once(spark, sf_dir, _tuned_model).model.transform(test)
    accuracy = training.metrics(scored)["accuracy"]
    report = evaluate.class_report(scored).filter("class = 'accuracy'")
    return report.select("support", (F.abs(F.col("f1") - accuracy) < 1e-9).alias("consistent"))


SKIPPED = "step IS NULL OR type IS NULL OR amount IS NULL OR isnan(amount) OR transaction IS NULL"


def _holed_model(spark: SparkSession, sf_dir: str) -> training.Trained:
    rows = holed(spark, sf_dir)
    return training.fit(balanced(rows).drop(KEY), tuning=None, seen=rows)


def model_on_holed(spark: SparkSession, sf_dir: str) -> tuple[training.Trained, DataFrame]:
    return once(spark, sf_dir, _holed_model), holed(spark, sf_dir)


@query(f"SELECT event_id FROM ({HOLED} FROM (SELECT {LABELLED} FROM transactions)) WHERE NOT ({SKIPPED})")
def scored_rows(spark, sf_dir):
    """What a model scores out of rows with missing values."""
    fitted, rows = model_on_holed(spark, sf_dir)
    return fitted.model.transform(rows).select(KEY)


@query(f"SELECT event_id FROM ({HOLED} FROM (SELECT {LABELLED} FROM transactions)) WHERE {SKIPPED}")
def skipped_rows(spark, sf_dir):
    """What it leaves out, found without it."""
    fitted, rows = model_on_holed(spark, sf_dir)
    features = [c for c in rows.columns if c not in (KEY, LABEL)]
    return rows.filter(training.unscorable(rows, fitted.categories, features)).select(KEY)


@query("""SELECT CAST(r AS DOUBLE) AS regParam, CAST(e AS DOUBLE) AS elasticNetParam, true AS in_range
FROM (SELECT unnest([0.1, 0.2, 1.0]) AS r), (SELECT unnest([0.0, 0.5, 1.0]) AS e)""")
def tuned_grid(spark, sf_dir):
    """Every grid point once, with a mean accuracy over the folds."""
    points = spark.createDataFrame(
        once(spark, sf_dir, _tuned_model).tuning, "regParam DOUBLE, elasticNetParam DOUBLE, accuracy DOUBLE"
    )
    return points.select("regParam", "elasticNetParam", F.col("accuracy").between(0, 1).alias("in_range"))


@query(f"""SELECT event_id, true AS same FROM transactions
WHERE substr(md5(concat('42:', CAST(event_id AS VARCHAR))), 1, 8) >= '{round(0.8 * 2**32):08x}'""")
def score_roundtrip(spark, sf_dir):
    """A model that was saved and loaded again scores every row as before."""
    fitted, test = trained(spark, sf_dir)
    path = new_layout(spark).model
    save_model(fitted.model, path)
    before = plain(fitted.model.transform(test), *test.columns)
    again = load_model(path).transform(before.withColumnRenamed("prediction", "first_prediction"))
    same = vector_to_array("probability")[1] == F.col("fraud_probability")
    return again.select(
        KEY, (same & (F.col("prediction") == F.col("first_prediction"))).alias("same")
    )


@query(f"""SELECT unnest(['accuracy', 'areaUnderROC', 'areaUnderPR']) AS metric, true AS agrees,
       (SELECT count(*) FROM transactions WHERE {TEST_PART}) AS rows""")
def model_metrics(spark, sf_dir):
    """The metrics of a model against the same figures from sums range by range."""
    fitted, test = trained(spark, sf_dir)
    scored = fitted.model.transform(test)
    values = training.metrics(scored)
    rows = scored.select(LABEL, "prediction", vector_to_array("rawPrediction")[1].alias("score"))
    found = curves.score_areas(curves.score_curve(rows)).first().asDict()
    found |= rows.agg(curves.accuracy(rows).alias("accuracy"), F.count("*").alias("rows")).first().asDict()
    agrees = [(name, abs(found[name] - value) < 1e-9, found["rows"]) for name, value in values.items()]
    return spark.createDataFrame(agrees, "metric STRING, agrees BOOLEAN, rows BIGINT")


CURVE = f"""WITH ruled AS ({RULED}),
cells AS (SELECT amount AS score, CAST(sum(isFraud) AS BIGINT) AS positives, CAST(sum(1 - isFraud) AS BIGINT) AS negatives FROM ruled GROUP BY 1)
SELECT score, positives, negatives,
       CAST(coalesce(sum(positives) OVER before, 0) AS BIGINT) AS above_positives,
       CAST(coalesce(sum(negatives) OVER before, 0) AS BIGINT) AS above_negatives
FROM cells WINDOW before AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query(CURVE)
def score_curve(spark, sf_dir):
    """Every point of the curves, by sums range by range."""
    return curves.score_curve(ruled(spark, sf_dir), label="isFraud", score="amount")


@query(f"""WITH ruled AS ({RULED}),
cells AS (SELECT amount AS score, sum(isFraud) AS pos, sum(1 - isFraud) AS neg FROM ruled GROUP BY 1),
totals AS (SELECT sum(pos) AS all_pos, sum(neg) AS all_neg FROM cells),
curve AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp
          FROM cells),
points AS (SELECT score, tp / all_pos AS recall, fp / all_neg AS fall_out, tp / (tp + fp) AS prec
           FROM curve, totals),
steps AS (SELECT recall, fall_out, prec, lag(recall, 1, 0) OVER w AS recall_0,
                 lag(fall_out, 1, 0) OVER w AS fall_out_0, lag(prec, 1, prec) OVER w AS prec_0
          FROM points WINDOW w AS (ORDER BY score DESC))
SELECT 'areaUnderROC' AS metric, round(sum((fall_out - fall_out_0) * (recall + recall_0) / 2), 9) AS value FROM steps
UNION ALL
SELECT 'areaUnderPR', round(sum((recall - recall_0) * (prec + prec_0) / 2), 9) FROM steps
UNION ALL
SELECT 'accuracy', round(avg(CAST(isFraud = prediction AS INTEGER)), 9) FROM ruled""")
def score_areas(spark, sf_dir):
    """The metrics on a prediction by rule and the amount as score: thousands of scores."""
    rows = ruled(spark, sf_dir).select(
        F.col("isFraud").alias(LABEL),
        "prediction",
        F.col("amount").alias("rawPrediction"),
    )
    scores = [(name, round(value, 9)) for name, value in training.metrics(rows).items()]
    return spark.createDataFrame(scores, "metric STRING, value DOUBLE")


@query(f"""WITH curve AS ({CURVE}),
ends AS (SELECT sum(positives) AS p, sum(negatives) AS n FROM curve),
points AS (SELECT *, (above_positives + positives) / (above_positives + positives + above_negatives + negatives) AS after,
                  above_positives / nullif(above_positives + above_negatives, 0) AS before FROM curve, ends)
SELECT round(sum(negatives / n * (2 * above_positives + positives) / 2 / p), 9) AS areaUnderROC,
       round(sum(positives / p * (after + coalesce(before, after)) / 2), 9) AS areaUnderPR
FROM points""")
def score_curve_areas(spark, sf_dir):
    """The areas below those curves."""
    curve = curves.score_curve(ruled(spark, sf_dir), label="isFraud", score="amount")
    return curves.score_areas(curve).select(*[F.round(c, 9).alias(c) for c in ("areaUnderROC", "areaUnderPR")])


@query(f"""WITH ruled AS ({RULED})
SELECT isFraud AS label, prediction, count(*) AS count FROM ruled GROUP BY 1, 2""")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(ruled(spark, sf_dir), label="isFraud")


@query(f"""WITH ruled AS ({RULED}),
classes AS (SELECT unnest([0, 1]) AS class),
counts AS (SELECT class, count(*) FILTER (isFraud = class) AS support,
                  count(*) FILTER (prediction = class) AS predicted,
                  count(*) FILTER (isFraud = class AND prediction = class) AS hits
           FROM ruled, classes GROUP BY class),
scores AS (SELECT class, support, hits,
                  CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS prec,
                  CASE WHEN support = 0 THEN 0 ELSE hits / support END AS rec,
                  CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f
           FROM counts)
SELECT CAST(class AS VARCHAR) AS class, round(prec, 9) AS precision, round(rec, 9) AS recall,
       round(f, 9) AS f1, support FROM scores
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL
SELECT 'macro avg', round(avg(prec), 9), round(avg(rec), 9), round(avg(f), 9), CAST(sum(support) AS BIGINT)
FROM scores
UNION ALL
SELECT 'weighted avg', round(sum(prec * support) / sum(support), 9), round(sum(rec * support) / sum(support), 9),
       round(sum(f * support) / sum(support), 9), CAST(sum(support) AS BIGINT)
FROM scores""")
def class_report(spark, sf_dir):
    report = evaluate.class_report(ruled(spark, sf_dir), label="isFraud")
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


UNJUDGED = f"""SELECT CASE WHEN event_id % 41 = 3 THEN NULL ELSE isFraud END AS isFraud,
       CASE WHEN event_id % 29 = 7 THEN NULL ELSE prediction END AS prediction FROM ({RULED})"""
CLASS_REPORT = ORACLE["class_report"]


@query(f"""WITH unjudged AS ({UNJUDGED}),
{CLASS_REPORT[CLASS_REPORT.index("classes AS"):].replace("FROM ruled, classes", "FROM unjudged, classes WHERE isFraud IS NOT NULL AND prediction IS NOT NULL")}
UNION ALL
SELECT CASE WHEN isFraud IS NULL THEN 'no label' ELSE 'no prediction' END, NULL, NULL, NULL, count(*)
FROM unjudged WHERE isFraud IS NULL OR prediction IS NULL GROUP BY 1""")
def class_report_unjudged(spark, sf_dir):
    """The report on rows of which some have no label and some no prediction."""
    event = F.col(KEY)
    rows = ruled(spark, sf_dir).withColumns({
        "isFraud": F.when(event % 41 != 3, F.col("isFraud")), "prediction": F.when(event % 29 != 7, F.col("prediction")),
    })
    report = evaluate.class_report(rows, label="isFraud")
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


# --- notification -----------------------------------------------------------------


@query(f"""WITH ruled AS ({RULED})
SELECT event_id, CASE WHEN prediction = 1 THEN 'Notification sent' ELSE 'Valid transaction' END AS notify_user
FROM ruled""")
def notify_status(spark, sf_dir):
    """The status through its SQL function."""
    note.register_status(spark)
    rows = ruled(spark, sf_dir)
    return rows.select(KEY, F.expr("notify_status(prediction, nameOrig, NULL)").alias("notify_user"))


@query(f"""WITH alerts AS (
  SELECT event_id, userid, webhook_url, webhook_url IS NOT NULL AS deliverable,
         concat(coalesce(userid, 'None'), ', a fraud transaction is posted in your account at ',
                strftime(TIMESTAMP '{inputs.EPOCH}' + step * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f')) AS message
  FROM ({RULED}) LEFT JOIN members USING (nameOrig) WHERE prediction = 1)
SELECT *, concat('{{"text":"', message, '"}}') AS payload FROM alerts""")
def alerts(spark, sf_dir):
    """The outbox for predictions by rule, stamped with the time of the step."""
    rows = notify(join_members(ruled(spark, sf_dir), inputs.members(spark, sf_dir)))
    at = F.timestamp_add("HOUR", F.col("step"), F.lit(inputs.EPOCH).cast("timestamp_ntz"))
    return outbox(rows, [KEY], at)


# --- summary tables -----------------------------------------------------------------


@query("""SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS active_users, count(*) AS events
FROM events GROUP BY 1""")
def gold_daily_active(spark, sf_dir):
    return gold.daily_active(table(spark, sf_dir, "events"))


@query("""SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, l_suppkey AS store,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sales, count(*) AS lines
FROM lineitem GROUP BY 1, 2""")
def gold_weekly_sales(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return gold.weekly_sales(lines, "l_shipdate", "l_suppkey", "l_extendedprice")


PARTS = 3
# Sums after each part, the parts dealt by a number modulo 3 in the order 0, 1, 2.
AFTER_PART = "(SELECT unnest(range(1, 4)) AS parts) JOIN {rows} ON {number} % 3 < parts"


@query(f"""SELECT CAST(parts AS INTEGER) AS parts, CAST(date_trunc('week', l_shipdate) AS DATE) AS week, l_suppkey AS store,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sales, count(*) AS lines
FROM {AFTER_PART.format(rows="lineitem", number="l_orderkey")} GROUP BY 1, 2, 3""")
def gold_weekly_sales_parts(spark, sf_dir):
    """Weekly sales after each of three parts, compacted in between, one part given twice."""
    lines = table(spark, sf_dir, "lineitem")
    sales = gold.weekly_sales_parts(spark, f"{new_layout(spark).root}/sales", "l_shipdate", "l_suppkey", "l_extendedprice")
    return after_parts(sales, lines, "l_orderkey")


def after_parts(partials: Partials, rows: DataFrame, number: str) -> DataFrame:
    """The aggregate after each of the parts."""
    states = []
    for k in range(PARTS):
        part = rows.where(F.col(number) % PARTS == k)
        partials.add(f"part-{k}", part)
        partials.add(f"part-{k}", part)
        states.append(staged(partials.read()).select(F.lit(k + 1).alias("parts"), "*"))
        if k == 1:
            partials.compact()
    return reduce(DataFrame.unionAll, states)


REVENUE = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       c_mktsegment AS department,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3"""


REVENUE_COLUMNS = {
    "at": "o_orderdate",
    "amount": "o_totalprice",
    "order_customer": "o_custkey",
    "customer": "c_custkey",
    "department": "c_mktsegment",
}


def revenue(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return gold.quarter_revenue(orders, customers, **REVENUE_COLUMNS, **options)


@query(REVENUE)
def gold_quarter_revenue(spark, sf_dir):
    return revenue(spark, sf_dir)


@query(REVENUE)
def gold_quarter_revenue_shuffled(spark, sf_dir):
    """The report for customers that are too large to broadcast."""
    return revenue(spark, sf_dir, broadcast_bytes=0)


@query(REVENUE.replace("SELECT", "SELECT CAST(parts AS INTEGER) AS parts,", 1)
       .replace("FROM orders JOIN", f"FROM {AFTER_PART.format(rows='orders', number='o_orderkey')} JOIN").replace("GROUP BY 1, 2, 3", "GROUP BY 1, 2, 3, 4"))
def gold_quarter_revenue_parts(spark, sf_dir):
    """The revenue after each of three parts of the orders."""
    path = f"{new_layout(spark).root}/revenue"
    kept = gold.quarter_revenue_parts(spark, path, table(spark, sf_dir, "customer"), **REVENUE_COLUMNS)
    return after_parts(kept, table(spark, sf_dir, "orders"), "o_orderkey")


# Days of the events that are cut in three, and some that come a day after their third.
DAY_OF = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"
CUTS = (10, 20)


def landed_events(spark: SparkSession, sf_dir: str, too_late: bool = False) -> Iterator[str]:
    """A folder of events, each time with a third more of the days; some events of a third's
    last day come with the next third, on demand some of its first days with the last.

    At last an event much later than all, without a user, which closes the days."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    day = F.datediff(F.to_date("ts"), F.lit(inputs.EPOCH).cast("date"))
    third = sum((day >= F.when(F.col("event_id") % 50 == 0, c + 1).otherwise(c)).cast("int") for c in CUTS)
    if too_late:
        third = F.when((day < 5) & (F.col("event_id") % 7 == 0), 2).otherwise(third)
    path = f"{new_layout(spark).root}/events"
    for part in range(3):
        rows.where(third == part).write.mode("append").parquet(path)
        yield path
    end = rows.agg(F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("user_id"),
                   (F.max("ts") + F.expr("INTERVAL 1000 DAYS")).alias("ts"))
    end.write.mode("append").parquet(path)
    yield path


def daily_stream(spark: SparkSession, sf_dir: str, too_late: bool) -> tuple[str, str]:
    """Folder of the events and path of the daily table, which a run after each part has extended."""
    layout = new_layout(spark)
    daily = f"{layout.root}/daily"
    for path in landed_events(spark, sf_dir, too_late):
        events = stream_table(spark, path, "event_id BIGINT, user_id BIGINT, ts TIMESTAMP")
        run_daily_active(events, daily, layout.checkpoint("daily"))
    return path, daily


@query("""SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS active_users, count(*) AS events
FROM events GROUP BY 1""")
def gold_daily_active_stream(spark, sf_dir):
    """The daily table from a stream that is cut in three, with a restart after each part."""
    return read_table(spark, daily_stream(spark, sf_dir, too_late=False)[1])


@query(f"""SELECT CAST(ts AS DATE) AS day, count(*) AS landed,
       count(*) FILTER ({DAY_OF} >= 5 OR event_id % 7 <> 0) AS counted,
       count(*) FILTER ({DAY_OF} < 5 AND event_id % 7 = 0) AS late
FROM events GROUP BY 1 HAVING counted > 0""")
def gold_daily_late(spark, sf_dir):
    """Events that come for days that are closed, by day."""
    path, daily = daily_stream(spark, sf_dir, too_late=True)
    return late_events(read_table(spark, path).where(F.col("event_id").isNotNull()), read_table(spark, daily))


# --- streams ----------------------------------------------------------------------


def bronze_table(spark: SparkSession, sf_dir: str, admission: Admission | None = None) -> Layout:
    """Transactions landed as JSON lines and ingested by one streaming query."""
    layout = inputs.land_transactions(spark, sf_dir)
    raw = stream_text(spark, layout.source, admission or Admission.cluster_sized(spark))
    run_hop(
        to_bronze(raw), layout.bronze, layout.checkpoint("bronze"), partition_by=["dataset"]
    )
    return layout


def pipeline(spark: SparkSession, sf_dir: str, **options) -> Pipeline:
    return Pipeline(
        spark,
        inputs.land_transactions(spark, sf_dir),
        record=KEYED_RECORD,
        key=[KEY],
        members=inputs.members(spark, sf_dir),
        admission=Admission.cluster_sized(spark),
        **options,
    )


@query("SELECT 'transactions' AS dataset, true AS stamped, * FROM transactions")
def bronze_ingest(spark, sf_dir):
    """The raw lines of the multiplex table, all fields picked out of the text, and whether the
    stamp is there and lies between the start of the run and now."""
    began = spark.sql("SELECT current_timestamp() AS now").first()["now"]
    lines = read_table(spark, bronze_table(spark, sf_dir).bronze)
    pick = {f.name: f.dataType.simpleString() for f in KEYED_RECORD.fields}
    stamped = F.coalesce(F.col("receipt_time").between(F.lit(began), F.current_timestamp()), F.lit(False))
    return lines.select(
        "dataset",
        stamped.alias("stamped"),
        *[F.get_json_object("data", f"$.{c}").cast(t).alias(c) for c, t in pick.items()],
    )


@query("SELECT true AS batch_per_file, true AS stamp_per_batch, count(*) AS rows FROM transactions")
def file_limit(spark, sf_dir):
    """One file per batch: as many batches as files with lines, and one stamp in each."""
    layout = inputs.land_transactions(spark, sf_dir)
    raw = stream_text(spark, layout.source, Admission(max_files=1))
    run_hop(to_bronze(raw), layout.bronze, layout.checkpoint("bronze"), partition_by=["dataset"])
    files = freshness(spark, f"{layout.source}/part-*").first()["files"]
    rows = read_table(spark, layout.bronze).select("receipt_time", F.col("_metadata.file_path").alias("file"))
    rows = rows.agg(
        F.count_distinct("receipt_time").alias("stamps"), F.count_distinct("file").alias("written"),
        F.count_distinct("file", "receipt_time").alias("pairs"), F.count("*").alias("rows"),
    )
    return rows.select(
        (F.col("stamps") == files).alias("batch_per_file"),
        (F.col("pairs") == F.col("written")).alias("stamp_per_batch"),
        "rows",
    )


@query("SELECT * FROM transactions")
def late_files(spark, sf_dir):
    """A second half in files that look 30 days older than those of the first."""
    layout = new_layout(spark)
    for half, days in ((0, 0), (1, 30)):
        inputs.land_half(spark, sf_dir, layout, half, days)
        raw = stream_text(spark, layout.source, Admission.cluster_sized(spark))
        run_hop(to_bronze(raw), layout.bronze, layout.checkpoint("bronze"), partition_by=["dataset"])
    return parse_records(read_table(spark, layout.bronze), KEYED_RECORD)


@query("SELECT count(*) AS n FROM transactions")
def bronze_count(spark, sf_dir):
    return count_rows(spark, bronze_table(spark, sf_dir).bronze)


@query("SELECT * FROM transactions")
def silver_parse(spark, sf_dir):
    """The records of one of two datasets that share the raw table."""
    layout = inputs.land_transactions(spark, sf_dir)
    raw = stream_text(spark, layout.source, Admission.cluster_sized(spark))
    both = multiplex({TRANSACTIONS: raw, "refunds": raw})
    run_hop(both, layout.bronze, layout.checkpoint("bronze"), partition_by=["dataset"])
    bronze = stream_table(
        spark, layout.bronze, BRONZE, admission=Admission.cluster_sized(spark)
    )
    run_hop(
        parse_records(bronze, KEYED_RECORD), layout.parsed, layout.checkpoint("transactions_parsed")
    )
    return read_table(spark, layout.parsed)


@query(ENRICHED)
def member_enrich_stream(spark, sf_dir):
    """Stream-static join, from the landed lines to the enriched table in one hop."""
    layout = new_layout(spark)
    source = inputs.land_transactions(spark, sf_dir).source
    raw = stream_text(spark, source, Admission.cluster_sized(spark))
    refined = refine(parse_records(to_bronze(raw), KEYED_RECORD), [KEY])
    landed = parse_records(to_bronze(spark.read.schema("data STRING").text(source)), KEYED_RECORD)
    enriched = join_members(refined, inputs.members(spark, sf_dir), history=landed)
    run_hop(enriched, layout.enriched, layout.checkpoint("transactions_enriched"))
    return read_table(spark, layout.enriched)


@query(ENRICHED)
def multi_hop(spark, sf_dir):
    job = pipeline(spark, sf_dir)
    job.run()
    return read_table(spark, job.layout.enriched)


@query(ENRICHED)
def multi_hop_shuffled(spark, sf_dir):
    """The hops with a member list that is too large to broadcast."""
    job = pipeline(spark, sf_dir, broadcast_bytes=0)
    job.run()
    return read_table(spark, job.layout.enriched)


# From the second half on, two thirds of the rows are of one account, a third of all.
TURNED = """CASE WHEN event_id % 2 = 1 AND event_id % 3 < 2 THEN 'C1' ELSE nameOrig END"""


@query(f"""WITH turned AS (SELECT * REPLACE ({TURNED} AS nameOrig) FROM transactions)
SELECT nameOrig, event_id, t.* EXCLUDE (event_id, nameOrig), userid, webhook_url,
       true AS known_from_restart, true AS counted_right
FROM (SELECT event_id, {REFINED} FROM turned) t LEFT JOIN members USING (nameOrig)""")
def member_enrich_hot(spark, sf_dir):
    """An account that turns hot while the job is down, with members that are too large to broadcast:
    it is spread from the next run on, which counts the new rows only."""
    layout = new_layout(spark)
    rows = inputs.transactions(spark, sf_dir).withColumn("nameOrig", F.expr(TURNED))
    shares = []
    for half in (0, 1):
        export_json_lines(rows.where(F.pmod(KEY, F.lit(2)) == half), layout.source, mode="append")
        job = Pipeline(
            spark, layout, record=KEYED_RECORD, key=[KEY], members=inputs.members(spark, sf_dir), name="hot", broadcast_bytes=0
        )
        job.run()
        shares.append(job.frequent_accounts())
    before, after = (s.shares(0.3).get("C1") for s in shares)
    known = before is None and after is not None and abs(shares[1].rows - 2 * shares[0].rows) <= 1
    enriched = read_table(spark, layout.enriched)
    true, low = enriched.where(F.col("nameOrig") == "C1").count(), shares[1].counts.get("C1", 0)
    right = low <= true <= low + shares[1].error
    return enriched.withColumns({"known_from_restart": F.lit(known), "counted_right": F.lit(right)})


@query("""SELECT hop, CAST((SELECT count(*) FROM transactions) AS BIGINT) AS rows
FROM (VALUES ('bronze'), ('transactions_parsed'), ('transactions_enriched')) AS hops(hop)""")
def stream_progress(spark, sf_dir):
    """Rows that each hop has written."""
    job = pipeline(spark, sf_dir, name="progress")
    job.run()
    layout = job.layout
    return hop_counts(
        spark,
        {"bronze": layout.bronze, "transactions_parsed": layout.parsed, "transactions_enriched": layout.enriched},
    )


@query("SELECT event_id, 1::BIGINT AS ingested, 1::BIGINT AS archived, 0::BIGINT AS landed FROM transactions")
def landing_archived(spark, sf_dir):
    """Where each record is after two runs: once in the raw table, once in the archive, and not in the landing folder."""
    layout = new_layout(spark)
    for half in (0, 1):
        inputs.land_half(spark, sf_dir, layout, half)
        Pipeline(spark, layout, record=KEYED_RECORD, key=[KEY], name="archiving", archive=True).run()
    lines = spark.read.schema("data STRING").option("recursiveFileLookup", True)
    places = {"ingested": read_table(spark, layout.bronze), "archived": lines.text(layout.archive), "landed": lines.text(layout.source)}
    ids = [
        rows.select(decode_record("data", KEYED_RECORD).getField(KEY).alias(KEY), F.lit(name).alias("place")) for name, rows in places.items()
    ]
    counts = [F.count_if(F.col("place") == name).alias(name) for name in places]
    return reduce(DataFrame.unionAll, ids).groupBy(KEY).agg(*counts)


@query("SELECT name, (SELECT count(*) FROM transactions) AS rows, true AS every_batch FROM (VALUES ('bronze'), ('transactions_parsed')) AS hops(name)")
def batch_history(spark, sf_dir):
    """Rows of all batches of two hops, file by file, where Spark itself remembers two batches."""
    layout = inputs.land_transactions(spark, sf_dir)
    inner = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(inner)
    spark.conf.set(inner, "2")
    try:
        job = Pipeline(spark, layout, record=KEYED_RECORD, key=[KEY], admission=Admission(max_files=1), name="kept", history=True)
        job.run()
    finally:
        spark.conf.set(inner, before)
    kept = job.batches().read().where(F.col("name").isin("kept_bronze", "kept_transactions_parsed"))
    every = (F.count("rows") == F.max("batch") + 1) & (F.count_distinct("batch") == F.max("batch") + 1)
    return kept.groupBy(F.substring_index("name", "kept_", -1).alias("name")).agg(F.sum("rows").alias("rows"), every.alias("every_batch"))


PREVIEWED = 100


@query(f"SELECT least(count(*), {PREVIEWED}) AS rows, true AS distinct_rows, true AS of_the_stream FROM transactions")
def stream_preview(spark, sf_dir):
    """The first rows of a stream through the in-memory table, bounded, and each of them one of its rows."""
    source = inputs.land_transactions(spark, sf_dir).source
    stream = parse_records(to_bronze(stream_text(spark, source)), KEYED_RECORD)
    seen = staged(preview(stream, f"preview_{uuid.uuid4().hex}", PREVIEWED))
    there = seen.join(inputs.transactions(spark, sf_dir).select(KEY, F.lit(True).alias("there")), KEY, "left")
    return there.agg(
        F.count("*").alias("rows"), (F.count_distinct(KEY) == F.count("*")).alias("distinct_rows"),
        (F.count("there") == F.count("*")).alias("of_the_stream"),
    )


@query("""SELECT name, stopped, (SELECT count(*) FROM transactions) AS rows
FROM (VALUES ('mine_a', 1), ('mine_b', 1), ('other', 2)) AS t(name, stopped)""")
def stopped_streams(spark, sf_dir):
    """Queries stopped by the prefix of their name (1), and then all others of the run (2), and what each had written."""
    layout = inputs.land_transactions(spark, sf_dir)
    run = f"run{uuid.uuid4().hex[:8]}"
    names = {f"{run}_{name}": name for name in ("mine_a", "mine_b", "other")}
    started = [
        start_hop(to_bronze(stream_text(spark, layout.source)), f"{layout.root}/{short}", layout.checkpoint(short), name=name, trigger=CONTINUAL)
        for name, short in names.items()
    ]
    for query in started:
        await_table(query, lambda at=names[query.name]: table_exists(spark, f"{layout.root}/{at}", BRONZE, filled=True))
    order = {name: 1 for name in stop_queries(spark, f"{run}_mine_")}
    still = [q.name for q in started if q.isActive]
    order |= {name: 2 for name in stop_queries(spark, run) if name in still}
    rows = spark.createDataFrame([(names[n], k) for n, k in order.items()], "name STRING, stopped INT")
    counts = hop_counts(spark, {short: f"{layout.root}/{short}" for short in names.values()})
    return rows.join(counts, rows["name"] == counts["hop"]).select("name", "stopped", "rows")


@query(ENRICHED)
def restart_once(spark, sf_dir):
    """Half lands, a run, the rest lands, a run, and one without new input: each row once."""
    layout = new_layout(spark)
    for half in (0, 1, None):
        if half is not None:
            inputs.land_half(spark, sf_dir, layout, half)
        job = Pipeline(spark, layout, record=KEYED_RECORD, key=[KEY], members=inputs.members(spark, sf_dir), name="restart")
        job.run()
    return read_table(spark, layout.enriched)


@query(ENRICHED)
def continual_run(spark, sf_dir):
    """The hops side by side, stopped when idle, started again, and stopped again."""
    job = pipeline(spark, sf_dir, name="continual")
    for _ in range(2):
        stop_when_idle(job.start(CONTINUAL), idle_seconds=2, check_seconds=0.5)
    return read_table(spark, job.layout.enriched)


@query(f"""WITH ruled AS ({RULED}), frauds AS (SELECT * EXCLUDE (event_id) FROM ruled LEFT JOIN members USING (nameOrig) WHERE prediction = 1)
SELECT count(*) AS alerts, (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (prediction, userid, webhook_url) FROM frauds)) AS keys
FROM frauds""")
def alerts_without_id(spark, sf_dir):
    """Records that come without an id: alerts, and different keys among them."""
    job = Pipeline(
        spark, inputs.land_transactions(spark, sf_dir), members=inputs.members(spark, sf_dir),
        model=rule_model(), admission=Admission.cluster_sized(spark),
    )
    job.run()
    return read_table(spark, job.layout.outbox).agg(F.count("*").alias("alerts"), F.count_distinct(ROW_KEY).alias("keys"))


@query(f"""SELECT event_id, type IS NULL AS no_type, amount IS NULL AS no_amount
FROM ({HOLED} FROM (SELECT {LABELLED} FROM transactions)) h
WHERE type IS NULL OR amount IS NULL OR step IS NULL""")
def stream_skipped(spark, sf_dir):
    """The side table of what a model, loaded from its folder, leaves out of a stream with missing values."""
    layout = new_layout(spark)
    gaps = holed(spark, sf_dir).select(KEY, *(F.when(~F.isnan(c), F.col(c)).alias(c) if c == "amount" else c for c in ("step", "type", "amount")))
    nan = holed(spark, sf_dir).where(F.isnan("amount")).select(KEY, F.lit(0.0).alias("filled"))
    rows = inputs.transactions(spark, sf_dir).drop("step", "type", "amount").join(gaps, KEY).join(nan, KEY, "left")
    rows = rows.withColumn("amount", F.coalesce("amount", "filled")).select(*KEYED_RECORD.names)
    export_json_lines(rows, layout.source)
    job = Pipeline(
        spark, layout, record=KEYED_RECORD, key=[KEY], members=inputs.members(spark, sf_dir),
        model=load_model(once(spark, sf_dir, _saved_model)), admission=Admission.cluster_sized(spark),
    )
    job.run()
    skipped, scored = read_table(spark, layout.skipped), read_table(spark, layout.notified)
    left = skipped.join(scored, KEY, "left_anti")  # a row that was scored as well would be missing
    return left.select(KEY, F.col("type").isNull().alias("no_type"), F.col("amount").isNull().alias("no_amount"))


@query(f"""WITH refined AS (SELECT {REFINED}, amount > 100 AS large FROM transactions)
SELECT nameOrig, hour, transaction, amount, userid,
       CASE WHEN large THEN 'Notification sent' ELSE 'Valid transaction' END AS notify_user
FROM refined LEFT JOIN members USING (nameOrig)""")
def sql_views(spark, sf_dir):
    """The hops as views, queried in SQL."""
    raw = spark.read.schema("data STRING").text(inputs.land_transactions(spark, sf_dir).source)
    register_views(spark, raw, inputs.members(spark, sf_dir), prefix="batch_")
    return spark.sql("""
        SELECT nameOrig, hour, transaction, amount, userid,
               batch_notify_status(IF(amount > 100, 1D, 0D), userid, webhook_url) AS notify_user
        FROM batch_transactions_enriched""")


def rule_model() -> PipelineModel:
    """A rule in place of a fitted model."""
    rule = "SELECT *, CASE WHEN amount > 100 THEN 1D ELSE 0D END AS prediction FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=rule)])


MODEL_OUTPUT = ("features", "rawPrediction", "probability", "prediction", "notify_user")


def _saved_model(spark: SparkSession, sf_dir: str) -> str:
    fitted, _ = trained(spark, sf_dir)
    path = new_layout(spark).model
    save_model(fitted.model, path)
    return path


def scored_pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    """All hops with a model that was trained once, saved, and is loaded."""
    job = pipeline(spark, sf_dir, model=load_model(once(spark, sf_dir, _saved_model)))
    job.run()
    return job


SCORED = (KEY, "nameOrig", "type", "amount", "transaction", "hour", "userid", "webhook_url")


def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hop down to scored rows with their notification status."""
    notified = read_table(spark, scored_pipeline(spark, sf_dir).layout.notified)
    return plain(notified, *SCORED, "notify_user")


@query(f"""WITH enriched AS ({ENRICHED})
SELECT {", ".join(SCORED)}, true AS scored FROM enriched""")
def stream_score(spark, sf_dir):
    """The scored rows, with a probability, and a status that follows from it."""
    fraud, sent = F.col("fraud_probability"), F.col("notify_user") == note.SENT
    scored = fraud.between(0, 1) & (sent == (fraud > 0.5))
    return scored_stream(spark, sf_dir).select(*SCORED, scored.alias("scored"))


@query(f"""WITH enriched AS ({ENRICHED})
SELECT *, true AS told_apart FROM enriched""")
def stream_score_rows(spark, sf_dir):
    """Scoring and notifying a stream loses no row, and the status follows the prediction."""
    notified = read_table(spark, scored_pipeline(spark, sf_dir).layout.notified)
    told_apart = (F.col("notify_user") == note.SENT) == (F.col("prediction") == 1)
    enriched = [c for c in notified.columns if c not in MODEL_OUTPUT]
    return notified.select(*enriched, told_apart.alias("told_apart"))


@query(f"SELECT count(*) AS scored, true AS all_alerted, true AS stamped FROM ({ENRICHED})")
def stream_alerts(spark, sf_dir):
    """The outbox at the end of the hops: an alert for each predicted fraud and no other, with its time."""
    layout = scored_pipeline(spark, sf_dir).layout
    scored, outbox_rows = read_table(spark, layout.notified), read_table(spark, layout.outbox)
    stamp = F.to_timestamp(F.substring_index("message", " at ", -1), note.TIME_FORMAT)
    alerts = outbox_rows.groupBy(KEY).agg(
        F.count("*").alias("alerts"), F.min(stamp.between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp())).alias("stamped")
    )
    found = scored.groupBy(KEY).agg(F.count("*").alias("rows"), F.sum("prediction").alias("frauds")).join(alerts, KEY, "full")
    return found.agg(
        F.sum("rows").alias("scored"),
        F.min(F.coalesce("frauds", F.lit(-1)) == F.coalesce("alerts", F.lit(0))).alias("all_alerted"),
        F.coalesce(F.min("stamped"), F.lit(True)).alias("stamped"),
    )


@query(f"""SELECT event_id, userid, webhook_url, webhook_url IS NOT NULL AS deliverable,
       concat(coalesce(userid, 'None'), ', a fraud transaction is posted in your account') AS message
FROM ({RULED}) LEFT JOIN members USING (nameOrig) WHERE prediction = 1""")
def stream_alerts_by_rule(spark, sf_dir):
    """The outbox at the end of the hops with a rule in place of the model; the
    message is shown up to its time."""
    job = pipeline(spark, sf_dir, model=rule_model())
    job.run()
    alerts = read_table(spark, job.layout.outbox)
    return alerts.select(
        KEY, "userid", "webhook_url", "deliverable",
        F.substring_index("message", " at ", 1).alias("message"),
    )
