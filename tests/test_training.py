import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from paywarden import inputs
from paywarden.operators.prepare import training_frame
from paywarden.operators.sample import split_by_key
from paywarden.operators.sizing import pass_partitions
from paywarden.plans import training
from paywarden.schemas import FEATURES
from paywarden.sources.writers import load_model, materialise, save_model
from tests.conftest import rows


@pytest.fixture(scope="module")
def parts(spark, sf):
    keyed = training_frame(inputs.transactions(spark, sf))
    return split_by_key(keyed, (0.8, 0.2), "event_id", 42)


@pytest.fixture(scope="module")
def fitted(parts):
    return training.fit(parts[0].drop("event_id"), tuning=None)


def scores(model, df):
    plain = model.transform(df).select(
        "event_id", vector_to_array("probability")[1].alias("p"), "prediction"
    )
    return rows(plain)


def vectors(df):
    return np.array([r["v"] for r in df.select(vector_to_array("features").alias("v")).collect()])


def test_both_featurisers_agree_up_to_column_order(parts):
    train = parts[0].drop("event_id").orderBy("step", "amount").cache()
    by_formula = vectors(training.formula_featuriser().fit(train).transform(train))
    by_stages = vectors(training.stage_featuriser(train).fit(train).transform(train))
    train.unpersist()
    assert by_formula.shape == by_stages.shape == (by_formula.shape[0], 12)
    columns = lambda m: sorted(map(tuple, m.T))
    assert columns(by_formula) == columns(by_stages)


def test_logistic_regression_against_numpy(parts):
    """The fitted weights are where the penalised loss has no slope."""
    one = training.Tuning(reg_params=(0.1,), elastic_net_params=(0.0,), folds=2)
    featuriser, tuned = training.fit(parts[0].drop("event_id"), one).model.stages
    lr = tuned.bestModel
    data = featuriser.transform(parts[0].drop("event_id"))
    x = vectors(data)
    y = np.array([r["label"] for r in data.select("label").collect()], dtype=float)
    scale = x.std(axis=0, ddof=1)
    keep = scale > 0
    z = x[:, keep] / scale[keep]
    w = np.zeros(z.shape[1] + 1)
    design = np.hstack([z, np.ones((len(z), 1))])
    penalty = np.append(np.full(z.shape[1], 0.1), 0.0)
    for _ in range(50):  # Newton's method on mean log loss + 0.1/2 |w|^2, features scaled
        p = 1 / (1 + np.exp(-design @ w))
        slope = design.T @ (p - y) / len(y) + penalty * w
        curve = (design * (p * (1 - p))[:, None]).T @ design / len(y) + np.diag(penalty)
        w -= np.linalg.solve(curve, slope)
    assert np.allclose(lr.coefficients.toArray()[keep], w[:-1] / scale[keep], atol=1e-4)
    assert math.isclose(lr.intercept, w[-1], abs_tol=1e-2)


def test_prediction_follows_the_probability(parts, fitted):
    got = scores(fitted.model, parts[1])
    assert len(got) == parts[1].count()
    assert all(prediction == (p > 0.5) for _, p, prediction in got)


def test_saved_model_gives_the_same_scores(spark, parts, fitted, layout):
    save_model(fitted.model, layout.model)
    save_model(fitted.model, layout.model)  # over an older one
    assert scores(load_model(layout.model), parts[1]) == scores(fitted.model, parts[1])


def test_extra_columns_pass_and_the_label_may_be_missing(parts, fitted):
    extra = parts[1].drop("label").withColumn("note", F.lit("x"))
    got = fitted.model.transform(extra)
    assert got.count() == parts[1].count()
    assert {"note", "event_id", "features", "rawPrediction", "probability", "prediction"} <= set(
        got.columns
    )


def test_skipped_rows_are_explained(parts, fitted):
    """What the model leaves out is exactly what `unscorable` finds."""
    base = parts[1].limit(1)
    broken = [
        base.withColumn("amount", F.lit(None).cast("double")),
        base.withColumn("amount", F.lit(float("nan"))),
        base.withColumn("type", F.lit("UNHEARD OF")),
        base.withColumn("type", F.lit(None).cast("string")),
        base.withColumn("hour", F.lit(None).cast("int")),
    ]
    mixed = base
    for i, row in enumerate(broken, 1):
        mixed = mixed.union(row.withColumn("event_id", F.lit(-i).cast("bigint")))
    scored = fitted.model.transform(mixed)
    skipped = training.unscorable(mixed, fitted.categories, FEATURES)
    assert scored.count() == 1
    assert rows(mixed.filter(~skipped), "event_id") == rows(scored, "event_id")
    assert mixed.filter(skipped).count() == len(broken)


def test_an_id_is_refused_as_category_on_demand(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("name"), (F.col("id") % 2).alias("label"))
    with pytest.raises(ValueError, match="name"):
        training.fit(df, tuning=None, max_categories=49)
    with pytest.raises(ValueError, match="name"):
        training.stage_featuriser(df, max_categories=49)
    assert len(training.fit(df, tuning=None, max_categories=50).categories["name"]) == 50


def test_categories_come_from_all_rows_and_from_a_saved_model(spark, layout):
    rows_seen = spark.range(60).select(
        F.concat(F.lit("k"), (F.col("id") % 6).cast("string")).alias("name"), F.col("id").alias("size"),
        (F.col("id") % 2).cast("int").alias("label"),
    )
    few = rows_seen.filter("name IN ('k0', 'k1')")
    fitted = training.fit(few, tuning=None, seen=rows_seen)
    assert fitted.categories == {"name": [f"k{i}" for i in range(6)]}
    assert fitted.model.transform(rows_seen).count() == 60
    save_model(fitted.model, layout.model)
    assert training.known_categories(load_model(layout.model)) == fitted.categories


def labelled_sizes(spark, n=400):
    return spark.range(n).select(
        F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("name"), (F.col("id") % 41).cast("double").alias("size"),
        (F.col("id") * 7 % 60 < F.col("id") % 41).cast("int").alias("label"),
    )


def tasks_of_passes(spark, rows, tuning):
    """How many tasks the passes of a fit start, in a shuffle width of 30."""
    width, group = spark.conf.get("spark.sql.shuffle.partitions"), f"passes of {tuning}"
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.sparkContext.setJobGroup(group, group)
    try:
        training.fit(rows, tuning)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    return [s.numTasks for s in stages if s and ("treeAggregate" in s.name or "MulticlassMetrics" in s.name)]


def test_passes_over_a_small_sample_start_few_tasks(spark):
    """Neither the shuffle width nor the partitions of the source decide what each iteration starts."""
    assert set(tasks_of_passes(spark, labelled_sizes(spark).repartition(20), None)) == {1}


def test_folds_of_a_small_sample_start_few_tasks(spark):
    """Nor what each fit and each judgement of the folds starts."""
    tuning = training.Tuning(reg_params=(0.1, 1.0), elastic_net_params=(0.0,), folds=2)
    found = tasks_of_passes(spark, labelled_sizes(spark).repartition(20), tuning)
    assert set(found) == {1} and len(found) > 2 * 2 * 3


def test_partitions_of_many_passes_follow_the_size():
    mb = 1 << 20
    found = [pass_partitions(s * mb, 12) for s in (0, 1, 8, 9, 90, 500, 768, 769, 7680)]
    assert found == [1, 1, 1, 2, 12, 12, 12, 13, 120]
    assert pass_partitions(30 * mb, 2) == 2


def test_the_fit_is_the_same_in_any_number_of_partitions(spark, monkeypatch):
    models = []
    for n in (1, 5):
        monkeypatch.setattr(training, "pass_partitions", lambda size, cores: n)
        models.append(training.fit(labelled_sizes(spark), tuning=None).model.stages[1])
    one, more = models
    assert np.allclose(one.coefficients.toArray(), more.coefficients.toArray(), atol=1e-6)
    assert math.isclose(one.intercept, more.intercept, abs_tol=1e-6)


def test_tuning_picks_the_best_of_the_whole_grid(spark, parts):
    small = training.Tuning(reg_params=(0.01, 1.0), elastic_net_params=(0.0, 1.0), folds=2)
    result = training.fit(parts[0].drop("event_id"), small)
    grid = [(r, e) for r, e, _ in result.tuning]
    assert sorted(grid) == [(0.01, 0.0), (0.01, 1.0), (1.0, 0.0), (1.0, 1.0)]
    assert all(0.5 < mean <= 1.0 for *_, mean in result.tuning)
    best = result.model.stages[1].bestModel
    chosen = (best.getRegParam(), best.getElasticNetParam())
    assert {(r, e): m for r, e, m in result.tuning}[chosen] == max(m for *_, m in result.tuning)


def test_default_grid_is_nine_points_in_three_folds():
    default = training.Tuning()
    assert len(default.reg_params) * len(default.elastic_net_params) == 9
    assert (default.folds, default.parallelism, default.seed, default.metric) == (3, 4, 42, "accuracy")


def test_metrics_are_in_range(parts, fitted):
    got = training.metrics(fitted.model.transform(parts[1]))
    assert set(got) == {"accuracy", "areaUnderROC", "areaUnderPR"}
    assert got["accuracy"] > 0.9 and got["areaUnderROC"] > 0.9


def test_materialise_counts_and_keeps(parts):
    kept, n = materialise(parts[1])
    assert kept.is_cached and n == kept.count()
    kept.unpersist()
    assert not kept.is_cached
