"""Train, tune and judge the fraud model. All of it runs as Spark ML jobs."""

from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, RFormula, RFormulaModel, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from paywarden.operators.prepare import LABEL, columns_by_kind
from paywarden.operators.profile import is_missing
from paywarden.operators.sizing import kept, measured_bytes, pass_partitions

# Class fractions of the training and of the export sample, seeds,
# split weights, and the parameter grid.
TRAIN_FRACTIONS = {1: 1.0, 0: 0.004}
TRAIN_SAMPLE_SEED = 0
EXPORT_FRACTIONS = {1: 0.4, 0: 0.001}
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
REG_PARAMS = (0.1, 0.2, 1.0)
ELASTIC_NET_PARAMS = (0.0, 0.5, 1.0)

@dataclass(frozen=True)
class Tuning:
    """Parameter grid and cross-validation."""

    reg_params: Sequence[float] = REG_PARAMS
    elastic_net_params: Sequence[float] = ELASTIC_NET_PARAMS
    folds: int = 3
    parallelism: int = 4
    seed: int = 42
    metric: str = "accuracy"


@dataclass(frozen=True)
class Trained:
    """The fitted pipeline, the categories it knows, and the tuning result as
    (regParam, elasticNetParam, mean metric)."""

    model: PipelineModel
    categories: dict[str, list[str]]
    tuning: list[tuple[float, float, float]] = field(default_factory=list)


def known_categories(model: PipelineModel | RFormulaModel) -> dict[str, list[str]] | None:
    """The categories a fitted (or loaded) model knows, per column; None if it has no
    formula featuriser."""
    if isinstance(model, PipelineModel):
        found = [known_categories(s) for s in model.stages if isinstance(s, RFormulaModel)]
        return found[0] if found else None
    indexers = [s for s in model._java_obj.pipelineModel().stages() if "StringIndexerModel" in s.getClass().getName()]
    return {s.getInputCol(): sorted(s.labelsArray()[0]) for s in indexers}


def check_categories(df: DataFrame, columns: Sequence[str], most: int) -> None:
    """Refuse columns with more than `most` different values. An indexer keeps all
    of them on the driver and makes each a model input. The count is exact, and
    stops at the first value too many."""
    for c in columns:
        if df.select(c).distinct().limit(most + 1).count() > most:
            raise ValueError(f"more than {most} values for a categorical feature: {c}")


def formula_featuriser(label: str = LABEL) -> RFormula:
    """All columns but the label: strings one-hot, numbers as they are.

    Rows with a missing input or an unknown category are skipped, in training
    and in scoring; `unscorable` tells which.
    """
    return RFormula(
        formula=f"{label} ~ .", featuresCol="features", labelCol=label, handleInvalid="skip"
    )


def stage_featuriser(df: DataFrame, label: str = LABEL, max_categories: int | None = None) -> Pipeline:
    """The same features from separate stages: one-hot categories first, then numbers."""
    strings, numbers = columns_by_kind(df, (label,))
    if max_categories is not None:
        check_categories(df, strings, max_categories)
    indexed, hot = [f"{c}_index" for c in strings], [f"{c}_hot" for c in strings]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=strings, outputCols=indexed, handleInvalid="skip"),
            OneHotEncoder(inputCols=indexed, outputCols=hot),
            VectorAssembler(inputCols=hot + numbers, outputCol="features", handleInvalid="skip"),
        ]
    )


def fit(
    train: DataFrame,
    tuning: Tuning | None = Tuning(),
    seen: DataFrame | None = None,
    max_categories: int | None = None,
) -> Trained:
    """Learn the features, then fit the model, or the whole grid.

    `seen` are the rows that the categories are learned from, by default the
    training rows: with a sample to train on, give all rows, so that no rare
    category is unknown. `max_categories` refuses a column that turns out to be an id.

    The training rows are read several times: for the features, and by each fold.
    First they, then their features are therefore kept, in memory as far as it goes
    and else on disk. A sample comes in as many partitions as its source, and each of
    many iterations starts a task, and sends the driver a result, for each of them: the
    features are made in partitions by the measured size of the rows. A rebalance hint
    does not do that, as what is persisted is planned without adaptive execution, in
    the whole shuffle width.
    Without tuning the plain, unpenalised regression is fitted.
    """
    if max_categories is not None:
        check_categories(train if seen is None else seen, columns_by_kind(train)[0], max_categories)
    with ExitStack() as meanwhile:
        with kept(train):
            featuriser = formula_featuriser().fit(train if seen is None else seen.select(*train.columns))
            cores = train.sparkSession.sparkContext.defaultParallelism
            spread = train.repartition(pass_partitions(measured_bytes(train), cores))
            features = featuriser.transform(spread).select(LABEL, "features")
            meanwhile.enter_context(kept(features))
            features.count()  # once the features are there, the rows are let go
        if tuning is None:
            model, results = _regression().fit(features), []
        else:
            model, results = _tuned(features, tuning)
    return Trained(PipelineModel([featuriser, model]), known_categories(featuriser), results)


def _regression() -> LogisticRegression:
    return LogisticRegression(labelCol=LABEL, featuresCol="features")


def _tuned(
    features: DataFrame, tuning: Tuning
) -> tuple[CrossValidatorModel, list[tuple[float, float, float]]]:
    """Cross-validate the grid; the best point is fitted again on all rows."""
    lr = _regression()
    grid = (
        ParamGridBuilder()
        .addGrid(lr.regParam, list(tuning.reg_params))
        .addGrid(lr.elasticNetParam, list(tuning.elastic_net_params))
        .build()
    )
    validator = CrossValidator(
        estimator=lr,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=LABEL, metricName=tuning.metric),
        numFolds=tuning.folds,
        parallelism=tuning.parallelism,
        seed=tuning.seed,
    )
    model = validator.fit(features)
    return model, [
        (point[lr.regParam], point[lr.elasticNetParam], float(mean))
        for point, mean in zip(grid, model.avgMetrics)
    ]


def unscorable(df: DataFrame, known: dict[str, list[str]], features: Sequence[str]) -> Column:
    """Condition for the rows a model skips: a missing input or an unknown category."""
    missing = [is_missing(df, c) for c in features]
    unknown = [~F.col(c).isin(values) for c, values in known.items()]
    return F.coalesce(reduce(or_, missing + unknown), F.lit(True))


def metrics(scored: DataFrame) -> dict[str, float]:
    """Accuracy, area under ROC and area under precision-recall of scored rows."""
    needed = scored.select(LABEL, "rawPrediction", "prediction")
    accuracy = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy")
    # Without bins the curve has a point for each score and the areas are exact;
    # the points are computed by a sort over all tasks, not on the driver.
    area = BinaryClassificationEvaluator(labelCol=LABEL, numBins=0)
    with kept(needed):
        return {
            "accuracy": accuracy.evaluate(needed),
            "areaUnderROC": area.setMetricName("areaUnderROC").evaluate(needed),
            "areaUnderPR": area.setMetricName("areaUnderPR").evaluate(needed),
        }
