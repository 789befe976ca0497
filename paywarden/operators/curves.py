"""Curves of a score against a label, exact, and the areas below them."""

from pyspark.sql import Column, DataFrame, functions as F

from paywarden.operators.ranges import running_sums


def score_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, positives, negatives, above_positives, above_negatives) for each score.

    The first two count the rows with the score, the others those with a higher one.
    Rows are counted per score first, so equal scores are one row and are never split.
    A row without label or score takes no part; NaN is the highest score, as Spark sorts it.
    """
    known = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    counted = known.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    )
    return running_sums(counted, [F.desc("score")], {"above_positives": "positives", "above_negatives": "negatives"})


def score_areas(curve: DataFrame) -> DataFrame:
    """One row, (areaUnderROC, areaUnderPR), of a `score_curve`; null if there is only one class.

    A point of a curve is drawn for each score, and neighbours are joined by lines. The
    curve of precision starts at recall 0 with the precision of the highest score.
    """
    positives, negatives = curve.agg(F.sum("positives"), F.sum("negatives")).first()
    if not positives or not negatives:
        return curve.sparkSession.createDataFrame([(None, None)], "areaUnderROC DOUBLE, areaUnderPR DOUBLE")
    hits, hits_0 = F.col("above_positives") + F.col("positives"), F.col("above_positives")
    falls, falls_0 = F.col("above_negatives") + F.col("negatives"), F.col("above_negatives")
    precision, any_above = hits / (hits + falls), hits_0 + falls_0 > 0
    precision_0 = F.when(any_above, hits_0 / F.when(any_above, hits_0 + falls_0)).otherwise(precision)
    half = lambda a, b: (a + b) / 2
    return curve.agg(
        F.sum(F.col("negatives") / negatives * half(hits, hits_0) / positives).alias("areaUnderROC"),
        F.sum(F.col("positives") / positives * half(precision, precision_0)).alias("areaUnderPR"),
    )


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> Column:
    """Aggregate: the share of rows whose prediction is their label."""
    return F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0))
