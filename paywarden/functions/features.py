"""Features computed in the same way for training and for serving."""

from pyspark.sql import Column, functions as F

HOURS_PER_DAY = 24  # `step` counts hours


def party_pair(orig: str = "nameOrig", dest: str = "nameDest") -> Column:
    """`CC`, `CM`, `MC` or `MM`: kinds of the two parties (customer, merchant).

    Null when a name is null; one letter when a name is empty.
    """
    return F.concat(F.col(orig).substr(1, 1), F.col(dest).substr(1, 1))


def hour_of_day(step: str = "step") -> Column:
    """Hour of the day of a step; keeps the sign of a negative step."""
    return F.col(step) % HOURS_PER_DAY
