"""Record layouts shared by every hop.

A streaming read needs its schema up front, so each layout that is written by
one hop and read by the next one is declared here once.
"""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_int, _double, _string = T.IntegerType(), T.DoubleType(), T.StringType()

# Field names and types of a source transaction record.
RECORD = _struct(
    ("step", _int),
    ("type", _string),
    ("amount", _double),
    ("nameOrig", _string),
    ("oldbalanceOrg", _double),
    ("newbalanceOrig", _double),
    ("nameDest", _string),
    ("oldbalanceDest", _double),
    ("newbalanceDest", _double),
    ("isFraud", _int),
    ("isFlaggedFraud", _int),
)

# The raw text layout, the multiplex (bronze) layout, the member list.
RAW = _struct(("data", _string))
BRONZE = _struct(("receipt_time", T.TimestampType()), ("dataset", _string), ("data", _string))
MEMBERS = _struct(("nameOrig", _string), ("userid", _string), ("webhook_url", _string))

# Tag of the transaction records in the multiplex table.
TRANSACTIONS = "transactions"

# Columns of the refined layout that are carried over unchanged; `transaction`
# and `hour` are computed.
REFINED_SOURCE = [
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "oldbalanceDest", "newbalanceDest",
]

# Model inputs, in the order of the training frame.
FEATURES = [c for c in REFINED_SOURCE if c != "nameOrig"] + ["transaction", "hour"]


def with_key(schema: T.StructType, key: str, dtype: T.DataType | None = None) -> T.StructType:
    """`schema` preceded by a row-key column (records themselves carry no id)."""
    return T.StructType([T.StructField(key, dtype or T.LongType()), *schema.fields])
