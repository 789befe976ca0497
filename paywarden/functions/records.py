"""JSON text <-> record columns, and row keys."""

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType


def encode_record(*columns: str) -> Column:
    """One JSON object with all the columns; nulls are written out as `null`."""
    return F.to_json(F.struct(*(columns or ("*",))), {"ignoreNullFields": "false"})


def decode_record(data: str | Column, schema: StructType) -> Column:
    """Struct parsed from JSON text under a given schema.

    Text that is no JSON object gives a struct of nulls, a field of another
    type gives a null field, null or empty text gives a null struct: no row
    is lost and none fails the query.
    """
    return F.from_json(data, schema, {"mode": "PERMISSIVE"})


def content_key(*columns: str) -> Column:
    """SHA-256 over the row, for records that come without an id.

    Two equal records share a key: without an id they cannot be told apart.
    """
    return F.sha2(encode_record(*columns), 256)


def hash_prefix(key: str, seed: int = 0) -> Column:
    """First 32 bits of a seeded MD5 of a key, as 8 hex digits.

    Depends on the value of the key only, so it survives repartitioning and
    task retries. Hex digits of equal length sort like the numbers they spell.
    A null key has a hash too, so that no row falls through.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 8)


def hash_bound(share: float) -> str | None:
    """Upper bound (exclusive) on `hash_prefix` that keeps `share` of the keys;
    None when all of them are kept."""
    limit = round(share * 2**32)
    return None if limit >= 2**32 else f"{limit:08x}"
