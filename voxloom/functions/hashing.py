"""Bucket hash of integer tuples, in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modulus and coefficients of the bucket hash.
PRIME = 4839472903831
FACTOR = 614129754220
SHIFT = 3451128447982


def bucket(columns: list[Column], buckets: int) -> Column:
    """(FACTOR * n + SHIFT) mod PRIME mod buckets, n the little-endian number of the comma-joined digits."""
    text = F.concat_ws(",", *(c.cast("long").cast("string") for c in columns))
    digits = F.reverse(F.split(text, ""))
    n = F.aggregate(digits, F.lit(0).cast("long"), lambda acc, c: F.pmod(acc * 256 + F.ascii(c), F.lit(PRIME)))
    wide = F.lit(FACTOR).cast("decimal(15,0)") * n.cast("decimal(15,0)") + F.lit(SHIFT).cast("decimal(15,0)")
    return F.pmod(F.pmod(wide, F.lit(PRIME).cast("decimal(15,0)")).cast("long"), F.lit(buckets).cast("long"))


def partner_bucket(columns: list[Column], buckets: int, fill: int = -1) -> Column:
    """bucket(), or fill if any column is null."""
    missing = columns[0].isNull()
    for c in columns[1:]:
        missing = missing | c.isNull()
    return F.when(missing, F.lit(fill).cast("long")).otherwise(bucket(columns, buckets))
