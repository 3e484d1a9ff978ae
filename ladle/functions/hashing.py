"""Seeded, order-independent pseudo-random order by MD5."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_ROWS = 1 << 14
MOST_DIGITS = 5


def seeded_hash(key: Column, seed: Column | int | str) -> Column:
    """MD5 of ``seed:key``; NULL keys share the hash of a text that no key has."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(seed.cast("string"), F.coalesce(F.concat(F.lit(":"), key.cast("string")), F.lit("-"))))


def cell_digits(rows: int) -> int:
    """Leading digits that cut so many rows into cells of about CELL_ROWS; at most MOST_DIGITS, so that a list of all cells stays small."""
    return min(MOST_DIGITS, max(1, math.ceil(math.log(max(1, rows / CELL_ROWS), 16))))


def hash_cell(h: Column, digits: int) -> Column:
    """Leading digits of the hash: uniform cells that grow with the hash order, no sampling needed."""
    return F.substring(h, 1, digits)


def hash_int(h: Column, low: int, high: int) -> Column:
    """Whole number in ``[low, high)`` drawn from the last eight digits of a hash."""
    return (F.conv(F.substring(h, 25, 8), 16, 10).cast("bigint") % F.lit(high - low) + F.lit(low)).cast("bigint")
