"""Shard placement by a permutation-filled lookup table.

Every shard ranks all slots of a prime-sized table by its own permutation (offset + i * skip modulo the size, both hashed from the
shard's name). Shards take turns, each claiming the first slot of its ranking that is still free, until all slots are taken; a
shard of weight w takes w turns a round. So each shard holds its share of slots within one turn, and when a shard comes or goes
few slots change hands. The table (SIZE rows, whatever the data) is broadcast: a key's slot is a hash modulo SIZE, its shard one
look-up. A key's placement depends on the key and the shards alone, never on order, partitions or other rows.

Cases: a null key is placed by the text ``null`` followed by the hash of all other plain columns named in ``spread`` (none: all
null keys share a slot). Repeated keys share a shard. An empty table gives no rows. A column that is called slot or shard is
replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prime.
SIZE = 65537


def _number(name: str, use: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{use}:{name}".encode()).digest()[:8], "big")


def fill(shards: Sequence[str], size: int = SIZE, weights: dict[str, int] | None = None) -> list[int]:
    """Shard number of every slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be named, distinct and no more than slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    at = [_number(s, "offset") % size for s in shards]
    skip = [_number(s, "skip") % (size - 1) + 1 for s in shards]
    turns = [max(1, (weights or {}).get(s, 1)) for s in shards]
    slots = [-1] * size
    left = size
    while left:
        for k in range(len(shards)):
            for _ in range(turns[k]):
                while slots[at[k]] >= 0:
                    at[k] = (at[k] + skip[k]) % size
                slots[at[k]] = k
                left -= 1
                if not left:
                    return slots
    return slots


def slot_table(spark: SparkSession, shards: Sequence[str], size: int = SIZE, weights: dict[str, int] | None = None) -> DataFrame:
    """Rows (slot, shard): ``size`` rows."""
    rows = [(i, shards[k]) for i, k in enumerate(fill(shards, size, weights))]
    return spark.createDataFrame(rows, "slot int, shard string")


def slot_of(key: Column, size: int = SIZE) -> Column:
    """The first 15 hexadecimal digits of the key's MD5, modulo the table size: the same in any engine."""
    digits = F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long")
    return (digits % size).cast("int")


def place(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", size: int = SIZE, weights: dict[str, int] | None = None, spread: Sequence[str] = ()) -> DataFrame:
    """``docs`` with slot and shard."""
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null"), F.xxhash64(*spread).cast("string")) if spread else F.lit("null"))
    kept = [c for c in docs.columns if c not in ("slot", "shard") or c == key]
    placed = docs.select(*[F.col(c) for c in kept if c not in ("slot", "shard")], slot_of(name, size).alias("slot"))
    return placed.join(F.broadcast(slot_table(docs.sparkSession, shards, size, weights)), "slot").select(*[c for c in kept if c not in ("slot", "shard")], "slot", "shard")


def write_placed(docs: DataFrame, path: str, shards: Sequence[str], key: str = "doc_id", rows_per_file: int = 1 << 20, **options) -> None:
    """Write ``docs`` below ``path``, a folder a shard. A shard's rows may come from many tasks, so no task holds a whole shard."""
    place(docs, shards, key, **options).write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)


def read_placed(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """What ``write_placed`` wrote, as ``columns`` (names and types of the documents' columns); a filter on ``shard`` reads that shard's
    folder alone. Where nothing was written there are no rows."""
    return spark.read.schema(f"{columns}, slot int, shard string").option("basePath", path).parquet(path)
