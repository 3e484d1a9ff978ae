"""Token ids of documents in raw shard files, with a minimal perfect hash index for keyed access.

Files. A shard is ``LTOKENS1``, the width of an id in bytes (2 or 4) and the number of ids, both little-endian unsigned 64-bit,
and then the ids, little-endian. Shards follow the order of the keys: concatenated they hold all documents, each closed
by the end id. ``shards`` is a Parquet table of them (name, ids before, ids in it); a shard that a lost task began has a
name of its own and is not listed. ``index`` is a Parquet table with a row per hash bucket of keys: a minimal perfect hash
function (levels of bits with the number of bits before each word; a key belongs to the first level where it fell alone, and its number is
the rank of its bit), and for each number a fingerprint of the key, its first entry and the entries (shard, offset, ids). A look-up
hashes the key, reads one bucket, there one word a level, compares the fingerprint and reads one stretch of one shard:
constant time, whatever the number of documents.

Cases: a null or empty text is the end id alone. Rows without key come first and are stored and listed, but have no entry in the
index. Rows that share a key lie side by side, and a look-up gives all of them. An empty table has no shard. A key that
is not stored is not found, except with the 1 in 2**32 chance of an equal fingerprint. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import materialize, measured_bytes, mix, tune, width
from ladle.llm.encoder import Encoder as Tokens  # noqa: F401
from ladle.llm.encoder import closed, encoder
from ladle.session import scratch_path

MAGIC = b"LTOKENS1"
END_ID = 2
PART_BYTES = 8 << 20
SHARD_BYTES = 32 << 20
KEYS_PER_BUCKET = 1 << 17
BROADCAST_BYTES = 8 << 20


def _write_shards(path: str, root: str, end_id: int):
    """Rows (part, seq, shard, doc_id, at, n) of the documents written by a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        store, place = fs.FileSystem.from_uri(root)
        part, seq, held, size, rows = TaskContext.get().partitionId(), 0, [], 0, []

        def close() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.ids"
            store.create_dir(place, recursive=True)
            with store.open_output_stream(f"{place}/{name}") as out:
                out.write(MAGIC + np.array([coder.kind.itemsize, size], "<u8").tobytes())
                for x in held:
                    out.write(x)
            ids = pa.concat_arrays([x[0] for x in rows])
            ats, ns = (pa.array(np.concatenate([x[k] for x in rows]), pa.int64()) for k in (1, 2))
            same = [pa.repeat(pa.scalar(v), len(ids)) for v in (np.int32(part), np.int32(seq), name)]
            return pa.RecordBatch.from_arrays([*same, ids, ats, ns], ["part", "seq", "shard", "doc_id", "at", "n"])

        for batch in batches:
            ids, ptr = closed(*coder.batch(batch.column("text")), end_id)
            rows.append((batch.column("doc_id"), ptr[:-1] + size, np.diff(ptr)))
            held.append(ids)
            size += len(ids)
            if size * coder.kind.itemsize >= SHARD_BYTES:
                yield close()
                seq, held, size, rows = seq + 1, [], 0, []
        if size:
            yield close()

    return run


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix(h + seed) % np.uint64(size)).astype(np.int64)


def build_hash(h: np.ndarray) -> list[np.ndarray]:
    """Levels of bits of a minimal perfect hash function for distinct 64-bit values."""
    levels = []
    while len(h):
        size = max(64, len(h) + len(h) // 2)
        at = _place(h, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        h = h[~alone[at]]
        if len(levels) > 200:
            raise ValueError("keys are not distinct")
    return levels


def look_up(levels: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    """Number of each key; -1 where every level's bit is off."""
    out = np.full(len(h), -1, np.int64)
    base = 0
    for i, bits in enumerate(levels):
        open_ = np.flatnonzero(out < 0)
        at = _place(h[open_], i, len(bits))
        rank = np.cumsum(bits)
        hit = bits[at]
        out[open_[hit]] = base + rank[at[hit]] - 1
        base += int(rank[-1]) if len(rank) else 0
    return out


def pack(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The levels as 64-bit words, for each word the number of bits before it, and for each level its bits and its first word."""
    words = [np.packbits(np.pad(x, (0, -len(x) % 64)), bitorder="little").view("<u8") for x in levels]
    bits = np.concatenate(words) if words else np.zeros(0, "<u8")
    before = np.cumsum(np.bitwise_count(bits), dtype=np.int64)
    first = np.cumsum([0, *map(len, words)])[: len(words)]
    return bits, np.r_[0, before[:-1]].astype(np.int64) if len(bits) else before, np.array([[len(x) for x in levels], first], np.int64)


def look_up_packed(bits: np.ndarray, before: np.ndarray, sizes: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The same numbers as ``look_up``; a key reads one word of each level until its bit is on."""
    out = np.full(len(h), -1, np.int64)
    one = np.uint64(1)
    for i, (size, first) in enumerate(sizes.T.tolist()):
        open_ = np.flatnonzero(out < 0)
        at = _place(h[open_], i, size)
        word, bit = first + (at >> 6), (at & 63).astype(np.uint64)
        held = bits[word]
        hit = (held >> bit) & one == one
        out[open_[hit]] = (before[word] + np.bitwise_count(held & ((one << bit) - one)))[hit]
    return out


def _key(ids: np.ndarray) -> np.ndarray:
    return mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0xA0761D6478BD642F))


def _mark(ids: np.ndarray) -> np.ndarray:
    return mix(_key(ids) ^ np.uint64(0xE7037ED1A0B428DB)).astype(np.uint32)


INDEX = "bucket int, bits binary, before binary, sizes binary, marks binary, first binary, shard binary, at binary, n binary"
#: So many buckets at most are named in a filter; beyond that the whole index is read.
NAMED_BUCKETS = 1000


def _build_bucket(group: pa.Table) -> pa.Table:
    ids, shard, at, n = (group.column(c).to_numpy() for c in ("doc_id", "no", "at", "n"))
    order = np.lexsort((at, shard, ids))
    ids, shard, at, n = ids[order], shard[order], at[order], n[order]
    cut = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    levels = build_hash(_key(ids[cut]))
    number = look_up(levels, _key(ids[cut]))
    marks = np.zeros(len(cut), np.uint32)
    marks[number] = _mark(ids[cut])
    by_number = np.argsort(number)
    count = np.diff(np.r_[cut, len(ids)])[by_number]
    first = np.r_[0, np.cumsum(count)].astype(np.int64)
    pick = np.repeat(cut[by_number] - first[:-1], count) + np.arange(len(ids))
    cells = [*pack(levels), marks, first, shard[pick].astype(np.int64), at[pick].astype(np.int64), n[pick].astype(np.int64)]
    row = {"bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32())}
    names = ("bits", "before", "sizes", "marks", "first", "shard", "at", "n")
    return pa.table(row | {k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(names, cells, strict=True)})


def _find(keys: pa.Table, index: pa.Table) -> pa.Table:
    """Distinct keys of a bucket with the entries of the index."""
    ids = np.unique(keys.column("doc_id").to_numpy())
    if not index.num_rows or not len(ids):
        return pa.table({c: pa.array([], pa.int64()) for c in ("doc_id", "no", "at", "n")})
    read = lambda c, kind: np.frombuffer(index.column(c)[0].as_buffer(), kind)
    marks, first = read("marks", np.uint32), read("first", np.int64)
    number = look_up_packed(read("bits", "<u8"), read("before", np.int64), read("sizes", np.int64).reshape(2, -1), _key(ids))
    ok = (number >= 0) & (marks[np.maximum(number, 0)] == _mark(ids))
    ids, number = ids[ok], number[ok]
    count = first[number + 1] - first[number]
    pick = np.repeat(first[number] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    cells = {c: read(c, np.int64)[pick] for c in ("shard", "at", "n")}
    return pa.table({"doc_id": np.repeat(ids, count), "no": cells["shard"], "at": cells["at"], "n": cells["n"]})


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("bucket")


class Store:
    """A written store: ``root`` (shard files), ``shards`` and ``index`` (tables), ``buckets``; ``listed``: one row a document."""

    def __init__(self, root: str, shards: DataFrame, index: DataFrame, listed: DataFrame, buckets: int):
        self.root, self.shards, self.index, self.listed, self.buckets = root, shards, index, listed, buckets

    def find(self, keys: DataFrame) -> DataFrame:
        """(doc_id, no, at, n) of every stored row of the keys in column doc_id, through the index."""
        asked = keys.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).select("doc_id", _bucket(self.buckets))
        named = [r["bucket"] for r in asked.select("bucket").distinct().limit(NAMED_BUCKETS + 1).collect()]
        index = self.index.where(F.col("bucket").isin(named)) if len(named) <= NAMED_BUCKETS else self.index
        both = asked.groupBy("bucket").cogroup(index.groupBy("bucket"))
        return both.applyInArrow(_find, "doc_id long, no long, at long, n long")

    def read(self, entries: DataFrame) -> DataFrame:
        """Entries (doc_id, no, at, n) with start and the ids, read from the shard files."""
        shards = F.broadcast(self.shards) if measured_bytes(self.shards) <= BROADCAST_BYTES else self.shards
        placed = entries.join(shards, "no").select("doc_id", "no", "shard", "at", "n", (F.col("before") + F.col("at")).alias("start"))
        placed = placed.repartition("no").sortWithinPartitions("no", "at")
        root = self.root

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, place = fs.FileSystem.from_uri(root)
            name, file, kind, ids = None, None, None, []
            for batch in batches:
                ids = []
                for shard, at, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "at", "n")), strict=True):
                    if shard != name:
                        if file is not None:
                            file.close()
                        name, file = shard, store.open_input_file(f"{place}/{shard}")
                        head = file.read_at(24, 0)
                        if head[:8] != MAGIC:
                            raise ValueError(f"{shard} is not a shard")
                        kind = np.dtype(f"<u{int(np.frombuffer(head[8:16], '<u8')[0])}")
                    raw = file.read_at(n * kind.itemsize, 24 + at * kind.itemsize)
                    ids.append(np.frombuffer(raw, kind).astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n"), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
            if file is not None:
                file.close()

        return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def write_store(docs: DataFrame, path: str, end_id: int = END_ID, root: str | None = None, key: str = "doc_id", text: str = "text") -> Store:
    """Encode and write all documents in ascending order of the key."""
    spark = docs.sparkSession
    tune(spark)
    root = root or scratch_path(spark, "tokens")
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}" if root.startswith("/") else root
    elif root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[5:]
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = base.repartitionByRange(width(docs, PART_BYTES), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    listed = materialize(ordered.mapInArrow(_write_shards(path, root, end_id), "part int, seq int, shard string, doc_id long, at long, n long"), "listed")
    line = Window.orderBy("part", "seq")  # one row a shard
    shards = listed.groupBy("part", "seq", "shard").agg(F.sum("n").alias("ids")).withColumns(
        {"no": (F.row_number().over(line) - 1).cast("long"), "before": F.sum("ids").over(line) - F.col("ids")}
    )
    shards = materialize(shards.select("no", "shard", "before", "ids"), "shards")
    named = F.broadcast(shards) if measured_bytes(shards) <= BROADCAST_BYTES else shards
    listed = listed.join(named.select("no", "shard"), "shard").select("doc_id", "no", "at", "n")
    count = listed.count()
    buckets = max(1, -(-count // KEYS_PER_BUCKET))
    index = listed.where("doc_id IS NOT NULL").select("doc_id", "no", "at", "n", _bucket(buckets)).groupBy("bucket").applyInArrow(_build_bucket, INDEX)
    return Store(root, shards, materialize(index.sortWithinPartitions("bucket"), "index"), listed, buckets)


def read_back(store: Store, keys: DataFrame) -> DataFrame:
    """Per stored row of the keys (and per row without key): doc_id, start, n_tokens, ids_crc32, from the files."""
    nameless = store.listed.where("doc_id IS NULL").select("doc_id", "no", "at", "n")
    entries = store.find(keys)
    if keys.where("doc_id IS NULL").limit(1).count():
        entries = entries.union(nameless)
    got = store.read(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return got.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
