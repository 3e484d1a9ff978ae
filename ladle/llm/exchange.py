"""Which keys do several documents share? One packed shuffle of (key, document) that stays balanced under hot keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ladle.llm.common import mix

PACKED = "bucket int, kind int, docs binary, counts binary, keys binary"
TOLD = "home int, docs binary, counts binary, keys binary"
FOUND = "doc_id long, found binary"


def _runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    edge = np.flatnonzero(x[1:] != x[:-1]) + 1
    return zip([0, *edge], [*edge, len(x)], strict=True) if len(x) else iter(())


def _split(docs: np.ndarray, keys: np.ndarray, bucket: np.ndarray, kind: int, size: int) -> Iterator[tuple]:
    """One packed row per bucket: document ids, keys per document, and the keys (``size`` low bytes each)."""
    order = np.lexsort((docs, bucket))
    docs, keys, bucket = docs[order], keys[order], bucket[order]
    for lo, hi in _runs(bucket):
        ids, counts = np.unique(docs[lo:hi], return_counts=True)
        low = np.ascontiguousarray(keys[lo:hi]).view(np.uint8).reshape(-1, 8)[:, :size]
        yield int(bucket[lo]), kind, ids.tobytes(), counts.astype(np.uint32).tobytes(), low.tobytes()


def _unpack(row: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["docs"], np.int64)
    counts = np.frombuffer(row["counts"], np.uint32)
    low = np.frombuffer(row["keys"], np.uint8).reshape(-1, size)
    keys = np.zeros((len(low), 8), np.uint8)
    keys[:, :size] = low
    return np.repeat(ids, counts), keys.view(np.uint64).ravel()


def _rows(docs: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One row per document with its distinct keys."""
    order = np.lexsort((keys, docs))
    docs, keys = docs[order], keys[order]
    new = np.r_[True, (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])] if len(docs) else np.zeros(0, bool)
    docs, keys = docs[new], keys[new]
    for lo, hi in _runs(docs):
        yield int(docs[lo]), keys[lo:hi].tobytes()


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    cols = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.table([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names)


def _shared(docs: np.ndarray, keys: np.ndarray, first_too: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts by key and document. Returns the order, which sorted entries are found, and which stand first or last of their key."""
    order = np.lexsort((docs, keys))
    d, k = docs[order], keys[order]
    first = np.r_[True, k[1:] != k[:-1]]
    run = np.cumsum(first) - 1
    lo = np.flatnonzero(first)
    hi = np.r_[lo[1:], len(k)] - 1
    found = d > d[lo][run]
    if first_too:
        found = (d[lo] != d[hi])[run]
    ends = first.copy()
    if first_too:
        ends[hi] = True
    return order, found, ends


def shared_keys(
    df: DataFrame, keys_of: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], buckets: int, first_too: bool, size: int = 8
) -> DataFrame:
    """One row (doc_id, found) per document that has keys which other documents hold too: those keys, packed.

    ``keys_of`` turns a batch into document ids and keys. With ``first_too`` every holder of a key that at least two documents
    have is told; otherwise those that are not its smallest holder. Holders within one batch are settled at once: only the
    smallest (and, with ``first_too``, the largest) goes on, so a key that every document holds costs two entries a batch.
    ``size`` low bytes of a key are compared; below 8 a key may rarely be reported that no other document holds.
    """
    mask = np.uint64((1 << (8 * size)) - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = keys_of(batch)
            if not len(keys):
                continue
            bucket = (mix_bucket(keys) % np.uint64(buckets)).astype(np.int32)
            keys = keys & mask
            order, found, ends = _shared(docs, keys, first_too)
            known, going = order[found], order[ends]
            out = [*_split(docs[going], keys[going], bucket[going], 0, size)]
            if len(known):
                out += _split(docs[known], keys[known], _home(docs[known], buckets), 1, size)
            cols = zip(*out, strict=True)
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], ["bucket", "kind", "docs", "counts", "keys"])

    def meet(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        ids, keys = [], []
        open_docs, open_keys = [], []
        for r in rows:
            d, k = _unpack(r, size)
            (ids if r["kind"] else open_docs).append(d)
            (keys if r["kind"] else open_keys).append(k)
        if open_docs:
            d, k = np.concatenate(open_docs), np.concatenate(open_keys)
            order, found, _ = _shared(d, k, first_too)
            told = order[found]
            ids.append(d[told])
            keys.append(k[told])
        docs, keys = np.concatenate(ids), np.concatenate(keys)
        out = [(b, d, c, k) for b, _, d, c, k in _split(docs, keys, _home(docs, buckets), 0, size)]
        return _table(out, ["home", "docs", "counts", "keys"], [pa.int32(), pa.binary(), pa.binary(), pa.binary()])

    def gather(group: pa.Table) -> pa.Table:
        parts = [_unpack(r, size) for r in group.to_pylist()]
        out = [*_rows(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))]
        return _table(out, ["doc_id", "found"], [pa.int64(), pa.binary()])

    packed = df.mapInArrow(deal, PACKED)
    return packed.groupBy("bucket").applyInArrow(meet, TOLD).groupBy("home").applyInArrow(gather, FOUND)


def _home(docs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(docs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def mix_bucket(keys: np.ndarray) -> np.ndarray:
    """The high bits decide the bucket; the low bytes travel."""
    return keys >> np.uint64(40)


def held(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Membership of ``keys`` in ``found``."""
    if not len(found):
        return np.zeros(len(keys), bool)
    found = np.unique(found)
    at = np.searchsorted(found, keys)
    at[at == len(found)] = 0
    return found[at] == keys
