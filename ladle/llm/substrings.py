"""Removal of word windows that an earlier document holds too, found through difference-cover anchors.

A window is ``window`` consecutive words of one document. Only short anchors are compared across the whole corpus: the
``window + 1 - period`` words that start at a position whose remainder modulo ``period`` lies in a difference cover. For any
two alignments of equal windows some shift below ``period`` brings both to cover positions, so equal windows always share an
aligned anchor. Only windows around anchors that another document holds are then compared at full length.

Cases: a null or empty text has no words, loses nothing and is returned with zero counts. A document without doc_id has no
place in the order: it neither loses words nor takes words from others. Rows with the same doc_id never take words from each
other, but each loses what a smaller doc_id holds. Fewer words than a window: nothing is removed. Other columns are untouched;
their names do not matter, as only ``key`` and ``text`` are read. Windows are identified by 64-bit hashes of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ladle.llm.common import Words, grams, tokens, tune, width
from ladle.llm.exchange import held, shared_keys

WINDOW = 13
#: A perfect difference set: every remainder modulo 7 is a difference of two members.
PERIOD, COVER = 7, (0, 1, 3)
GROUP_BYTES = 8 << 20
ANCHOR_BYTES = 6


def anchor_hashes(w: Words, window: int, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> tuple[np.ndarray, np.ndarray]:
    """Positions (word numbers in the batch) and hashes of the anchors."""
    h, whole = grams(w, window + 1 - period)
    place = (np.arange(len(h)) - np.repeat(w.ptr[:-1], w.counts)) % period
    long_enough = np.repeat(w.counts >= window, w.counts)
    at = np.flatnonzero(whole & long_enough & np.isin(place, cover))
    return at, h[at]


def _found(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of the packed column ``found``."""
    packed = [np.frombuffer(p or b"", np.uint64) for p in batch.column("found").to_pylist()]
    rows = np.repeat(np.arange(len(packed)), [len(p) for p in packed])
    return rows, np.concatenate(packed) if packed else np.zeros(0, np.uint64)


def _per_row(rows: np.ndarray, keys: np.ndarray, frows: np.ndarray, fkeys: np.ndarray) -> np.ndarray:
    """Which (row, key) pairs are among the found ones."""
    if not len(fkeys) or not len(keys):
        return np.zeros(len(keys), bool)
    salt = np.uint64(0x9FB21C651E98DF25)
    return held(keys ^ (rows.astype(np.uint64) * salt), fkeys ^ (frows.astype(np.uint64) * salt))


def _windows(batch: pa.RecordBatch, window: int, low: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Documents and hashes of the full windows around anchors that another document holds."""
    w = tokens(batch.column("text"))
    docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
    at, h = anchor_hashes(w, window)
    owner = w.owner
    frows, fkeys = _found(batch)
    hit = at[_per_row(owner[at], h & low, frows, fkeys)]
    mark = np.zeros(len(owner) + 1, np.int32)
    first = np.maximum(hit - (PERIOD - 1), w.ptr[owner[hit]])
    np.add.at(mark, first, 1)
    np.add.at(mark, hit + 1, -1)
    full, whole = grams(w, window)
    near = np.flatnonzero((np.cumsum(mark)[:-1] > 0) & whole)
    return docs[owner[near]].astype(np.int64), full[near]


def _ordered(docs: DataFrame, key: str, text: str, rest: list | None = None) -> DataFrame:
    return docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *(rest or []))


def repeated_windows(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, found): packed hashes of the windows of a document that a smaller doc_id holds too."""
    if window < PERIOD:
        raise ValueError(f"windows of at least {PERIOD} words")
    tune(docs.sparkSession)
    known = _ordered(docs, key, text)
    groups = width(docs, GROUP_BYTES)
    low = np.uint64((1 << (8 * ANCHOR_BYTES)) - 1)

    def anchors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        w = tokens(batch.column("text"))
        at, h = anchor_hashes(w, window)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        return ids[w.owner[at]], h

    near = shared_keys(known, anchors, groups, first_too=True, size=ANCHOR_BYTES)
    joined = known.join(near.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "found")
    return shared_keys(joined, lambda b: _windows(b, window, low), groups, first_too=False)


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text (kept words joined by one space), kept_sha256; with ``keep`` also a
    struct ``row`` of those columns as they were, and the ``text`` as it was."""
    marks = repeated_windows(docs, window, key, text)
    rest = [F.struct(*keep).alias("row")] if keep else []
    names = ["text", "row"] if keep else []
    # Without ``keep`` the shuffle of the texts is the one that repeated_windows makes.
    known = _ordered(docs, key, text, rest)
    joined = known.join(marks.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "found", *names[1:])
    free = docs.where(F.col(key).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("binary").alias("found"), *rest)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = tokens(batch.column("text"))
            owner, counts = w.owner, w.counts
            frows, fkeys = _found(batch)
            gone = np.zeros(len(owner), bool)
            if len(fkeys):
                h, whole = grams(w, window)
                hit = np.flatnonzero(whole & np.isin(owner, np.unique(frows)))
                hit = hit[_per_row(owner[hit], h[hit], frows, fkeys)]
                mark = np.zeros(len(owner) + 1, np.int32)
                np.add.at(mark, hit, 1)
                np.add.at(mark, hit + window, -1)
                gone = np.cumsum(mark)[:-1] > 0
            removed = np.bincount(owner[gone], minlength=len(counts))
            kept = [w.text_of(d, ~gone[w.ptr[d] : w.ptr[d + 1]] if removed[d] else None) for d in range(len(counts))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                    *[batch.column(c) for c in names],
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", *names],
            )

    schema = StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
    schema = StructType([*schema.fields, *[joined.schema[c] for c in names]])
    return joined.mapInArrow(cut, schema).union(free.mapInArrow(cut, schema))
