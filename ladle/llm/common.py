"""Shared helpers: table readers, sizes, and a vectorised word tokeniser over Arrow text buffers.

Words are maximal runs of bytes outside a separator set (all separators are ASCII, so UTF-8 sequences stay whole).
A word is identified by a 64-bit hash of its bytes, a word window by a 64-bit hash of its word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.session import materialize, measured_bytes, shuffle_width

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20
BATCH_ROWS = 2048
BATCH_BYTES = 8 << 20

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_PUNCT = _SPACES.copy()
_PUNCT[[b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_BYTE = None
_POWERS: dict[int, np.ndarray] = {}


def tune(spark: SparkSession) -> None:
    """Smaller Arrow batches than the default, so that a worker holds few whole texts at a time."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(df: DataFrame, bytes_per_group: int) -> int:
    """Number of hash groups for a table of the measured size, at least one per shuffle task."""
    return max(shuffle_width(df.sparkSession), -(-known_bytes(df) // bytes_per_group))


def known_bytes(df: DataFrame) -> int:
    """Size of the table's files; 0 where Spark has no figure (rows that come from an RDD)."""
    size = measured_bytes(df)
    return size if size < 1 << 58 else 0


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (in place when possible)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def _bytes_table() -> np.ndarray:
    global _BYTE
    if _BYTE is None:
        _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD)) | np.uint64(1)
    return _BYTE


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, CHUNK_BYTES + 4096), base, np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        if n <= 4 * CHUNK_BYTES:
            _POWERS[base] = got
    return got


@dataclass
class Words:
    """Words of some consecutive texts: ``ptr[d]:ptr[d+1]`` are the words of text d."""

    ptr: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def text_of(self, d: int, keep: np.ndarray | None = None) -> bytes:
        """Words of text d (those under ``keep``), joined by one space."""
        lo, hi = self.ptr[d], self.ptr[d + 1]
        s, e = self.start[lo:hi], self.end[lo:hi]
        if keep is not None:
            s, e = s[keep], e[keep]
        raw = self.data
        return b" ".join([raw[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist(), strict=True)])


def _scan(raw: np.ndarray, breaks: np.ndarray, seps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, ends and hashes of a byte range; ``breaks`` are offsets where a text begins."""
    inside = ~seps[raw]
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = breaks[(breaks > 0) & (breaks < len(raw))]
    before[cut] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after[cut - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_bytes_table()[raw] * _powers(_ODD, len(raw))[: len(raw)], out=sums[1:])
    h = (sums[end] - sums[start]) * _powers(_INVERSE, len(raw))[start]
    return start, end, mix(h + (end - start).astype(np.uint64))


def _pieces(raw: np.ndarray, lo: int, hi: int, seps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about CHUNK_BYTES that end at a separator (or at the end)."""
    while hi - lo > CHUNK_BYTES:
        at = lo + CHUNK_BYTES
        step = 4096
        while at < hi:
            found = np.flatnonzero(seps[raw[at : min(hi, at + step)]])
            if len(found):
                at += int(found[0])
                break
            at, step = min(hi, at + step), step * 4
        yield lo, at
        lo = at
    if hi > lo:
        yield lo, hi


def tokens(texts: pa.Array, lower: bool = False, punctuation: bool = False, seps: np.ndarray | None = None) -> Words:
    """Words of an Arrow string column; a null text has none. ``punctuation``: ASCII punctuation separates too; ``seps``: which ASCII
    bytes separate, in place of either."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64, n + 1 + texts.offset)[texts.offset :]
    if texts.null_count:
        texts = texts.fill_null("")
        off = np.frombuffer(texts.buffers()[1], np.int64, n + 1 + texts.offset)[texts.offset :]
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    raw, off = raw[off[0] : off[-1]], off - off[0]
    if lower:
        raw = _LOWER[raw]
    if seps is None:
        seps = _PUNCT if punctuation else _SPACES
    parts = []
    d = 0
    while d < n:
        stop = max(d + 1, int(np.searchsorted(off, off[d] + CHUNK_BYTES, "right")) - 1)
        for lo, hi in _pieces(raw, int(off[d]), int(off[stop]), seps) if stop == d + 1 else [(int(off[d]), int(off[stop]))]:
            if hi > lo:
                s, e, h = _scan(raw[lo:hi], off[d:stop] - lo, seps)
                parts.append((s + lo, e + lo, h))
        d = stop
    start, end, h = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return Words(np.searchsorted(start, off), h, start, end, raw)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows by first word, and which of them lie in one text. Length: number of words."""
    h = np.zeros(len(w.hashes), np.uint64)
    size = len(h) - n + 1
    if size > 0:
        part = w.hashes[:size].copy()
        for k in range(1, n):
            part *= _GRAM
            part += w.hashes[k : k + size]
        h[:size] = mix(part)
    last = np.repeat(w.ptr[1:], w.counts) - n
    return h, np.arange(len(h)) <= last


def crc32_of_id(col: str = "doc_id"):
    return F.crc32(F.col(col).cast("string"))


__all__ = ["materialize", "measured_bytes", "shuffle_width"]
