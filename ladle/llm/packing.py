"""Packing of token sequences into as few rows of ``capacity`` tokens as it can, by length patterns fitted to the histogram.

A document is its ids and the end id. Longer ones than ``capacity`` are cut into pieces; pieces are never cut again. The lengths of all
pieces give a histogram of at most ``capacity`` counts; only that reaches the driver. There

1. patterns of few documents whose lengths fill a row to the last token are enumerated, all of one, two and three lengths that occur;
2. repeat counts of the patterns are fitted to the histogram by non-negative least squares. Columns join in rounds, where the residual
   pulls most, so the fitted set stays small; a length weighs as its share of the row, as that is what it wastes if left over;
3. counts are rounded down, then up again in order of what was cut off as long as pieces are left, so no place in a pattern stays empty;
4. what is left is packed by best fit decreasing, on counts of equal lengths instead of single pieces. Steps 3 and 4 are tried with
   the whole counts and with PARTS of them, as short pieces in the rest help long ones; the plan with the fewest rows counts.

The outcome is a plan with a row for each place of a pattern: which pieces of a length, counted in order of their document, go there. Pieces
are numbered within their length by range partitions, so a length that a third of all pieces have lies in many tasks, and find
their sequence by a look-up in the plan. The plan has at most a few places for each length and fitted pattern, whatever the number of documents.

Cases: a null or empty text is the end id alone. Rows with null or repeated doc_id are packed like any other. An empty table gives
no rows. Other columns are ignored. Sequence ids are 0, 1, 2 and so on without gaps.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import materialize, tune, width
from ladle.llm.encoder import closed, encoder
from ladle.operators.ordering import row_positions

CAPACITY = 2048
END_ID = 0
PART_BYTES = 32 << 20
ROUNDS = 24
STEPS = 100
#: Parts of the fitted counts that are tried.
PARTS = (1.0, 0.9, 0.75, 0.5)
#: A fit ends once a round mends less than this share of what there was to fit.
ENOUGH = 1e-4
#: Ranks within a length stay below.
_RANKS = 1 << 44

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32), and with ``ids`` the ids as little-endian 32-bit integers."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            flat, ptr = closed(*coder.batch(batch.column("text")), end_id)
            count = -(-np.diff(ptr) // capacity)
            own = np.repeat(np.arange(len(count)), count)
            piece = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            at = ptr[own] + piece * capacity
            length = np.minimum(ptr[own + 1] - at, capacity)
            raw = memoryview(flat.astype("<u4")).cast("B")
            cells = [raw[4 * a : 4 * (a + n)] for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            cols = {
                "doc_id": batch.column("doc_id").take(pa.array(own)), "piece": pa.array(piece, pa.int32()), "start": pa.array(piece * capacity, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids_crc32": pa.array([zlib.crc32(x) for x in cells], pa.int64()),
            }
            if ids:
                cols["ids"] = pa.array([x.tobytes() for x in cells], pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return base.mapInArrow(run, PIECES + (", ids binary" if ids else ""))


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All patterns of one to three of the lengths (ascending, distinct) that add up to ``capacity``: rows in ascending order, zeros first."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    out = [np.array([[0, 0, capacity]])] if there[capacity] else []
    small = lengths[lengths <= capacity // 2]
    two = small[there[capacity - small]]
    out.append(np.stack([np.zeros_like(two), two, capacity - two], 1))
    for a in lengths[lengths <= capacity // 3]:
        b = lengths[(lengths >= a) & (lengths <= (capacity - a) // 2)]
        b = b[there[capacity - a - b]]
        out.append(np.stack([np.full_like(b, a), b, capacity - a - b], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def _solve(cols: np.ndarray, counts: np.ndarray, weight: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Non-negative least squares of weighted counts by accelerated projected gradients, each column scaled by its own curvature."""
    square = weight**2
    touched = np.bincount(cols.ravel(), minlength=len(counts))
    # A column moves with all others that share a length: the row sums of the normal matrix bound its curvature.
    scale = np.maximum((square[cols] * touched[cols]).sum(1) * 3, 1e-12)
    now, ahead, t = x, x, 1.0
    for _ in range(STEPS):
        left = np.bincount(cols.ravel(), np.repeat(ahead, 3), len(counts)) - counts
        left[0] = 0
        new = np.maximum(ahead - (square * left)[cols].sum(1) / scale, 0)
        faster = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = np.maximum(new + (t - 1) / faster * (new - now), 0)
        now, t = new, faster
    return now


def fit(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and their repeat counts (real numbers) for ``counts`` of the lengths 0 to ``capacity``."""
    every = patterns(np.flatnonzero(counts), capacity)
    weight = np.arange(capacity + 1) / capacity
    goal = counts.astype(float)
    goal[0] = 0
    x, chosen = np.zeros(0), np.zeros(0, np.int64)
    last = np.inf
    for _ in range(ROUNDS):
        used = np.bincount(every[chosen].ravel(), np.repeat(x, 3), capacity + 1)
        left = (goal - used) * weight
        left[0] = 0
        off = float(left @ left)
        if not len(every) or off > last * (1 - ENOUGH) or off == 0:
            break
        last = off
        pull = (left * weight)[every].sum(1)
        # For each length the patterns that the residual pulls most.
        order = np.argsort(-pull, kind="stable")[: int((pull > 0).sum())]
        first = [order[np.unique(every[order, k], return_index=True)[1]] for k in range(3)]
        new = np.setdiff1d(np.concatenate(first), chosen)
        if not len(new):
            break
        chosen, x = np.r_[chosen, new], np.r_[x, np.zeros(len(new))]
        x = _solve(every[chosen], goal, weight, x)
        chosen, x = chosen[x > 1e-9], x[x > 1e-9]
    return every[chosen], x


def rounded(cols: np.ndarray, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole repeat counts, down and then up, that no length runs out for, and what they leave of ``counts``."""
    left = counts.copy()
    out = np.zeros(len(x), np.int64)
    for up, order in ((0, np.argsort(-x, kind="stable")), (1, np.argsort(np.floor(x) - x, kind="stable"))):
        for i in order.tolist():
            need = Counter(v for v in cols[i].tolist() if v)
            most = min(left[v] // n for v, n in need.items())
            take = min(int(most), 1 if up else int(x[i]))
            out[i] += take
            for v, n in need.items():
                left[v] -= take * n
    return out, left


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing of ``counts``: patterns with their repeat counts. Rows with the same content are kept as one with a count."""
    rows: dict[int, list] = {}
    open_: list[int] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        free = capacity - sum(pattern)
        if free not in rows:
            rows[free] = []
            bisect.insort(open_, free)
        rows[free].append([pattern, n])

    for length in range(capacity, 0, -1):
        todo = int(counts[length])
        while todo:
            at = bisect.bisect_left(open_, length)
            if at == len(open_):
                each = capacity // length
                full, rest = divmod(todo, each)
                if full:
                    put((length,) * each, full)
                if rest:
                    put((length,) * rest, 1)
                break
            free = open_[at]
            pattern, n = rows[free][-1]
            # As many copies as fit: after the first the row is the fullest that still takes one.
            each = min(free // length, todo)
            take = min(n, todo // each)
            rows[free][-1][1] -= take
            if n == take:
                rows[free].pop()
                if not rows[free]:
                    del rows[free], open_[at]
            put(pattern + (length,) * each, take)
            todo -= take * each
    return [(p, n) for same in rows.values() for p, n in same]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their repeat counts that hold exactly ``counts`` (of the lengths 0 to ``capacity``) pieces."""
    cols, x = fit(counts, capacity)
    best = None
    for part in PARTS:
        times, left = rounded(cols, part * x, counts)
        fitted = [(tuple(v for v in p if v), n) for p, n in zip(cols.tolist(), times.tolist(), strict=True) if n]
        chosen = fitted + best_fit(left, capacity)
        if best is None or sum(n for _, n in chosen) < sum(n for _, n in best):
            best = chosen
    return best


def _places(chosen: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """For each place of each pattern: length * _RANKS + first rank, first sequence, offset; ascending."""
    used, base, out = Counter(), 0, []
    for pattern, n in chosen:
        at = 0
        for length in pattern:
            out.append((length * _RANKS + used[length], base, at))
            used[length] += n
            at += length
        base += n
    return tuple(np.array(c, np.int64) for c in zip(*sorted(out), strict=True)) if out else (np.zeros(0, np.int64),) * 3


def pack(table: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """The stored rows of ``table`` (a column ``length`` of 1 to ``capacity``) with sequence_id and offset. Rows that agree in ``order``
    and length may change places with each other."""
    spark = table.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for r in table.groupBy("length").count().collect():  # at most one row a length
        counts[r["length"]] = r["count"]
    chosen = spark.sparkContext.broadcast(_places(plan(counts, capacity)))
    names = table.columns
    ranked = row_positions(table, list(order), groups=["length"], name="__rank", buckets=width(table, PART_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, base, at = chosen.value
        for batch in batches:
            rank = batch.column("__rank").to_numpy() - 1
            place = batch.column("length").to_numpy() * _RANKS + rank
            i = np.searchsorted(first, place, "right") - 1
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(base[i] + place - first[i]), pa.array(at[i])], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return ranked.mapInArrow(run, schema + ", sequence_id long, offset long")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return pack(materialize(pieces(docs, path, capacity, end_id, key, text, ids), "pieces"), capacity)


def sequences(done: DataFrame) -> DataFrame:
    """Packed pieces with ids joined: (sequence_id, ids, doc_ids, offsets). A sequence has at most ``capacity`` pieces."""
    cells = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    held = done.groupBy("sequence_id").agg(cells.alias("c"))
    joined = F.aggregate("c", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return held.select("sequence_id", joined.alias("ids"), F.col("c.doc_id").alias("doc_ids"), F.col("c.offset").alias("offsets"))
