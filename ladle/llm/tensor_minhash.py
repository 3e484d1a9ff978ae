"""Near-duplicate documents by tensored MinHash banding, with every link confirmed on full shingle sets.

Two sides of SIDE small collections (ROWS minimum hashes each) are computed; a table key is a pair of one left and one right
collection. 2 * SIDE * ROWS hashes thus serve SIDE * SIDE tables of 2 * ROWS rows. A pair of similarity s shares a table with
probability (1 - (1 - s ** ROWS) ** SIDE) ** 2: 0.9997 at 0.75 with the defaults, more above.

The tables are kept factored: documents are dealt by the left half of a key, and the right halves travel as a list, so that a
document costs SIDE rows and not SIDE * SIDE; two documents meet in a table if the left half is equal and the lists overlap.
Halves that no other document has are dropped first, and with them every document that keeps none on either side.

Links are found without listing the pairs of a group. Documents with equal sets are one class. Each member of a left group is
compared with the group's smallest document, its pivot; confirmed links are contracted to components; only pairs that meet in a table
and are still in different components are then compared, each once, and only if the join's condition leaves a link possible: by
their sizes, by a 96-bit sketch, and by a bound from the pivot. Two members share at most what both share with the pivot, plus what
both hold beyond it; 256 bits of what each holds beyond the pivot bound the latter. The bound is exact: it prunes no link.

Cases: null or wordless text: no shingles, linked with nothing, kept. Fewer words than a shingle: the whole sequence is the one
shingle. Without doc_id: no component (null), kept. Rows that repeat a doc_id share its component. Empty table: no rows. Only
``key`` and ``text`` are read. Shingles are identified by 64-bit hashes, sets by 128-bit sums over them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import Words, grams, materialize, measured_bytes, mix, tokens, tune
from ladle.llm.graph import components

SHINGLE = 5
SIDE, ROWS = 16, 3
PERCENT = 75
SKETCH_BITS = 96
#: With at most this probability the sketches of a pair of the wanted similarity rule it out.
SKETCH_LOSS = 1e-8
SLICE = 1 << 16
BITS = 256
_BEYOND = [f"r{k}" for k in range(BITS // 64)]
BROADCAST_BYTES = 8 << 20
PAIRS_PER_TASK = 1 << 16

_SIGNED = np.int64


def shingle_sets(w: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's set begins."""
    h, whole = grams(w, n)
    sets = []
    for d in range(len(w.ptr) - 1):
        lo, hi = w.ptr[d], w.ptr[d + 1]
        if hi - lo >= n:
            sets.append(np.unique(h[lo : hi - n + 1]))
        elif hi > lo:
            one = np.array([hi - lo], np.uint64)
            for x in w.hashes[lo:hi]:
                one = mix(one * np.uint64(0xD6E8FEB86659FD93) ^ x)
            sets.append(one)
        else:
            sets.append(np.zeros(0, np.uint64))
    ptr = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), ptr


def _signatures(flat: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collection keys (texts x 2 * SIDE) and sketches (texts x 2) of non-empty sets."""
    n = len(ptr) - 1
    keys = np.empty((n, 2 * SIDE), np.uint64)
    sketch = np.zeros((n, 2), np.uint64)
    seeds = mix(np.arange(1, 4 * SIDE * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for c in range(2 * SIDE):
        key = np.full(n, c + 1, np.uint64)
        for r in range(ROWS):
            k = c * ROWS + r
            least = np.minimum.reduceat((flat ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1)), ptr[:-1])
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) ^ least)
            sketch[:, k % 2] |= ((least >> np.uint64(13)) & np.uint64(1)) << np.uint64(k // 2)
        keys[:, c] = key
    return keys, sketch


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, size and digest of the set, collection keys, sketch."""
    for batch in batches:
        flat, ptr = shingle_sets(tokens(batch.column("text"), lower=True))
        size = np.diff(ptr)
        some = np.flatnonzero(size)
        keys = np.zeros((len(size), 2 * SIDE), np.uint64)
        four = np.zeros((4, len(size)), np.uint64)
        full = np.r_[ptr[some], ptr[-1]]
        at = 0
        while at < len(some):
            to = max(at + 1, int(np.searchsorted(full, full[at] + SLICE, "right")) - 1)
            part = flat[full[at] : full[to]]
            own = full[at : to + 1] - full[at]
            rows = some[at:to]
            k, s = _signatures(part, own)
            keys[rows], four[2, rows], four[3, rows] = k, s[:, 0], s[:, 1]
            four[0, rows] = np.add.reduceat(mix(part ^ np.uint64(0x5851F42D4C957F2D)), own[:-1])
            four[1, rows] = np.add.reduceat(mix(part + np.uint64(0x14057B7EF767814F)), own[:-1])
            at = to
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * (2 * SIDE)), pa.array(keys.view(_SIGNED).ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(size, pa.int64()), *[pa.array(x.view(_SIGNED)) for x in four], lists],
            ["doc_id", "n", "d1", "d2", "s1", "s2", "ks"],
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, ptr = shingle_sets(tokens(batch.column("text"), lower=True))
        sets = [flat[a:b].tobytes() for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "items"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the common part, and the bits of what a holds beyond b."""
    for batch in batches:
        n = batch.num_rows
        both, size = np.zeros(n, np.int64), np.zeros((2, n), np.int64)
        beyond = np.zeros((n, BITS), bool)
        for i, (x, y) in enumerate(zip(batch.column("items_a"), batch.column("items_b"), strict=True)):
            a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            same = b[at] == a
            both[i], size[0, i], size[1, i] = int(same.sum()), len(a), len(b)
            beyond[i, (a[~same] >> np.uint64(17)).astype(np.int64) % BITS] = True
        packed = np.packbits(beyond, axis=1, bitorder="little").view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(both), pa.array(size[0]), pa.array(size[1]), *[pa.array(packed[:, k]) for k in range(BITS // 64)]],
            ["a", "b", "both", "n", "m", *_BEYOND],
        )


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their full sets and of the common part, and the bits of what a holds beyond b. A document
    b that stands in very many pairs is dealt to several tasks."""
    many = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK).cast("int").alias("parts"))
    hot = many.where("parts > 1")
    dealt = pairs.join(F.broadcast(hot), "b", "left").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    )
    left = dealt.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")), "a")
    right = (
        sets.join(F.broadcast(hot.withColumnRenamed("b", "doc_id")), "doc_id", "left")
        .select(F.col("doc_id").alias("b"), F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"), F.col("items").alias("items_b"))
    )
    both = left.join(right, ["b", "part"]).select("a", "b", "items_a", "items_b")
    return both.mapInArrow(_compared, "a long, b long, both long, n long, m long, " + ", ".join(f"{c} long" for c in _BEYOND))


def _linked(percent: int):
    return F.col("both") * 100 >= (F.col("n") + F.col("m") - F.col("both")) * percent


def _agree(percent: int) -> int:
    """Agreeing sketch bits that a pair of similarity ``percent`` has but for SKETCH_LOSS; a bit of unlike minima agrees every other time."""
    p, below, k = (1 + percent / 100) / 2, 0.0, 0
    while k < SKETCH_BITS and (below := below + math.comb(SKETCH_BITS, k) * p**k * (1 - p) ** (SKETCH_BITS - k)) <= SKETCH_LOSS:
        k += 1
    return k


def _possible(percent: int):
    """Whether x and y, both compared with one pivot, may be linked: sizes, sketches, and the bound from the pivot."""
    near = (F.col("x.n") * 100 >= F.col("y.n") * percent) & (F.col("y.n") * 100 >= F.col("x.n") * percent)
    agree = SKETCH_BITS - F.bit_count(F.expr("x.s1 ^ y.s1")) - F.bit_count(F.expr("x.s2 ^ y.s2")) >= _agree(percent)
    shared = sum((F.bit_count(F.expr(f"x.{c} & y.{c}")) for c in _BEYOND), F.lit(0))
    extra = F.least(F.col("x.n") - F.col("x.both"), F.col("y.n") - F.col("y.both"), shared + F.least("x.double", "y.double"))
    most = F.least("x.both", "y.both") + extra
    return near & agree & (most * 100 >= (F.col("x.n") + F.col("y.n") - most) * percent)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest reachable doc_id), kept (doc_id = component_id), n_links (confirmed)."""
    spark = docs.sparkSession
    tune(spark)
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    every = materialize(base.mapInArrow(_describe, "doc_id long, n long, d1 long, d2 long, s1 long, s2 long, ks array<long>"), "signatures")
    real = every.where("doc_id IS NOT NULL AND n > 0")
    classes = materialize(real.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = real.join(classes.select(F.col("rep").alias("doc_id"), "d1", "d2"), ["doc_id", "d1", "d2"], "left_semi")

    cells = reps.select("doc_id", F.posexplode("ks").alias("slot", "k"))
    met = cells.groupBy("k").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("k")
    live = cells.join(met, "k", "left_semi").groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("slot") < SIDE, F.col("k"))).alias("ls"), F.collect_list(F.when(F.col("slot") >= SIDE, F.col("k"))).alias("rs")
    ).where("size(ls) > 0 AND size(rs) > 0")
    live = materialize(live, "live")
    halves = live.select("doc_id", F.explode("ls").alias("l"))
    groups = halves.groupBy("l").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("z")).where("b <> z").select("l", "b")
    members = materialize(halves.join(groups, "l"), "members")
    stars = members.where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()
    wanted = materialize(members.select("doc_id").distinct(), "wanted")
    small = F.broadcast(wanted) if measured_bytes(wanted) <= BROADCAST_BYTES else wanted
    sets = materialize(base.join(small, "doc_id", "left_semi").mapInArrow(_set_rows, "doc_id long, items binary").dropDuplicates(["doc_id", "items"]), "sets")
    compared = materialize(compare(stars, sets), "stars")
    links = compared.where(_linked(percent)).select("a", "b")

    part = materialize(components(links), "parts")
    seated = members.join(part.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")).drop("component")
    mixed = seated.groupBy("l").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("l")
    bits = sum((F.bit_count(c) for c in _BEYOND), F.lit(0))
    seen = compared.select(F.col("a").alias("doc_id"), "b", "n", "both", *_BEYOND, (F.col("n") - F.col("both") - bits).alias("double"))
    rest = (
        seated.join(mixed, "l").join(seen, ["doc_id", "b"])  # pivots have been compared with every member
        .join(reps.select("doc_id", "s1", "s2"), "doc_id").join(live, "doc_id").drop("b")
    )
    rest = materialize(rest, "rest")
    meet = F.arrays_overlap("x.rs", "y.rs") & (F.element_at(F.array_intersect("x.ls", "y.ls"), 1) == F.col("x.l"))  # one left group tells a pair
    late = rest.alias("x").join(rest.alias("y"), (F.col("x.l") == F.col("y.l")) & (F.col("x.part") > F.col("y.part")) & _possible(percent) & meet)
    late = late.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
    links = links.union(materialize(compare(late, sets).where(_linked(percent)).select("a", "b"), "links"))
    final = materialize(components(links), "parts")

    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("degree"))
    named = (
        classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
        .select("d1", "d2", F.coalesce("component", "rep").alias("component_id"), (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
        .where("n_links > 0")
    )
    named = materialize(named, "named")
    if measured_bytes(named) <= BROADCAST_BYTES:
        named = F.broadcast(named)
    out = every.where("n > 0").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    done = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    none = every.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return done.union(none).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "n_links"
    )
