"""Prefix trie of rebuilt conversations, by whole-sequence collapse.

Every conversation c is rebuilt: the first h turns of conversation c - c % 5 and then its own turns after its first h, h = crc32(c) % 9. A
node of the trie is a distinct sequence of first turns (role, text); members are the conversations that start with it.

1. Turns are numbered by range partitions, so a conversation that holds a third of all turns lies in a third of the tasks. Texts stay
   where they are read: from there on a turn is a digest and a length.
2. A prefix is told by the sum, over its turns, of a 128-bit hash of (depth, turn). Such sums run along a conversation in stretches of
   ``STRETCH`` turns, each by itself, with the totals of earlier stretches added; no task needs a whole conversation.
3. Equal whole conversations collapse into one weighted sequence; their ids are its end list. Only the smallest
   conversation of each sequence goes on. Sequences that are a proper prefix of another are dropped by anti-join; the rest are the leaves.
4. Weighted prefixes are aggregated into nodes, with partial sums before the shuffle.
5. Sums over subtrees need no ancestor lists: a node belongs to the smallest leaf below it, so a leaf owns the lower end of its own
   path. A node's sum is what its own leaf owns from there down, plus all that other leaves below it own.

End lists are hashed as a stream: pieces of sorted ids are joined where they are sorted, then read in order by one task a sequence, which
holds a piece at a time.

Cases: null role or text is empty; turns of one conversation with equal turn number go by the digest of (role, text), null turns
first; repeated rows are turns of their own. Rows without conv_id belong to no conversation and are left out. c % 5 has the sign of c. A
conversation without any turn left is a member of the root alone, and ends there. An empty table has no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import materialize, tune, width
from ladle.operators.ordering import row_positions
from ladle.operators.skew import attach, spread_join

#: Donor conversations are the multiples of GROUP; fewer than LEAD turns are taken over.
GROUP, LEAD = 5, 9
STRETCH = 4096
PART_BYTES = 16 << 20
HOT_ROWS = 2000
_LOW = (1 << 32) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def turns_of(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, digest, bytes): the turns of each conversation, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"), F.octet_length(text).alias("bytes"),
    )
    placed = row_positions(known, ["dated", "turn", "digest"], groups=["conv_id"], name="pos", buckets=width(rows, PART_BYTES))
    return materialize(placed.select("conv_id", "pos", "digest", "bytes"), "turns")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, total) of every conversation and (conv_id, depth, total, digest, bytes) of its rebuilt turns."""
    n = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % LEAD
    own = n.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("donor"))
    given = n.select(F.col("conv_id").alias("donor"), F.col("n").alias("donor_n"))
    taken = F.least("h", F.coalesce("donor_n", F.lit(0)))
    convs = own.join(given, "donor", "left").select("conv_id", "donor", "n", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    convs = materialize(convs, "conversations")
    later = turns.where(F.col("pos") > h)
    kept = attach(later, convs.select("conv_id", "n", "h", "taken", "total"), ["conv_id"], "inner", weight="n", stored=True)
    kept = kept.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "total", "digest", "bytes")
    first = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < LEAD)).withColumnRenamed("conv_id", "donor")
    lent = first.join(convs.where("taken > 0").select("conv_id", "donor", "taken", "total"), "donor").where("pos <= taken")
    lent = lent.select("conv_id", F.col("pos").alias("depth"), "total", "digest", "bytes")
    return convs.select("conv_id", "total"), lent.union(kept)


def running(rows: DataFrame, group: str, place: str, sums: Sequence[str], back: bool = False) -> DataFrame:
    """``rows`` with each of ``sums`` summed over its group up to the row (with ``back``: from the row on), by ``place`` 1, 2, ..."""
    cut = rows.withColumn("__cell", F.floor((F.col(place) - 1) / STRETCH))
    order = F.col(place).desc() if back else F.col(place)
    inside = Window.partitionBy(group, "__cell").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select(*[c for c in cut.columns if c not in sums], *[F.sum(s).over(inside).alias(s) for s in sums])
    # Totals only where a group has more than one stretch: the others have nothing to add.
    cells = cut.groupBy(group, "__cell").agg(*[F.sum(s).alias(f"__t{i}") for i, s in enumerate(sums)])
    line = Window.partitionBy(group).orderBy(F.desc("__cell") if back else "__cell").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select(group, "__cell", *[F.sum(f"__t{i}").over(line).alias(f"__b{i}") for i in range(len(sums))]).where("__b0 IS NOT NULL")
    both = local.join(before, [group, "__cell"], "left")
    return both.select(*[c for c in local.columns if c not in (*sums, "__cell")], *[(F.col(s) + F.coalesce(f"__b{i}", F.lit(0))).alias(s) for i, s in enumerate(sums)])


def _packed(high: Column, low: Column) -> Column:
    mask = F.lit(_LOW).cast("long")
    return F.shiftleft(high.bitwiseAND(mask), 32).bitwiseOR(low.bitwiseAND(mask))


def paths(rebuilt: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, total, bytes, a, b, pa, pb): (a, b) tells the prefix that ends here, (pa, pb) the one before."""
    hashes = [F.xxhash64(F.lit(seed), "depth", "digest") for seed in (11, 29)]
    mask = F.lit(_LOW).cast("long")
    halves = [x for y in hashes for x in (F.shiftrightunsigned(y, 32), y.bitwiseAND(mask))]
    parts = rebuilt.select("conv_id", "depth", "total", "bytes", *[x.alias(f"s{i}") for i, x in enumerate(halves)], *[x.alias(f"o{i}") for i, x in enumerate(halves)])
    summed = running(parts, "conv_id", "depth", ["s0", "s1", "s2", "s3"])
    s = [F.col(f"s{i}") for i in range(4)]
    p = [F.col(f"s{i}") - F.col(f"o{i}") for i in range(4)]
    return summed.select(
        "conv_id", "depth", "total", "bytes", _packed(s[0], s[1]).alias("a"), _packed(s[2], s[3]).alias("b"), _packed(p[0], p[1]).alias("pa"), _packed(p[2], p[3]).alias("pb")
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (a, b, conv_id): for each stretch of a sequence in a batch its first id and all ids, joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, ids = (batch.column(c).to_numpy() for c in ("a", "b", "conv_id"))
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        cut = [0, *(new.nonzero()[0] + 1).tolist(), len(a)]
        text = [",".join(map(str, ids[x:y].tolist())) for x, y in zip(cut, cut[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(a[cut[:-1]]), pa.array(b[cut[:-1]]), pa.array(ids[cut[:-1]]), pa.array(text)], ["a", "b", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order: the hash of each sequence's list. Holds one piece at a time."""
    key, state = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
            if (a, b) == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256()
            state.update(ids.encode())
        yield _rows(out)
    if key is not None:
        yield _rows([(*key, state.hexdigest())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, sha = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sha, pa.string())], ["a", "b", "ends_sha256"])


def end_pieces(ends: DataFrame, parts: int) -> DataFrame:
    """The end lists of the sequences as rows (a, b, first, ids): ids of a stretch, ascending and joined by commas."""
    dealt = ends.select("a", "b", "conv_id").repartitionByRange(parts, "a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    return dealt.mapInArrow(_joined, "a long, b long, first long, ids string")


def end_hashes(pieces: DataFrame) -> DataFrame:
    """Rows (a, b, ends_sha256) of the joined lists."""
    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hashed, "a long, b long, ends_sha256 string")


def trie(rows: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    tune(rows.sparkSession)
    convs, rebuilt = rebuild(turns_of(rows))
    walked = materialize(paths(rebuilt), "paths")

    last = walked.where("depth = total").select("conv_id", "total", "a", "b")
    none = convs.where("total = 0").select("conv_id", "total", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    ends = last.union(none)
    whole = ends.groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.max("total").alias("total"))
    whole = materialize(whole, "sequences")
    proper = walked.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
    leaves = whole.join(proper, ["a", "b"], "left_anti").select("a", "b", F.lit(1).alias("leaf"))
    weighted = materialize(whole.join(leaves, ["a", "b"], "left").select("conv_id", "weight", F.coalesce("leaf", F.lit(0)).alias("leaf"), (F.col("total") + 1).alias("rows")), "weighted")

    steps = attach(walked, weighted, ["conv_id"], "inner", weight="rows", stored=True)
    zero = F.lit(0).cast("long")
    top = weighted.select("conv_id", zero.alias("depth"), zero.alias("bytes"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"), "weight", "leaf")
    prefixes = steps.select(*top.columns).union(top)
    nodes = prefixes.groupBy("a", "b").agg(
        F.min("depth").alias("depth"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.max("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.min(F.when(F.col("leaf") == 1, F.col("conv_id"))).alias("owner"),
    )
    nodes = materialize(nodes, "nodes")

    # Gains of the nodes that several conversations share, along the path of the leaf that owns them.
    gains = nodes.where("n_convs > 1 AND depth > 0").select("a", "b", "owner", "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("gain"))
    down = materialize(running(gains, "owner", "depth", ["gain"], back=True), "gains")
    owned = down.groupBy("owner").agg(F.min("depth").alias("top"), F.max_by("gain", -F.col("depth")).alias("gain"))
    paid = prefixes.where("leaf = 1").select("conv_id", "depth", "a", "b")
    paid = paid.join(owned.withColumnRenamed("owner", "conv_id"), "conv_id").where("depth < top")

    children = nodes.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    hashes = end_hashes(end_pieces(ends, width(rows, PART_BYTES)))
    facts = {"conv_id": "long", "depth": "long", "pa": "long", "pb": "long", "n_convs": "long", "n_leaves": "long", "n_children": "long", "saved": "long", "ends_sha256": "string"}

    def told(df: DataFrame) -> DataFrame:
        return df.select("a", "b", *[(F.col(k) if k in df.columns else F.lit(None)).cast(t).alias(k) for k, t in facts.items()])

    upper = paid.groupBy("a", "b").agg(F.sum("gain").alias("saved"))
    union = told(nodes).union(told(children)).union(told(down.withColumnRenamed("gain", "saved").select("a", "b", "saved"))).union(told(upper)).union(told(hashes))
    whole_nodes = union.groupBy("a", "b").agg(*[(F.sum if k == "saved" else F.max)(k).alias(k) for k in facts])
    whole_nodes = materialize(whole_nodes, "trie")
    parents = whole_nodes.where("n_children > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_siblings"))
    below = spread_join(whole_nodes.where("pa IS NOT NULL"), parents, ["pa", "pb"], weight="n_siblings", hot_rows=HOT_ROWS)
    top = whole_nodes.where("pa IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = below.select(*top.columns).union(top)
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
