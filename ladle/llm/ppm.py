"""Language identification by prediction by partial matching.

For every language a context tree over bytes is counted on a bounded sample of labelled documents. A text's code length under a
language is the sum over its bytes of -log2 of the probability that PPM gives: start at the longest context the tree holds, pay
an escape wherever the byte is new there, exclude the bytes already ruled out, and go on with the next shorter context down to
a uniform choice (escape method C, full exclusion). With frozen counts all of this depends only on the longest known context and
the next byte, so the lengths are worked out once for each pair and a text is scored by table look-ups. A text
belongs to the language with the shortest code; its score is that language's share when every language is as likely beforehand.

Bounds: SAMPLE_DOCS documents a language of at most SAMPLE_BYTES bytes each (whole texts, chosen by a hash of doc_id) are
learned from, so the model's size does not follow the corpus. A language whose texts are all longer is learned from the first
SAMPLE_BYTES bytes of its shortest ones. Everything is scored, whole.

Cases: a null text or one without any letter is ``und`` with score 0. Labels that are null are not learned from. Without any
labelled row every text is ``und``. Ties go to the language that is first by name. Repeated rows are scored alike; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import crc32_of_id, materialize, tune

ORDER = 3
SAMPLE_DOCS = 300
SAMPLE_BYTES = 1 << 16
#: Above the length of any hash: texts above SAMPLE_BYTES come after all others, by size.
LONG = 64
MAX_LANGUAGES = 1024
SLICE = 1 << 18
UNKNOWN = "und"


def count_contexts(texts: list[bytes], order: int = ORDER) -> list[dict[int, np.ndarray]]:
    """For each context length k: distinct (context + next byte) keys and their counts, as sorted arrays."""
    out = []
    for k in range(order + 1):
        keys = []
        for t in texts:
            b = np.frombuffer(t, np.uint8).astype(np.uint64)
            if len(b) > k:
                key = np.zeros(len(b) - k, np.uint64)
                for j in range(k + 1):
                    key = (key << np.uint64(8)) | b[j : len(b) - k + j]
                keys.append(key)
        got, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_counts=True)
        out.append({"key": got.astype(np.int64), "n": n})
    return out


def _lengths(counts: list[dict], alphabet: np.ndarray, nodes: list[np.ndarray]) -> np.ndarray:
    """Code length of every symbol at every node of the shared tree. ``alphabet``: byte values seen by any language; the
    last symbol stands for any other byte."""
    size = len(alphabet) + 1
    place = np.full(256, size - 1)
    place[alphabet] = np.arange(size - 1)
    n = []
    base = 0
    for k, ctx in enumerate(nodes):
        table = np.zeros((len(ctx), size), np.int64)
        at = counts[k]["key"] >> 8
        row = np.searchsorted(ctx, at)
        table[row, place[counts[k]["key"] & 255]] = counts[k]["n"]
        n.append(table)
        base += len(ctx)
    out = np.empty((base, size))
    base = 0
    for k, ctx in enumerate(nodes):
        table = n[k]
        known = table > 0
        total, kinds = table.sum(1, keepdims=True), known.sum(1, keepdims=True)
        own = np.log2(np.maximum(total + kinds, 1)) - np.log2(np.maximum(table, 1))
        leave = np.where(kinds > 0, np.log2(np.maximum(total + kinds, 1)) - np.log2(np.maximum(kinds, 1)), 0.0)
        if k == 0:  # a byte never seen: any of those left
            out[:1] = np.where(known, own, leave + np.log2(np.maximum(1, 256 - kinds)))
            prev, base = table, 1
            continue
        up = np.searchsorted(nodes[k - 1], ctx & ((1 << (8 * (k - 1))) - 1))
        shorter, below = prev[up], out[base - len(nodes[k - 1]) : base][up]
        # Below an escape the bytes of this context are excluded from the shorter one.
        left = np.where(known, 0, shorter)
        n_left, k_left = left.sum(1, keepdims=True), (left > 0).sum(1, keepdims=True)
        n_all, k_all = shorter.sum(1, keepdims=True), (shorter > 0).sum(1, keepdims=True)
        direct = np.log2(np.maximum(n_left + k_left, 1)) - np.log2(np.maximum(left, 1))
        rest_above = np.log2(np.maximum(n_all + k_all, 1)) - np.log2(np.maximum(k_all, 1))
        rest_here = np.where(k_left > 0, np.log2(np.maximum(n_left + k_left, 1)) - np.log2(np.maximum(k_left, 1)), 0.0)
        further = np.where(k_all > 0, below - rest_above + rest_here, below)
        escaped = np.where(left > 0, direct, further)
        out[base : base + len(ctx)] = np.where(known, own, np.where(total > 0, leave + escaped, below))
        prev = table
        base += len(ctx)
    return out


def build(samples: dict[str, list[bytes]], order: int = ORDER) -> dict:
    """Shared context tree and, per language, the code length of each symbol after each context."""
    names = sorted(samples)
    counted = {name: count_contexts(samples[name], order) for name in names}
    alphabet = np.unique(np.concatenate([c[0]["key"] for c in counted.values()]))
    nodes = [np.unique(np.concatenate([c[k]["key"] >> 8 for c in counted.values()])) for k in range(order + 1)]
    nodes[0] = np.zeros(1, np.int64)
    for k in range(1, order + 1):  # a context is only walked to if its shorter ones exist
        nodes[k] = nodes[k][np.isin(nodes[k] & ((1 << (8 * (k - 1))) - 1), nodes[k - 1])]
        for c in counted.values():
            keep = np.isin(c[k]["key"] >> 8, nodes[k])
            c[k] = {"key": c[k]["key"][keep], "n": c[k]["n"][keep]}
    size = len(alphabet) + 1
    place = np.full(256, size - 1, np.int64)
    place[alphabet] = np.arange(size - 1)
    starts = np.r_[0, np.cumsum([len(x) for x in nodes])]
    total = int(starts[-1])
    # Going one byte further back: rows below ``total`` may still grow, rows from ``total`` on have stopped.
    step = np.repeat(np.arange(total, 2 * total)[:, None], size, 1)
    for k in range(1, order + 1):
        up = starts[k - 1] + np.searchsorted(nodes[k - 1], nodes[k] & ((1 << (8 * (k - 1))) - 1))
        step[up, place[(nodes[k] >> (8 * (k - 1))) & 255]] = np.arange(starts[k], starts[k + 1])
    step = np.concatenate([step, np.repeat(np.arange(total, 2 * total)[:, None], size, 1)]).astype(np.int32)
    cost = np.stack([_lengths(counted[name], alphabet, nodes) for name in names], 2).astype(np.float32)
    return {"names": names, "place": place.astype(np.uint8) if size < 256 else place, "size": size, "step": step.ravel(), "cost": cost.reshape(total * size, len(names)), "total": total, "order": order}


def code_lengths(model: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits of each text (``off``: byte offsets, one more than texts) under each language."""
    n, langs = len(off) - 1, len(model["names"])
    bits = np.zeros((n, langs))
    size, total = model["size"], model["total"]
    for lo in range(0, len(data), SLICE):
        hi = min(len(data), lo + SLICE)
        back = max(0, lo - model["order"])
        sym = model["place"][data[back:hi]].astype(np.int32)
        a, b = int(np.searchsorted(off, lo, "right")) - 1, int(np.searchsorted(off, hi, "left"))
        edge = np.maximum(off[a:b], lo)
        begin = np.repeat(off[a:b], np.diff(np.r_[edge, hi]))
        room = np.arange(lo, hi) - begin
        node = np.zeros(hi - lo, np.int32)
        skew = lo - back
        for k in range(1, model["order"] + 1):
            prev = np.zeros(hi - lo, np.int32)
            src = np.arange(lo - k, hi - k) - back
            ok = src >= 0
            prev[ok] = sym[src[ok]]
            nxt = model["step"][node * size + prev]
            node = np.where(room >= k, nxt, np.where(node < total, node + total, node))
        node %= total
        cost = model["cost"][node * size + sym[skew:]]
        some = np.diff(np.r_[edge, hi]) > 0
        if some.any():
            bits[np.arange(a, b)[some]] += np.add.reduceat(cost, (edge - lo)[some], axis=0, dtype=np.float64)
    return bits


def fit(docs: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text", order: int = ORDER) -> dict | None:
    """Model learned from the labelled rows of ``docs``: a bounded, repeatable sample of texts, whole unless a language has only
    texts above SAMPLE_BYTES."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).cast("string").alias("l")).where("l IS NOT NULL AND t IS NOT NULL")
    size = F.octet_length("t").cast("long")
    rows = rows.withColumn("h", F.when(size <= SAMPLE_BYTES, F.xxhash64("k", "t").bitwiseAND(F.lit((1 << 63) - 1))).otherwise(size))
    rows = rows.withColumn("z", F.length(F.bin("h")) + F.when(size <= SAMPLE_BYTES, 0).otherwise(LONG))
    # Short hashes are geometrically rarer, so the rows up to the cut-off length are SAMPLE_DOCS to about twice as many.
    at = Window.partitionBy("l").orderBy("z")
    cuts = rows.groupBy("l", "z").count().withColumn("before", F.sum("count").over(at) - F.col("count")).withColumn("first", F.min("z").over(Window.partitionBy("l")))
    cuts = cuts.where((F.col("before") < SAMPLE_DOCS) & ((F.col("z") < LONG) | (F.col("first") >= LONG)))
    cuts = cuts.groupBy("l").agg(F.max("z").alias("cut")).limit(MAX_LANGUAGES + 1)
    near = rows.join(F.broadcast(cuts), "l").where(F.col("z") <= F.col("cut"))
    picked = near.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h", "k", "t"))).where(F.col("r") <= SAMPLE_DOCS)
    picked = materialize(picked.select("l", F.substring("t", 1, SAMPLE_BYTES).alias("t")), "sample")
    names = [r[0] for r in picked.select("l").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not names:
        return None
    samples: dict[str, list[bytes]] = {name: [] for name in names}
    for r in picked.toLocalIterator():
        samples[r[0]].append(r[1].encode("utf-8", "replace")[:SAMPLE_BYTES])
    return build(samples, order)


def identify(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` of every row with lang_pred and score (columns of these names are replaced)."""
    spark = docs.sparkSession
    tune(spark)
    docs = docs.drop(*{"lang_pred", "score", "__letter"} - {key, text, *keep})
    keep = tuple(keep) or (key,)
    extra = [] if text in keep else [text]
    base = docs.select(*keep, *extra, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    if model is None:
        return base.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            t = batch.column(text).cast(pa.large_string()).fill_null("")
            off = np.frombuffer(t.buffers()[1], np.int64, len(t) + 1 + t.offset)[t.offset :]
            raw = np.frombuffer(t.buffers()[2], np.uint8) if t.buffers()[2] else np.zeros(0, np.uint8)
            bits = code_lengths(m, raw[off[0] : off[-1]], off - off[0])
            best = bits.argmin(1)
            share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
            letter = batch.column("__letter").to_numpy(zero_copy_only=False).astype(bool)
            pred = [m["names"][b] if ok else UNKNOWN for b, ok in zip(best, letter, strict=True)]
            own = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*own, pa.array(pred, pa.string()), pa.array(np.where(letter, share, 0.0))], [*keep, "lang_pred", "score"])

    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return base.mapInArrow(score, schema)


def held_out(key: str = "doc_id", parts: int = 5):
    """Rows that are never learned from."""
    return F.coalesce(crc32_of_id(key) % parts == 0, F.lit(False))


def detect(docs: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    model = fit(docs.where(~held_out(key)), label, key, text)
    return identify(docs, model, key, text).select(key, held_out(key).alias("held_out"), "lang_pred", "score")
