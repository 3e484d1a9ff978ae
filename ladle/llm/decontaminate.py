"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are lower-cased (A-Z) and ASCII punctuation separates like white space, so that case and punctuation do not hide a copy.
1. The words of the benchmark items are counted over all texts.
2. Seeds are the rare windows of an item. A window counts as common only if its words are common: if, given the corpus
   frequencies of its words, chance alone would put it into more than CHANCE texts a million. The window's own frequency decides
   nothing, so an item that was copied a million times keeps its seeds. The half of an item's windows with the lowest
   expected frequency are seeds in any case, so that no item hangs on one or two. Items shorter than a window are one window.
3. Texts that hold a seed of an item are aligned with the whole item: local alignment over words, MATCH for equal words and
   PENALTY for a changed, added or missing word. The score is divided by that of a perfect copy of the item. At least LEAST
   means a copy, exact, edited or partial, and so does a score worth LEAST_WORDS equal words, however long the item.

Items are taken in blocks of at most BLOCK_ITEMS items and BLOCK_BYTES bytes, so what a task holds of the benchmark is bounded; each
block is one pass over the texts to count and one to align, and any number of blocks works. The aligning passes are chained, so rows need no number.

Cases: null or wordless texts and items match nothing. Repeated items and texts are each judged alike. Items without id count, each as one
item; if such an item is the best, best_item is null. Ties of the best item go to the smallest item_id. Keys are whole numbers. An empty benchmark leaves every text clean. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import Words, grams, tokens, tune

N = 3
MATCH, PENALTY = 2, -1
LEAST = 0.5
#: As many words as LEAST asks for of an item of 60.
LEAST_WORDS = 30
CHANCE = 50.0
BLOCK_ITEMS = 1 << 14
BLOCK_BYTES = 16 << 20


def windows(w: Words, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and texts of all windows; a text shorter than a window is one window of its own."""
    h, whole = grams(w, n)
    owner = w.owner
    out_h, out_o = [h[whole]], [owner[whole]]
    for k in range(1, n):
        short = np.flatnonzero(w.counts == k)
        if len(short):
            hk, _ = grams(w, k)
            out_h.append(hk[w.ptr[short]] ^ np.uint64(k))
            out_o.append(short)
    return np.concatenate(out_h), np.concatenate(out_o)


def _short(w: Words, k: int) -> np.ndarray:
    """Windows of k words, as short items are looked for."""
    h, whole = grams(w, k)
    return np.where(whole, h ^ np.uint64(k), np.uint64(0))


class Items:
    """A block of benchmark items: words, windows and, for each window, the items that hold it."""

    def __init__(self, ids: list[int | None], texts: list[str]):
        w = tokens(pa.array(texts, pa.string()), punctuation=True, lower=True)
        self.ids = ids
        self.words = [w.hashes[a:b] for a, b in zip(w.ptr[:-1], w.ptr[1:], strict=True)]
        self.vocabulary = np.unique(w.hashes)
        h, owner = windows(w)
        order = np.lexsort((owner, h))
        self.window, self.owner = h[order], owner[order]
        self.distinct = np.unique(h)
        self.sizes = sorted({min(len(x), N) for x in self.words} - {0})

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Window hashes of the block that occur, with the text they occur in."""
        found_h, found_o = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        owner = w.owner
        for k in self.sizes:
            if not len(w.hashes):
                continue
            if k == N:
                h, whole = grams(w, N)
            else:
                h = _short(w, k)
                whole = np.ones(len(h), bool)
            at = np.searchsorted(self.distinct, h)
            at[at == len(self.distinct)] = 0
            ok = np.flatnonzero((self.distinct[at] == h) & whole)
            found_h.append(h[ok])
            found_o.append(owner[ok])
        return np.concatenate(found_h), np.concatenate(found_o)


def align(item: np.ndarray, text: np.ndarray) -> int:
    """Best local alignment score of two word sequences (linear gaps), one vector step a word of the shorter one."""
    if len(item) > len(text):
        item, text = text, item
    n = len(text)
    if not len(item):
        return 0
    ramp = np.arange(n + 1, dtype=np.int32) * -PENALTY
    row = np.zeros(n + 1, np.int32)
    best = 0
    for x in item:
        new = np.zeros(n + 1, np.int32)
        np.maximum(row[:-1] + np.where(text == x, MATCH, PENALTY), 0, out=new[1:])
        np.maximum(new, row + PENALTY, out=new)
        # A gap along the text costs the same a word: the running maximum of score + distance.
        new = np.maximum.accumulate(new + ramp) - ramp
        top = int(new.max())
        best = max(best, top)
        row = new
    return best


def _blocks(benchmark: DataFrame, item_key: str, item_text: str) -> Iterator[Items]:
    rows = benchmark.select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("t")).where("t IS NOT NULL").orderBy("i", "t")
    ids, texts, size = [], [], 0
    for r in rows.toLocalIterator():
        ids.append(r[0])
        texts.append(r[1])
        size += len(r[1])
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


def _word_counts(shared):
    """(kind, h, n): occurrences of the block's words, and of all words (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value.vocabulary
        counts, total, texts = np.zeros(len(v), np.int64), 0, 0
        for batch in batches:
            w = tokens(batch.column("text"), punctuation=True, lower=True)
            at = np.searchsorted(v, w.hashes)
            at[at == len(v)] = 0
            if len(v):
                counts += np.bincount(at[v[at] == w.hashes], minlength=len(v))
            total += len(w.hashes)
            texts += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[np.arange(len(v)), -1, -2].astype(np.int64)), pa.array(np.r_[counts, total, texts].astype(np.int64))], ["k", "n"]
        )

    return run


def rare_windows(items: Items, frequency: np.ndarray, words_per_text: float) -> np.ndarray:
    """Seeds: for each item its windows that chance would put into few texts, and the rarer half in any case."""
    seeds = []
    for i, x in enumerate(items.words):
        if len(x) == 0:
            continue
        k = min(len(x), N)
        p = np.log(np.maximum(frequency[np.searchsorted(items.vocabulary, x)], 1e-12))
        expected = np.convolve(p, np.ones(k), "valid") + np.log(max(words_per_text, 1.0)) + np.log(1e6)
        rare = expected <= max(np.log(CHANCE), np.median(expected))
        h, whole = grams(Words(np.array([0, len(x)]), x, x, x, x), k)
        h = (h if k == N else h ^ np.uint64(k))[whole][rare]
        seeds.append(np.stack([h, np.full(len(h), i, np.uint64)]))
    return np.concatenate(seeds, 1) if seeds else np.zeros((2, 0), np.uint64)


def _copied(shared):
    """For the texts of a batch the items that each copies: (-share of the item, whether it has no id, its id, its number)."""

    def run(texts: pa.Array) -> list[list[tuple]]:
        items, (seed_h, seed_i) = shared.value
        order = np.argsort(seed_h, kind="stable")
        seed_h, seed_i = seed_h[order], seed_i[order].astype(np.int64)
        w = tokens(texts, punctuation=True, lower=True)
        h, owner = items.hits(w)
        lo, hi = np.searchsorted(seed_h, h, "left"), np.searchsorted(seed_h, h, "right")
        many = hi - lo
        flat = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pairs = np.unique(np.stack([np.repeat(owner, many), seed_i[flat]], 1), axis=0) if len(flat) else np.zeros((0, 2), np.int64)
        found: list[list[tuple]] = [[] for _ in range(len(texts))]
        for d, i in pairs.tolist():
            item = items.words[i]
            score = align(item, w.hashes[w.ptr[d] : w.ptr[d + 1]]) / MATCH
            if score >= min(LEAST * len(item), LEAST_WORDS):
                key = items.ids[i]
                found[d].append((-score / len(item), key is None, key or 0, i))
        return found

    return run


def _judge(shared):
    """Adds the items of a block to n_items, best_item and best_score."""
    copied = _copied(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = copied(batch.column("text"))
            n, item, score = (batch.column(c).to_pylist() for c in ("n_items", "best_item", "best_score"))
            for d, f in enumerate(found):
                if not f:
                    continue
                n[d] += len({(x[2],) if not x[1] else (0, x[3]) for x in f})
                best = min(f)
                # Nulls last among equal shares, as in the block itself.
                if score[d] is None or (best[0], best[1], best[2]) < (-score[d], item[d] is None, item[d] or 0):
                    item[d], score[d] = None if best[1] else best[2], -best[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(n, pa.int64()), pa.array(item, pa.int64()), pa.array(score, pa.float64())],
                ["doc_id", "text", "n_items", "best_item", "best_score"],
            )

    return run


def _seeded(base: DataFrame, benchmark: DataFrame, item_key: str, item_text: str) -> Iterator:
    """For each block of items: a broadcast (items, seeds)."""
    context = base.sparkSession.sparkContext
    for items in _blocks(benchmark, item_key, item_text):
        if not len(items.vocabulary):
            continue
        counts = base.select("text").mapInArrow(_word_counts(context.broadcast(items)), "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
        frequency, total, texts = np.zeros(len(items.vocabulary)), 1, 1
        for r in counts.collect():  # one row a word of the block
            if r["k"] >= 0:
                frequency[r["k"]] = r["n"]
            elif r["k"] == -1:
                total = max(1, r["n"])
            else:
                texts = max(1, r["n"])
        yield context.broadcast((items, rare_windows(items, frequency / total, total / texts)))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text copies no item. Nothing is joined or shuffled."""
    tune(docs.sparkSession)
    base = docs.select(F.col(text).alias("text"))
    out = docs
    for shared in _seeded(base, benchmark, item_key, item_text):
        copied = _copied(shared)

        def keep(batches: Iterator[pa.RecordBatch], copied=copied) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not f for f in copied(batch.column(text))], pa.bool_()))

        out = out.mapInArrow(keep, docs.schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row: doc_id, contaminated, n_items (items that are copied), best_item, best_score (null where clean)."""
    tune(docs.sparkSession)
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = base.select("*", F.lit(0).cast("long").alias("n_items"), F.lit(None).cast("long").alias("best_item"), F.lit(None).cast("double").alias("best_score"))
    # Block after block in one pass over the texts: a row carries what the blocks before have found.
    for shared in _seeded(base, benchmark, item_key, item_text):
        out = out.mapInArrow(_judge(shared), out.schema)
    return out.select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", "best_item", "best_score")
