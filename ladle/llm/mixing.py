"""Language-model scores by online logistic mixing of bit predictors over word classes.

Text is read as words (A-Z lower-cased) and one end token a document. A word's probability has two factors. Its class, CLASS_BITS
high bits of its hash, is coded bit by bit: each bit is predicted from counts in contexts (the class bits so far alone, with
the previous word's class, and with the two previous words' classes); the predictions are combined in the logistic domain by a
weight set chosen by the bit's place (the gate) and then corrected by an adaptive probability map. Within its class the word is
coded by its training count. Both factors are proper distributions, so the score is a log probability and the code length total.

Learning reads every training document. Bit counts are added up over the documents whose remainder is 1 to 8; the weights are trained over
those with remainder 9, so that no context has seen the text it is weighed on: from even weights, ROUNDS Newton steps on sums over all
their bits, and then one pass for the probability map. Sums do not depend on how rows are dealt, so a score is a function of the table. While a document
is scored its own weights go on learning after each block of BLOCK tokens. Word counts cover all training documents, stay
distributed, and meet the distinct words of each batch in a shuffle.

No two contexts share a count. The bits after no word and after one have a slot each in a table that holds all there can be
(1025 x 1023), which is broadcast. What follows two words is kept as the count of every class triple that occurs, in rows dealt by
the two words, as many as the input has; each batch sends its distinct triples there and gets the counts
along their bits back.

Cases: a null or empty text is one end token. A null doc_id counts as held out (crc32 of nothing) and is scored. Repeated rows
count and are scored each on their own. An empty table gives no rows; without training rows all predictions are even.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import Words, crc32_of_id, materialize, mix, tokens, tune, width

CLASS_BITS = 10
CLASSES = 1 << CLASS_BITS
CONTEXTS = 3
#: Every pair of a previous class and a place in the next.
SLOTS = (CLASSES + 1) * (CLASSES - 1)
BLOCK = 256
RATE = 0.02
ROUNDS = 3
GROUP_BYTES = 8 << 20
MAP_STEPS = 33
PRIOR = 0.4
RIDGE = 1.0
END = np.uint64(0x8C7F0AAC97C4AA2F)
ALPHA = 0.1
TOKENS_AT_ONCE = 1 << 17


def _with_end(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with the end token after each text, and where each text begins."""
    n = len(w.ptr) - 1
    ptr = w.ptr + np.arange(n + 1)
    out = np.full(ptr[-1] if n else 0, END, np.uint64)
    at = np.ones(len(out), bool)
    at[ptr[1:] - 1] = False
    out[at] = w.hashes
    return out, ptr


def _classes(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CLASS_BITS)).astype(np.int32)


def _before(cls: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the word before and of the one before that; CLASSES where the text has none."""
    n = len(cls)
    prev1 = np.full(n, CLASSES, np.int64)
    prev1[1:] = cls[:-1]
    prev2 = np.full(n, CLASSES, np.int64)
    prev2[2:] = cls[:-2]
    begin = ptr[:-1]
    prev1[begin[begin < n]] = CLASSES
    prev2[begin[begin < n]] = CLASSES
    second = begin + 1
    prev2[second[second < ptr[1:]]] = CLASSES
    return prev1, prev2


def _triples(cls: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """One number (below 1025^2 * 1024) for each token and the two before it; the two alone are the number >> CLASS_BITS."""
    prev1, prev2 = _before(cls, ptr)
    return ((prev1 * (CLASSES + 1) + prev2) << CLASS_BITS) | cls


def _slots(cls: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of every bit after no word and after one (2 x tokens x bits), and the bits (tokens x bits)."""
    prev1, _ = _before(cls, ptr)
    shift = np.arange(CLASS_BITS, dtype=np.int64)
    node = (cls[:, None].astype(np.int64) | CLASSES) >> (CLASS_BITS - shift)[None, :]
    bits = ((cls[:, None] >> (CLASS_BITS - 1 - shift)[None, :]) & 1).astype(np.float32)
    return np.stack([node, prev1[:, None] * (CLASSES - 1) + node - 1]).astype(np.int32), bits


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


def _groups(ptr: np.ndarray) -> Iterator[tuple[int, int]]:
    d, n = 0, len(ptr) - 1
    while d < n:
        to = max(d + 1, int(np.searchsorted(ptr, ptr[d] + TOKENS_AT_ONCE, "right")) - 1)
        yield d, to
        d = to


def _inputs(stretch: np.ndarray, slots: np.ndarray, third: np.ndarray) -> np.ndarray:
    """What each context says of each bit, and a constant (tokens x bits x contexts + 1)."""
    out = np.empty((*third.shape, CONTEXTS + 1), np.float32)
    for c in range(CONTEXTS - 1):
        out[..., c] = stretch[c][slots[c]]
    out[..., CONTEXTS - 1] = third
    out[..., CONTEXTS] = 0.3
    return out


def _mapped(table: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Half the mixer's probability, half what the map holds for its neighbourhood."""
    gate = np.arange(CLASS_BITS)[None]
    q = (np.clip(s, -8, 8) + 8) * ((MAP_STEPS - 1) / 16)
    j = np.minimum(q.astype(np.int32), MAP_STEPS - 2)
    f = q - j
    return 0.5 * (_squash(s) + (1 - f) * table[gate, j] + f * table[gate, j + 1])


def _mixed(model: dict, cls: np.ndarray, ptr: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Log2 probability of every token's class. ``third`` (tokens x bits) is what the counts after two words say. Each text begins
    with the model's weights, and they go on learning block by block."""
    n_docs = len(ptr) - 1
    out = np.zeros(len(cls))
    local = np.repeat(model["weights"][None], n_docs, 0).astype(np.float32)
    counts = np.diff(ptr)
    place = np.arange(len(cls)) - np.repeat(ptr[:-1], counts)
    owner = np.repeat(np.arange(n_docs), counts)
    block = place // BLOCK
    order = np.argsort(block, kind="stable")
    edges = np.searchsorted(block[order], np.arange(int(block.max()) + 2 if len(block) else 1))
    slots, bits = _slots(cls, ptr)
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        pick = order[lo:hi]
        x = _inputs(model["stretch"], slots[:, pick], third[pick])
        own, y = owner[pick], bits[pick]
        s = np.einsum("tbc,bc->tb", x, model["weights"]) if lo == 0 else np.einsum("tbc,tbc->tb", x, local[own])
        p = _mapped(model["map"], s)
        right = np.where(y > 0, p, 1 - p)
        out[pick] = np.log2(np.clip(right, 1e-6, 1)).sum(1)
        cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        size = np.diff(np.r_[cut, len(own)])[:, None, None]
        local[own[cut]] += RATE * np.add.reduceat((y - p).astype(np.float32)[:, :, None] * x, cut, axis=0) / size**0.5
    return out


def _pack(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], names)


COUNTED = "kind int, part int, keys binary, counts binary"
_COUNTED = (["kind", "part", "keys", "counts"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])
WORD, PAIR, TRIPLE = 0, 1, 2
PAIRS = (CLASSES + 1) * CLASSES


def _squeeze(x: np.ndarray) -> bytes:
    """Whole numbers from 0, in as few bytes as the largest needs, like bytes together."""
    size = next(k for k in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << (8 * k))
    raw = np.ascontiguousarray(np.ascontiguousarray(x, f"<u{size}").view(np.uint8).reshape(-1, size).T).tobytes()
    return np.array([size, len(x)], np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _loosen(b: bytes) -> np.ndarray:
    size, n = np.frombuffer(b, np.int64, 2).tolist()
    raw = np.frombuffer(pa.decompress(b[16:], size * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).reshape(-1).view(f"<u{size}").astype(np.int64)


def _rising(x: np.ndarray) -> bytes:
    return _squeeze(np.diff(x, prepend=0))


def _risen(b: bytes) -> np.ndarray:
    return np.cumsum(_loosen(b))


def _sum(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, n = h[order], n[order]
    cut = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return h[cut], (np.add.reduceat(n, cut) if len(cut) else n).astype(np.int64)


def _word_parts(h: np.ndarray, parts: int) -> np.ndarray:
    return (h % np.uint64(parts)).astype(np.int64)


def _triple_parts(t: np.ndarray, parts: int) -> np.ndarray:
    """All triples after the same two words are in one part. While parts are few, neighbouring pairs of words go together, which keeps the
    steps between a part's triples small."""
    together = min(7, max(0, int(math.log2((CLASSES + 1) ** 2 / (16 * parts)))))
    return _word_parts(mix((t >> (CLASS_BITS + together)).astype(np.uint64)), parts)


def _cuts(part: np.ndarray) -> list[tuple[int, int]]:
    """Where each part of a sorted column begins and ends."""
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, np.int64)
    return list(zip(cut.tolist(), np.r_[cut[1:], len(part)].tolist(), strict=True)) if len(part) else []


def _count_rows(kind: int, got: list, parts: int) -> list[tuple]:
    h, n = _sum(np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got]))
    part = _word_parts(h, parts) if kind == WORD else _triple_parts(h, parts)
    order = np.argsort(part, kind="stable")
    h, n, part = h[order], n[order], part[order]
    return [(kind, int(part[a]), *_stored(kind, h[a:b], n[a:b])) for a, b in _cuts(part)]


def _stored(kind: int, h: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    return (h.tobytes(), n.tobytes()) if kind == WORD else (_rising(h), _squeeze(n))


def _read(kind: int, keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of some stored rows, row after row."""
    if kind == WORD:
        return np.frombuffer(b"".join(keys), np.uint64), np.frombuffer(b"".join(counts), np.int64)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(none + [_risen(x) for x in keys]), np.concatenate(none + [_loosen(x) for x in counts])


def _count(parts: int):
    """Counts by part: of words, and of class pairs and class triples of the rows the context counts are learned from."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, got = np.zeros(PAIRS, np.int64), {WORD: [], TRIPLE: []}
        for batch in batches:
            h, ptr = _with_end(tokens(batch.column("text"), lower=True))
            got[WORD].append(np.unique(h, return_counts=True))
            cls, use = _classes(h), np.repeat(batch.column("fold").to_numpy(zero_copy_only=False) < 9, np.diff(ptr))
            t = _triples(cls, ptr)[use]
            pairs += np.bincount(t // ((CLASSES + 1) << CLASS_BITS) * CLASSES + cls[use], minlength=PAIRS)
            got[TRIPLE].append(np.unique(t, return_counts=True))
            for kind, held in got.items():
                if sum(len(x[0]) for x in held) > 1 << 19:
                    yield _pack(_count_rows(kind, held, parts), *_COUNTED)
                    held.clear()
        for kind, held in got.items():
            if held:
                yield _pack(_count_rows(kind, held, parts), *_COUNTED)
        at = np.flatnonzero(pairs)
        part = at * parts // PAIRS
        yield _pack([(PAIR, int(part[a]), *_stored(PAIR, at[a:b], pairs[at[a:b]])) for a, b in _cuts(part)], *_COUNTED)

    return deal


def _add_up(group: pa.Table) -> pa.Table:
    kind, part = group.column("kind")[0].as_py(), group.column("part")[0].as_py()
    h, n = _sum(*_read(kind, group.column("keys").to_pylist(), group.column("counts").to_pylist()))
    return pa.Table.from_batches([_pack([(kind, part, *_stored(kind, h, n))], *_COUNTED)])


def _paths(table: np.ndarray, counts: np.ndarray, t: np.ndarray) -> np.ndarray:
    """For each triple of ``t`` (sorted): how often its two words were counted, and how often with each longer start of its class
    (CLASS_BITS + 1 rows). ``table``: the sorted triples of the part."""
    sums = np.r_[0, np.cumsum(counts)]
    start = t >> CLASS_BITS << CLASS_BITS
    lo, hi = np.searchsorted(table, start), np.searchsorted(table, start + CLASSES)
    out = np.zeros((CLASS_BITS + 1, len(t)), np.int64)
    out[0] = sums[hi] - sums[lo]
    for k in range(CLASS_BITS):
        left = np.flatnonzero(hi > lo)
        a, b = lo[left], hi[left]
        middle = (t[left] >> (CLASS_BITS - k) << (CLASS_BITS - k)) + (CLASSES >> (k + 1))
        at = a + (table[a] < middle)
        more = np.flatnonzero(b - a > 1)
        at[more] = np.searchsorted(table, middle[more])
        upper = t[left] >= middle
        lo[left], hi[left] = np.where(upper, at, a), np.where(upper, b, at)
        out[k + 1, left] = sums[hi[left]] - sums[lo[left]]
    return out


def _starts(t: np.ndarray, level: int) -> np.ndarray:
    """Where, among sorted triples, the first ``level`` bits of the class (with the two words) change."""
    top = t >> (CLASS_BITS - level)
    return np.r_[True, top[1:] != top[:-1]]


def _pack_paths(n: np.ndarray, t: np.ndarray) -> bytes:
    """Counts along the bits of sorted triples (CLASS_BITS + 1 rows); what neighbours share is sent once. After the first row it is what
    each bit leaves aside, mostly nothing."""
    packed = [_squeeze(n[0][_starts(t, 0)])]
    for k in range(1, CLASS_BITS + 1):
        at = _starts(t, k)
        packed.append(_squeeze(n[k - 1][at] - n[k][at]))
    return np.array([len(x) for x in packed], np.int64).tobytes() + b"".join(packed)


def _unpack_paths(raw: bytes, t: np.ndarray) -> np.ndarray:
    cut = np.cumsum([8 * (CLASS_BITS + 1), *np.frombuffer(raw, np.int64, CLASS_BITS + 1).tolist()]).tolist()
    out = np.stack([_loosen(raw[cut[k] : cut[k + 1]])[np.cumsum(_starts(t, k)) - 1] for k in range(CLASS_BITS + 1)])
    for k in range(CLASS_BITS):
        np.subtract(out[k], out[k + 1], out=out[k + 1])
    return out


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, tokens, words) of the stored counts."""
    for batch in batches:
        n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for k, c in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            cls = _classes(np.frombuffer(k, np.uint64))
            n += np.bincount(cls, np.frombuffer(c, np.int64), CLASSES).astype(np.int64)
            v += np.bincount(cls, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(n), pa.array(v)], ["c", "n", "v"])


START = np.concatenate([np.full((CLASS_BITS, CONTEXTS), 1 / CONTEXTS), np.zeros((CLASS_BITS, 1))], 1).astype(np.float32)
DEALT = "bucket int, base long, a binary, b binary, c binary"
_DEALT = (["bucket", "base", "a", "b", "c"], [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])
_ROW = np.dtype([("doc", "i8"), ("known_id", "i1"), ("tokens", "i8"), ("bytes", "i8")])


def _asked(cls: np.ndarray, ptr: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct triples of a batch by part and number, their parts, and which of them each token is."""
    t, own = np.unique(_triples(cls, ptr), return_inverse=True)
    part = _triple_parts(t, parts)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(t), np.int64)
    place[order] = np.arange(len(t))
    return t[order], part[order], place[own]


def _deal(parts: int, words: bool):
    """Per batch: a row that tells the batch itself, and its distinct class triples and words, by part, to meet their counts. Without
    ``words`` (training of the weights) tokens are told by their class, else by the place of their word among the batch's."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            h, ptr = _with_end(tokens(batch.column("text"), lower=True))
            row = np.zeros(batch.num_rows, _ROW)
            ids = batch.column("doc_id")
            row["doc"], row["known_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)
            row["tokens"] = np.diff(ptr)
            row["bytes"] = batch.column("n_bytes").to_numpy(zero_copy_only=False)
            rows = []
            if words:
                held, own = np.unique(h, return_inverse=True)
                part = _word_parts(held, parts)
                order = np.argsort(part, kind="stable")
                place = np.empty(len(held), np.int64)
                place[order] = np.arange(len(held))
                rows += [(int(part[order[x]]), at, None, held[order[x:y]].tobytes(), None) for x, y in _cuts(part[order])]
                rows.append((int(at % parts), at, row.tobytes(), _squeeze(_classes(held[order])), _squeeze(place[own])))
            else:
                rows.append((int(at % parts), at, row.tobytes(), None, _squeeze(_classes(h))))
            t, part, _ = _asked(_classes(h), ptr, parts)
            rows += [(parts + int(part[x]), at, None, _rising(t[x:y]), None) for x, y in _cuts(part)]
            yield _pack(rows, *_DEALT)
            at += batch.num_rows

    return deal


MET = "base long, part int, a binary, b binary, c binary"
_MET = (["base", "part", "a", "b", "c"], [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])


def _meet(parts: int):
    """Words and triples meet their counts: per batch and part the counts of its words (part from 0), and the counts along each
    triple's bits (part from ``parts``), in the order they were asked. The batch's own row goes through (part -1)."""

    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        kind = WORD if bucket < parts else TRIPLE
        table = group.filter(pc.less(group.column("base"), 0))
        h, n = _read(kind, table.column("b").to_pylist(), table.column("c").to_pylist())
        out = []
        asks = group.filter(pc.greater_equal(group.column("base"), 0)).to_pylist()
        if kind == TRIPLE:
            # Batches ask for much the same triples: each is followed once.
            asked = [_risen(r["b"]) for r in asks]
            every, own = np.unique(np.concatenate([np.zeros(0, np.int64), *asked]), return_inverse=True)
            paths, at = _paths(h, n, every), 0
            for r, t in zip(asks, asked, strict=True):
                out.append((r["base"], bucket, None, None, _pack_paths(paths[:, own[at : at + len(t)]], t)))
                at += len(t)
            return pa.Table.from_batches([_pack(out, *_MET)])
        for r in asks:
            if r["a"] is not None:
                out.append((r["base"], -1, r["a"], r["b"], r["c"]))
            else:
                words = np.frombuffer(r["b"], np.uint64)
                c = np.zeros(len(words), np.int64)
                if len(h):
                    j = np.searchsorted(h, words)
                    j[j == len(h)] = 0
                    c = np.where(h[j] == words, n[j], 0)
                out.append((r["base"], bucket, None, None, _squeeze(c)))
        return pa.Table.from_batches([_pack(out, *_MET)])

    return run


def _back(rows: list[dict], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple | None, Iterator]:
    """A batch again: its rows, classes and bounds, (word of each token, count of each word), and by group of texts (from, to, what the
    counts after two words say)."""
    first = next(r for r in rows if r["part"] < 0)
    answers = sorted((r for r in rows if r["part"] >= 0), key=lambda r: r["part"])
    row, seq = np.frombuffer(first["a"], _ROW).copy(), _loosen(first["c"])
    ptr = np.r_[0, np.cumsum(row["tokens"])]
    words = None
    if first["b"] is not None:
        counts = np.concatenate([np.zeros(0, np.int64), *[_loosen(r["c"]) for r in answers if r["part"] < parts]])
        words, seq = (seq, counts), _loosen(first["b"])[seq]
    cls = seq.astype(np.int32)
    t, part, own = _asked(cls, ptr, parts)
    told = np.zeros((len(t), CLASS_BITS), np.float32)
    found = {r["part"]: r["c"] for r in answers if r["part"] >= parts}
    sign = 2 * ((t >> np.arange(CLASS_BITS)[::-1, None]) & 1).astype(np.float32) - 1
    prior = np.float32(PRIOR)
    for lo, hi in _cuts(part):
        n = _unpack_paths(found[parts + int(part[lo])], t[lo:hi])
        ahead, aside = n[1:].astype(np.float32) + prior, (n[:-1] - n[1:]).astype(np.float32) + prior
        told[lo:hi] = (np.log(ahead / aside) * sign[:, lo:hi]).T
    return row, cls, ptr, words, ((a, b, told[own[ptr[a] : ptr[b]]]) for a, b in _groups(ptr))


LESSON = "part array<int>, a array<binary>, b array<binary>, c array<binary>"


def _lesson(group: pa.Table) -> pa.Table:
    """A batch and its answers as one row, to be read in every round."""
    cols = {k: pa.array([group.column(k).to_pylist()], pa.list_(_MET[1][1] if k == "part" else pa.binary())) for k in ("part", "a", "b", "c")}
    return pa.table(cols)


def _bits_of(batches: Iterator[pa.RecordBatch], stretch: np.ndarray, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Inputs and bits of the lessons, group by group."""
    for batch in batches:
        for r in batch.to_pylist():
            rows = [dict(zip(("part", "a", "b", "c"), x, strict=True)) for x in zip(r["part"], r["a"], r["b"], r["c"], strict=True)]
            _, cls, ptr, _, groups = _back(rows, parts)
            for a, b, third in groups:
                slots, bits = _slots(cls[ptr[a] : ptr[b]], ptr[a : b + 1] - ptr[a])
                yield _inputs(stretch, slots, third), bits


def _sums(lessons: DataFrame, shared, parts: int, size: int, part) -> np.ndarray:
    """Sum of vectors of ``size`` over all bits of the lessons."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(size)
        for x, y in _bits_of(batches, shared.value, parts):
            acc += part(x, y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(acc)], ["place", "value"])

    out = np.zeros(size)
    for r in lessons.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():  # ``size`` rows
        out[r["place"]] = r["value"]
    return out


def train_weights(lessons: DataFrame, shared, parts: int) -> np.ndarray:
    """Weights of each gate after ROUNDS Newton steps from even ones, in double precision. A gate without a bit keeps them."""
    w = START.astype(float)
    k = CONTEXTS + 1
    for _ in range(ROUNDS):

        def part(x: np.ndarray, y: np.ndarray, w=w) -> np.ndarray:
            x = x.astype(float).transpose(1, 0, 2)  # gates x tokens x contexts
            p = _squash(np.einsum("btc,bc->bt", x, w))
            g = np.einsum("bt,btc->bc", p - y.T, x)
            h = (x * (p * (1 - p))[..., None]).transpose(0, 2, 1) @ x
            return np.r_[g.ravel(), h.ravel()]

        got = _sums(lessons, shared, parts, CLASS_BITS * (k + k * k), part)
        g, h = got[: CLASS_BITS * k].reshape(CLASS_BITS, k), got[CLASS_BITS * k :].reshape(CLASS_BITS, k, k)
        w = w - np.stack([np.linalg.solve(h[b] + RIDGE * np.eye(k), g[b] + RIDGE * (w[b] - START[b])) for b in range(CLASS_BITS)])
    return w


def train_map(lessons: DataFrame, shared, parts: int, w: np.ndarray) -> np.ndarray:
    """How often a bit is one where the mixer says so much, near what the mixer says where there is little to go by."""
    gate = np.arange(CLASS_BITS)[None]
    size = CLASS_BITS * MAP_STEPS

    def part(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        s = np.einsum("tbc,bc->tb", x.astype(float), w)
        j = np.rint((np.clip(s, -8, 8) + 8) * ((MAP_STEPS - 1) / 16)).astype(np.int64)
        at = (gate * MAP_STEPS + j).ravel()
        return np.r_[np.bincount(at, y.ravel(), size), np.bincount(at, minlength=size)]

    got = _sums(lessons, shared, parts, 2 * size, part)
    even = np.tile(_squash(np.linspace(-8, 8, MAP_STEPS)), CLASS_BITS)
    return ((got[:size] + 8 * even) / (got[size:] + 8)).reshape(CLASS_BITS, MAP_STEPS)


def _finish(shared, parts: int, n_train: int, norm: float):
    def run(group: pa.Table) -> pa.Table:
        m = shared.value
        row, cls, ptr, (word, count), groups = _back(group.to_pylist(), parts)
        n_docs = len(row)
        owner = np.repeat(np.arange(n_docs), row["tokens"])
        base = np.bincount(owner, np.log10(count + ALPHA)[word], n_docs)
        logs = np.empty(len(cls))
        for a, b, third in groups:
            logs[ptr[a] : ptr[b]] = _mixed(m, cls[ptr[a] : ptr[b]], ptr[a : b + 1] - ptr[a], third)
        logs = logs * np.log10(2) - m["class_log"][cls]
        score = np.bincount(owner, logs, n_docs) + base
        with np.errstate(divide="ignore", invalid="ignore"):
            bpb = -score * np.log2(10) / row["bytes"]
        return pa.table({
            "doc_id": pa.array(row["doc"].copy(), mask=row["known_id"] == 0), "n_tokens": row["tokens"].copy(),
            "n_known": np.bincount(owner, count[word] > 0, n_docs).astype(np.int64), "train_tokens": np.full(n_docs, n_train, np.int64),
            "base_score": base - row["tokens"] * norm, "score": score, "bits_per_byte": pa.array(bpb, mask=row["bytes"] == 0),
        })

    return run


SCORED = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


@dataclass
class Learned:
    """What the corpus gave: the model (of fixed size), the stored counts of words and triples by part, and totals."""

    model: dict
    table: DataFrame
    parts: int
    n_train: int
    distinct: int


def _base(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                       F.coalesce((crc32_of_id(key) % 10).cast("int"), F.lit(0)).alias("fold"))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Learned:
    """Counts, weights and map from the documents whose remainder is not 0."""
    spark = docs.sparkSession
    tune(spark)
    base = _base(docs, key, text)
    train = base.where("fold <> 0").select("text", "fold")
    parts = width(docs, GROUP_BYTES)

    counts = materialize(train.mapInArrow(_count(parts), COUNTED).groupBy("kind", "part").applyInArrow(_add_up, COUNTED), "counts")
    words = counts.where(F.col("kind") == WORD)

    n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in words.mapInArrow(_totals, "c int, n long, v long").groupBy("c").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[r["c"]], v[r["c"]] = r["n"], r["v"]
    n_train, distinct = int(n.sum()), int(v.sum())

    pairs = np.zeros(PAIRS, np.int64)
    for r in counts.where(F.col("kind") == PAIR).collect():  # at most PAIRS counts
        at, got = _read(PAIR, [r["keys"]], [r["counts"]])
        pairs[at] = got
    pairs = pairs.reshape(CLASSES + 1, CLASSES)
    stretch = np.zeros((CONTEXTS - 1, SLOTS), np.float32)
    for k in range(CLASS_BITS):
        both = pairs.reshape(CLASSES + 1, 1 << k, 2, -1).sum(3)
        at = np.arange(1 << k, 2 << k)
        for c, ctx, x in ((0, 0, both.sum(0)), (1, np.arange(CLASSES + 1)[:, None] * (CLASSES - 1) - 1, both)):
            stretch[c, ctx + at] = np.log((x[..., 1] + PRIOR) / (x[..., 0] + PRIOR))
    table = counts.where(F.col("kind") != PAIR).select(
        (F.col("part") + F.when(F.col("kind") == TRIPLE, parts).otherwise(0)).cast("int").alias("bucket"), F.lit(-1).cast("long").alias("base"),
        F.lit(None).cast("binary").alias("a"), F.col("keys").alias("b"), F.col("counts").alias("c"),
    )
    dealt = base.where("fold = 9").select("doc_id", "text", "n_bytes").mapInArrow(_deal(parts, False), DEALT)
    met = dealt.union(table.where(F.col("bucket") >= parts)).groupBy("bucket").applyInArrow(_meet(parts), MET)
    lessons = materialize(met.groupBy("base").applyInArrow(_lesson, LESSON), "lessons")
    held = spark.sparkContext.broadcast(stretch)
    weights = train_weights(lessons, held, parts)
    model = {
        "stretch": stretch, "weights": weights.astype(np.float32), "map": train_map(lessons, held, parts, weights).astype(np.float32),
        "class_log": np.log10(np.maximum(n + ALPHA * (v + 1), 1e-300)),
    }
    return Learned(model, table, parts, n_train, distinct)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    known = learn(docs, key, text)
    parts = known.parts
    shared = docs.sparkSession.sparkContext.broadcast(known.model)
    dealt = _base(docs, key, text).select("doc_id", "text", "n_bytes").mapInArrow(_deal(parts, True), DEALT)
    met = dealt.union(known.table).groupBy("bucket").applyInArrow(_meet(parts), MET)
    norm = math.log10(known.n_train + ALPHA * (known.distinct + 1))
    out = met.groupBy("base").applyInArrow(_finish(shared, parts, known.n_train, norm), SCORED)
    held_out = F.coalesce(crc32_of_id() % 10 == 0, F.lit(True)).alias("held_out")
    return out.select("doc_id", held_out, *out.columns[1:])
