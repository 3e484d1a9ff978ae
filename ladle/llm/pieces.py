"""Subword encoding and decoding with the pieces of a SentencePiece model file.

An Aho-Corasick automaton over all pieces reads a text once. At every position it names the pieces that end there (its own node
and those on its output links, longest first), and each of them relaxes the best score of the prefix that ends there: single-pass
Viterbi. The best segmentation has the highest sum of piece scores (in millionths). Of equal sums the one with fewer pieces wins, then
the one whose last piece is longer. Characters that no piece covers are spelt with the model's byte pieces.

A unigram model's scores are those in its file. A merge model's file has ranks instead of log probabilities; a piece then scores
as Zipf's law gives for its rank: -log(rank + 1) - log(sum of 1 / r).

As no piece holds the space mark after another character, the best segmentation of a text is the chain of those of its units (a run
of space marks and what follows up to the next run). For the same reason a unit falls apart between two characters that stand side by
side in no piece, such as a letter and a comma. Equal units and parts are looked up in bounded tables of each worker. Decoding
joins the pieces; encoding and decoding give every text back exactly, as nothing is normalised: a space becomes the
space mark, with one put in front of a non-empty text, and a text's own space marks are spelt in bytes.

Cases: a null text has null ids and decodes to null; an empty text has no ids. Repeated rows are encoded alike. Other columns
are kept as they are; a column of the new column's name is replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructType

from ladle.llm.common import tune

SPACE = "▁"
UNITS = 1 << 18
PARTS = 1 << 19
_OWN_MARK = "\x00mark\x00"
BYTE_SCORE = -30.0
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


_NONE = -(1 << 100)


def _value(score: float) -> int:
    """A score in millionths and, below it, one piece: a whole number, so that sums are exact and compare in one step."""
    return (round(score * 1_000_000) << 24) - 1


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Encoder:
    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], special: set[int]):
        self.pieces, self.byte_ids = pieces, byte_ids
        self.automaton = ahocorasick.Automaton()
        for i, (p, s) in enumerate(zip(pieces, scores, strict=True)):
            if p and i not in special and p not in self.automaton:
                if SPACE in p.lstrip(SPACE):
                    raise ValueError("a piece holds a space mark after another character")
                self.automaton.add_word(p, (len(p), _value(s), i))
        self.automaton.make_automaton()
        self.byte_of = {i: b for b, i in enumerate(byte_ids)}
        self.bytes = [p.replace(SPACE, " ").encode() for p in pieces]
        for i, b in self.byte_of.items():
            self.bytes[i] = bytes([b])
        for i in special - set(self.byte_of):
            self.bytes[i] = b""
        self.letters = {p for i, p in enumerate(pieces) if len(p) == 1 and i not in special}
        self.pairs = {p[k : k + 2] for i, p in enumerate(pieces) if i not in special for k in range(len(p) - 1)}
        self.seen: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def best(self, unit: str) -> bytes:
        """Best ids of a unit, packed: those of its parts."""
        pairs, parts, out, a = self.pairs, self.parts, [], 0
        for e in range(1, len(unit) + 1):
            if e == len(unit) or unit[e - 1 : e + 1] not in pairs:
                part = unit[a:e]
                got = parts.get(part)
                if got is None:
                    got = _packed(self.viterbi(part))
                    if len(parts) >= PARTS:
                        parts.clear()
                    if len(part) <= 64:
                        parts[part] = got
                out.append(got)
                a = e
        return out[0] if len(out) == 1 else b"".join(out)

    def viterbi(self, unit: str) -> list[int]:
        """Single pass over a part."""
        n = len(unit)
        value = [0, *[_NONE] * n]
        start, piece = [0] * (n + 1), [-1] * (n + 1)
        if self.letters.issuperset(unit):  # every prefix ends in a piece
            for last, (size, v, i) in self.automaton.iter(unit):
                e = last + 1
                new = value[e - size] + v
                if new > value[e]:
                    value[e], start[e], piece[e] = new, e - size, i
        else:
            ends: dict[int, list] = {}
            for last, found in self.automaton.iter(unit):
                ends.setdefault(last + 1, []).append(found)
            for e in range(1, n + 1):
                for size, v, i in ends.get(e, ()):
                    new = value[e - size] + v
                    if new > value[e]:
                        value[e], start[e], piece[e] = new, e - size, i
                if piece[e] < 0:  # no piece ends here: the last character in bytes
                    value[e] = value[e - 1] + len(unit[e - 1].encode("utf-8", "surrogatepass")) * _value(BYTE_SCORE)
                    start[e] = e - 1
        out: list[int] = []
        e = n
        while e:
            a, i = start[e], piece[e]
            out.extend([i] if i >= 0 else [self.byte_ids[b] for b in reversed(unit[a:e].encode("utf-8", "surrogatepass"))])
            e = a
        return out[::-1]

    def unit(self, unit: str) -> bytes:
        got = self.seen.get(unit)
        if got is None:
            if "\x00" in unit:
                mark = _packed([self.byte_ids[b] for b in SPACE.encode()])
                got = mark.join([self.best(part) if part else b"" for part in unit.split(_OWN_MARK)])
            else:
                got = self.best(unit)
            if len(self.seen) >= UNITS:
                self.seen.clear()
            if len(unit) <= 64:
                self.seen[unit] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids as packed int32."""
        if not text:
            return b""
        if SPACE in text or "\x00" in text:
            marked = text.replace(SPACE, _OWN_MARK).replace(" ", SPACE)
            return b"".join(map(self.unit, _UNIT.findall(SPACE + marked)))
        parts = text.split(" ")
        if "" in parts:
            return b"".join(map(self.unit, _UNIT.findall(SPACE + text.replace(" ", SPACE))))
        seen, unit = self.seen, self.unit
        return b"".join([seen.get(u) or unit(u) for u in [SPACE + p for p in parts]])

    def forget(self) -> None:
        """Empty the look-up tables: a worker outlives its task, and other work needs the memory."""
        self.seen.clear()
        self.parts.clear()

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces")
    special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    plain = [i for i in range(n) if i not in special]
    scores = [model.get_score(i) for i in range(n)]
    if all(s <= 0 and s == int(s) for s in (scores[i] for i in plain)):  # ranks
        norm = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
        for rank, i in enumerate(sorted(plain, key=lambda i: -scores[i])):
            scores[i] = -math.log(rank + 1) - norm
    return Encoder(pieces, scores, byte_ids, special)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of piece ids (array of int)."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = load(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            packed = [None if t is None else e.encode(t) for t in texts.to_pylist()]
            off = np.r_[0, np.cumsum([len(p) // 4 if p else 0 for p in packed])].astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(p for p in packed if p), np.int32))
            none = np.r_[[p is None for p in packed], False].astype(bool)
            column = pa.ListArray.from_arrays(pa.array(off, mask=none if none.any() else None), flat)
            yield _added(batch, ids, column)
        e.forget()

    return docs.mapInArrow(run, _with(docs, ids, ArrayType(IntegerType())))


def _with(docs: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([f for f in docs.schema.fields if f.name != name]).add(name, kind)


def _added(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    own = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != name]
    return pa.RecordBatch.from_arrays([*[c for _, c in own], column], [*[n for n, _ in own], name])


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with a column of decoded text."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = load(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            out = [None if not v.is_valid else e.decode(v.values.to_numpy(zero_copy_only=False)) for v in column]
            yield _added(batch, text, pa.array(out, pa.string()))

    return docs.mapInArrow(run, _with(docs, text, StringType()))


def digest(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_pieces, ids_crc32 (of little-endian unsigned 32-bit ids), and whether decoding gave the text back."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = load(path)
        for batch in batches:
            rows = [(None, None, None) if t is None else _digest(e, t) for t in batch.column("text").to_pylist()]
            n, crc, same = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                                             ["doc_id", "n_pieces", "ids_crc32", "round_trip"])
        e.forget()

    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return base.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")


def _digest(e: Encoder, text: str) -> tuple[int, int, bool]:
    packed = e.encode(text)
    return len(packed) // 4, zlib.crc32(packed), e.decode(np.frombuffer(packed, np.int32)) == text
