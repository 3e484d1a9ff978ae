"""Token ids of whole texts, by a tokenizer file of the tokenizers library, batch by batch.

Neither a byte-level nor a word tokenizer has a piece that goes on over a space that something visible follows, or from a letter to a
punctuation mark. So a batch is cut there, equal parts are told by Arrow's dictionary, the tokenizer itself encodes every distinct part
once, and the ids of the texts are gathered from those of their parts. Where what follows the space could be white space of
another kind, there is no cut; nor is there any if a cut would go through one of the tokenizer's added tokens.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
CACHED = 1 << 19
SEEN = 1 << 22
LONG_PART = 64

#: Bytes that may follow a space at a cut: all but ASCII white space and control bytes, and the first bytes of characters
#: among which Unicode has white space (U+0080 to U+00BF, U+1000 to U+3FFF).
_VISIBLE = np.ones(256, bool)
_VISIBLE[:0x21] = False
_VISIBLE[[0xC2, 0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b",.;:!?)'\"\n")] = True


def _cuts(raw: np.ndarray) -> np.ndarray:
    """Bytes before which a text may be cut."""
    out = np.zeros(len(raw), bool)
    out[:-1] = (raw[:-1] == 0x20) & _VISIBLE[raw[1:]]
    letter = _LETTER[raw]
    # U+00C0 to U+00FF are letters but for the two signs of multiplication and division.
    letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    out[1:] |= letter[:-1] & _MARK[raw[1:]]
    return out


#: A word that each layout below reads as one piece.
_SIMPLE = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: How a simple word reaches the merges: as it is (byte-level), or without the space and in lower case (word pieces).
_LAYOUTS = (lambda joined: joined, lambda joined: joined.replace(" ", "").lower())
_PROBES = (" the", "The", " Éole", "zürich", "X", " é", " unbelievably")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is visible, the next free one from 256 on otherwise."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Encoder:
    """A part is remembered from its second sighting on, so that words seen once do not crowd out the others. New simple words go
    straight to the tokenizer's merges, all else through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.kind, self.code = (np.dtype("<u2"), "H") if small else (np.dtype("<u4"), "I")
        self.known: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)
        self.letters = _byte_letters()
        added = [np.frombuffer(t.content.encode(), np.uint8) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = any(_cuts(x).any() for x in added)
        want = [self.tokenizer.encode(p, add_special_tokens=False).ids for p in _PROBES]
        self.layout = next((x for x in _LAYOUTS if self._merged(list(_PROBES), x) == want), None)

    def _merged(self, words: list[str], layout) -> list[list[int]]:
        joined = layout("\0".join(words)).encode().decode("latin-1").translate(self.letters)
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(w)] for w in joined.split(self.letters[0])]

    def _new(self, parts: list[str]) -> list[bytes]:
        simple = [self.layout is not None and _SIMPLE.fullmatch(p) is not None for p in parts]
        words = list(compress(parts, simple))
        direct = iter(self._merged(words, self.layout) if words else ())
        rest = [p for p, s in zip(parts, simple, strict=True) if not s]
        others = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return [array(self.code, next(direct) if s else next(others).ids).tobytes() for s in simple]

    def _parts(self, parts: list[str]) -> list[bytes]:
        got = list(map(self.known.get, parts))
        new = [i for i, x in enumerate(got) if x is None]
        if new:
            if len(self.known) > CACHED:
                self.known.clear()
            for i, ids in zip(new, self._new([parts[i] for i in new]), strict=True):
                got[i] = ids
                at = hash(parts[i]) % SEEN
                if self.seen[at]:
                    if len(parts[i]) <= LONG_PART:
                        self.known[parts[i]] = ids
                else:
                    self.seen[at] = 1
        return got

    def _chunk(self, raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts that begin at ``begin`` and fill ``raw``, and how many each has."""
        offsets = np.r_[begin, len(raw)].astype(np.int64)
        held = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        own = held.indices.to_numpy(zero_copy_only=False)
        packed = self._parts(held.dictionary.to_pylist())
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // self.kind.itemsize
        flat = np.frombuffer(b"".join(packed), self.kind)
        n = size[own]
        first = (np.cumsum(size) - size)[own]
        return flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())], n

    def encode(self, text: str) -> bytes:
        return self.batch(pa.array([text], pa.string()))[0].tobytes()

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (one more than there are texts). A null text has none."""
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int64, n + 1 + texts.offset)[texts.offset :]
        raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
        raw, off = raw[off[0] : off[-1]], off - off[0]
        if not len(raw):
            return np.zeros(0, self.kind), np.zeros(n + 1, np.int64)
        cut = np.zeros(len(raw), bool) if self.whole else _cuts(raw)
        cut[off[:-1][off[:-1] < len(raw)]] = True
        begin = np.flatnonzero(cut)
        ids, sizes, at = [], [], 0
        while at < len(begin):
            to = max(at + 1, int(np.searchsorted(begin, begin[at] + CHUNK_BYTES, "right")) - 1) if begin[at] + CHUNK_BYTES < len(raw) else len(begin)
            end = begin[to] if to < len(begin) else len(raw)
            a, b = self._chunk(raw[begin[at] : end], begin[at:to] - begin[at])
            ids.append(a)
            sizes.append(b)
            at = to
        before = np.r_[0, np.cumsum(np.concatenate(sizes))]
        return np.concatenate(ids), before[np.searchsorted(begin, off)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def closed(ids: np.ndarray, ptr: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id after each text."""
    n = len(ptr) - 1
    to = ptr + np.arange(n + 1)
    out = np.full(to[-1] if n else 0, end_id, ids.dtype)
    own = np.ones(len(out), bool)
    own[to[1:] - 1] = False
    out[own] = ids
    return out, to
