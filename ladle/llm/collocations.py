"""Phrase collocations by top-order marginalisation.

Texts are cut into pieces at punctuation and line ends and into words at spaces and tabs; A-Z are lower-cased. A window is a word and the
``longest`` - 1 words after it in its piece, padded where the piece ends, so every word occurrence starts exactly one window, and only these
longest windows are counted. Each shorter phrase is a prefix of windows: Spark's ROLLUP over (lang, first word, second word, ...) adds up the
counts of all of them at once, down to the words and the total of a language; no text is cut into shorter n-grams.

Words are counted first, each told by a hash of language and word. A word with fewer than ``least`` occurrences in its language cannot be in a
candidate: in the windows one mark stands for it, and what follows it is cut off. Words are looked up in a bitmap of the hashes of
frequent words; its size is fixed (FILTER_BITS), and where it is full it marks less and results stay the same. The CODES most frequent words
have short numbers, the others their hash, so windows are a few whole numbers and small where they are shuffled.

Windows are combined in each Arrow batch before they move, so a line that a third of all texts hold costs a row a batch. They are dealt by
language and all words but the last, once; the counts of whole windows and of that longest prefix need no further move. Only prefixes with
``least`` occurrences keep their last word from there on, the others are added to what they begin with.

A candidate is a phrase of 2 to ``longest`` words with at least ``least`` occurrences. It is scored at its weakest cut,
floor(SCALE * a * a / (l * r)) in decimals (exact for counts below 10**13), and dropped if a longer candidate that contains it occurs at
least ``share`` percent as often. The first ``top`` of a language are found in salted groups first, so that no task ranks a whole language.

Cases: a null or empty text has no words; a null language is ``und``, as is a language of that name. Repeated rows count each. Words may be
of any length. A language without a candidate has no row, and an empty table gives none. Other columns are ignored. Words are told by 62 bits;
two frequent words with one hash raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import materialize, mix, tokens, tune, width
from ladle.operators.skew import attach

LONGEST, LEAST, TOP, SHARE, SCALE = 3, 10, 2000, 50, 1_000_000
#: Bytes that end a piece (fixed values of the definition), and those that end a word inside one.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b"\x20\x09"
#: Codes of the place after the end of a piece, and of a word that is too rare; those of words are above.
PAD, RARE = 0, 1
CODES = 1 << 16
FILTER_BITS = 1 << 26
_HIGH = 1 << 62
PART_BYTES = 6 << 20
AT_ONCE = 3 << 20
SALTS = 16


def _flags(which: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(which)] = True
    return out


_BREAK, _SEPARATOR = _flags(BREAKS), _flags(BREAKS + SPACES)


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


@dataclass
class Read:
    """Words of a batch: which distinct (language, word) each is; of those, the hash, the word's string and its language; the
    languages; and how many words follow each in its piece."""

    word: np.ndarray
    key: np.ndarray
    strings: pa.Array
    lang: np.ndarray
    langs: pa.Array
    after: np.ndarray


def _read(batch: pa.RecordBatch) -> Read:
    w = tokens(batch.column("text"), lower=True, seps=_SEPARATOR)
    n = len(w.hashes)
    bounds = np.r_[0, np.cumsum(w.end - w.start)].astype(np.int64)
    letters = np.ascontiguousarray(w.data[~_SEPARATOR[w.data]])
    held = pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds), pa.py_buffer(letters)).dictionary_encode()
    lang = batch.column("lang").dictionary_encode()
    owner = w.owner
    own = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
    salts = np.array([_salt(x) for x in lang.dictionary.to_pylist()], np.uint64)
    _, first, word = np.unique(own * max(1, len(held.dictionary)) + held.indices.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
    key = mix(w.hashes[first] ^ salts[own[first]]) >> np.uint64(2) | np.uint64(_HIGH)
    broken = np.cumsum(_BREAK[w.data], dtype=np.int64)
    ends = np.ones(n, bool)
    ends[:-1] = (owner[1:] != owner[:-1]) | (broken[w.start[1:] - 1] > broken[w.end[:-1] - 1])
    last = np.flatnonzero(ends)
    after = np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(n)
    return Read(word, key.view(np.int64), held.dictionary.take(held.indices.take(pa.array(first))), own[first], lang.dictionary, after)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most AT_ONCE bytes of text, or of a single row."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + AT_ONCE, "right")))
            yield batch.slice(at, to - at)
            at = to
            pa.default_memory_pool().release_unused()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        r = _read(batch)
        n = np.bincount(r.word, minlength=len(r.key)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(r.key), r.langs.take(pa.array(r.lang)), r.strings.cast(pa.string()), pa.array(n)], ["key", "lang", "word", "n"])


@dataclass
class Vocabulary:
    """The frequent words (stored: key, lang, word, n, code), the bitmap of their hashes, and keys and codes of the most frequent ones."""

    words: DataFrame
    bitmap: np.ndarray
    keys: np.ndarray
    codes: np.ndarray


def vocabulary(texts: DataFrame, least: int) -> Vocabulary:
    """Words with at least ``least`` occurrences in their language."""
    counted = texts.mapInArrow(_count_words, "key long, lang string, word string, n long").groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
    words = materialize(counted.where(F.col("n") >= least), "words")
    top = [r["key"] for r in words.orderBy(F.desc("n"), "key").limit(CODES).select("key").collect()]
    if words.groupBy("key").count().where("count > 1").limit(1).count():
        raise RuntimeError("two frequent words share a hash")
    spark = texts.sparkSession
    short = spark.createDataFrame(pa.table({"key": pa.array(top, pa.int64()), "code": pa.array(range(2, len(top) + 2), pa.int64())}))
    coded = words.join(F.broadcast(short), "key", "left").withColumn("code", F.coalesce("code", "key"))
    bits = words.select((F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1).alias("bit"))
    buckets = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    bitmap = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in buckets.collect():  # at most FILTER_BITS / 32768 rows
        raw = np.frombuffer(r["bits"], np.uint8)
        at = (r["bucket"] - 1) * len(raw)
        bitmap[at : at + len(raw)] = raw
    keys = np.array(top, np.int64)
    order = np.argsort(keys)
    return Vocabulary(materialize(coded, "codes"), bitmap, keys[order], order + 2)


def _windows(shared, longest: int):
    """Rows (lang, w1, w2, ..., n) of the distinct windows of each batch, words as codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, keys, codes = shared.value
        for batch in _small(batches):
            r = _read(batch)
            n = len(r.word)
            low = r.key & (FILTER_BITS - 1)
            known = (bitmap[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1
            at = np.searchsorted(keys, r.key)
            at[at == len(keys)] = 0
            short = keys[at] == r.key if len(keys) else np.zeros(len(at), bool)
            code = np.where(short, codes[at] if len(keys) else 0, np.where(known, r.key, RARE))
            # Numbers of the batch: 0 and 1 as above, then its distinct words.
            number = np.where(code == RARE, RARE, np.arange(len(code)) + 2)
            every = np.r_[PAD, RARE, code]
            word = number.astype(np.int32)[r.word]
            cols, whole = [word], word > RARE
            for k in range(1, longest):
                lead = np.full(n, PAD, np.int32)
                lead[: max(0, n - k)] = word[k:]
                lead[~whole | (r.after < k)] = PAD
                cols.append(lead)
                whole = whole & (lead > RARE)
            # Distinct rows: the trailing columns get a number each time another column joins in front.
            held, kept = cols[-1], np.arange(n)
            for c in [*cols[-2::-1], r.lang[r.word]]:
                _, kept, held = np.unique(c.astype(np.int64) * (int(held.max()) + 1 if n else 1) + held, return_index=True, return_inverse=True)
            count = np.bincount(held, minlength=len(kept)) if n else np.zeros(0, np.int64)
            out = [pa.array(every[c[kept]]) for c in cols]
            yield pa.RecordBatch.from_arrays([r.langs.take(pa.array(r.lang[r.word[kept]])), *out, pa.array(count.astype(np.int64))], ["lang", *[f"w{i + 1}" for i in range(longest)], "n"])

    return run


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Phrases and words, both stored. Phrases (lang, ws, f): codes of 1 to ``longest`` words with at least ``least`` occurrences, and for
    each language no word with the number of all its words. Words (code, word)."""
    tune(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = vocabulary(texts, least)
    shared = docs.sparkSession.sparkContext.broadcast((known.bitmap, known.keys, known.codes))
    names = [f"w{i + 1}" for i in range(longest)]
    heads, tail, edge = ["lang", *names[:-1]], names[-1], names[-2]
    rows = texts.mapInArrow(_windows(shared, longest), "lang string, " + ", ".join(f"{c} long" for c in names) + ", n long")
    whole = rows.repartition(width(docs, PART_BYTES), *heads).groupBy(*heads, tail).agg(F.sum("n").alias("n"))
    # Each window counts for its longest prefix (no last word), and once more for itself if it may be a candidate.
    frequent = (F.col(tail) > RARE) & (F.col("n") >= least)
    none = F.lit(None).cast("long")
    both = whole.select(*heads, "n", F.explode(F.when(frequent, F.array(none, F.col(tail))).otherwise(F.array(none))).alias(tail))
    sums = both.groupBy(*heads, tail).agg(F.sum("n").alias("n"))
    kept = F.when(F.col(tail).isNotNull() | (F.col("n") >= least), F.col(edge)).otherwise(F.lit(RARE).cast("long"))
    sums = materialize(sums.withColumn(edge, kept), "windows")

    top = sums.where(F.col(tail).isNotNull()).select("lang", F.array(*names).alias("ws"), F.col("n").alias("f"))
    levels = sums.where(F.col(tail).isNull()).rollup(*heads).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
    levels = levels.withColumn("size", (longest - 1 - F.bit_count("gid")).cast("int")).where("size >= 0")
    levels = levels.select("lang", F.slice(F.array(*names[:-1]), F.lit(1), F.col("size")).alias("ws"), "f")
    shorter = levels.where((F.size("ws") == 0) | (F.element_at("ws", -1) > RARE) & (F.col("f") >= least))
    return materialize(top.union(shorter), "phrases"), known.words.select("code", "word")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, share: int = SHARE, lang: str = "lang", text: str = "text") -> DataFrame:
    """Per language the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    return rank(*phrase_counts(docs, longest, least, lang, text), top, share)


def rank(counts: DataFrame, words: DataFrame, top: int, share: int) -> DataFrame:
    """Score, thin out and rank the candidates of ``phrase_counts``. Words are spelled out for those only that may be ranked."""
    size = F.size("ws")
    found = counts.where(size >= 2)
    cuts = found.select("lang", "ws", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "ws", "a", "k", F.slice("ws", F.lit(1), F.col("k")).alias("left"), F.slice("ws", F.col("k") + 1, size - F.col("k")).alias("right"))
    known = counts.where(size >= 1)
    for side, name in (("left", "l"), ("right", "r")):
        cuts = attach(cuts, known.select("lang", F.col("ws").alias(side), F.col("f").alias(name)), ["lang", side], "inner", stored=True)
    big = lambda c: F.col(c).cast("decimal(13,0)")
    product = (big("a") * big("a")).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(7,0)")
    cuts = cuts.withColumn("top", product.cast("decimal(38,0)")).withColumn("under", (big("l") * big("r")).cast("decimal(38,0)")).withColumn("score", F.expr("top div under"))
    weakest = cuts.groupBy("lang", "ws", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    inside = counts.where(size >= 3).select("lang", F.col("f").alias("longer"), "ws", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inside = inside.select("lang", "longer", "ws", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("i"))
    inside = inside.groupBy("lang", F.slice("ws", F.col("i"), F.col("m")).alias("ws")).agg(F.max("longer").alias("longer"))
    left = weakest.join(inside, ["lang", "ws"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))

    flat = left.select("lang", "ws", "a", "c.score", "c.l", "c.r")
    salt = F.pmod(F.xxhash64("ws"), F.lit(SALTS))
    by = [F.desc("score"), F.desc("a")]
    # Equal scores and counts are kept together here; the spelling decides between them below.
    near = flat.withColumn("id", F.rank().over(Window.partitionBy("lang", salt).orderBy(*by))).where(F.col("id") <= top)
    near = materialize(near.withColumn("id", F.monotonically_increasing_id()), "near")
    spelled = attach(near.select("id", F.posexplode("ws").alias("at", "code")), words, ["code"], "inner", stored=True)
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    near = near.join(spelled.groupBy("id").agg(phrase.alias("phrase")), "id")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*by, F.asc("phrase"))).cast("long")
    ranked = near.withColumn("rank", place).where(F.col("rank") <= top)
    totals = counts.where(size == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
