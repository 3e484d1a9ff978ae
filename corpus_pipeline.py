"""A training-data pipeline over ``documents``: five stages, each stored as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``; the last adds the piece ids of the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import decontaminate, pieces, ppm, substrings, tensor_minhash
from ladle.operators.ordering import row_positions
from ladle.session import materialize, measured_bytes

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Share of the likeliest language below which a text is rejected.
LEAST_SHARE = 0.5
BROADCAST_BYTES = 8 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or that no language claims, go. Where no language could be learned, only those without a letter go."""
    model = ppm.fit(docs.where(~ppm.held_out()))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = ppm.identify(docs, model, keep=tuple(docs.columns))
    return told.where((F.col("lang_pred") != ppm.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select(*docs.columns)


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``__id``: doc_id, or where several texts share a doc_id a number of its own for each, above all doc_ids."""
    text = F.xxhash64("text")
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", text.alias("__text")).distinct()
    shared = materialize(texts.groupBy("doc_id").count().where("count > 1").select("doc_id"), "shared")
    if shared.isEmpty():
        return docs.withColumn("__id", F.col("doc_id"))
    last = docs.agg(F.max("doc_id")).first()[0]
    own = row_positions(texts.join(shared, "doc_id", "left_semi"), ["doc_id", "__text"], name="__n")
    own = materialize(own.select("doc_id", "__text", (F.col("__n") + F.lit(last)).alias("__own")), "own")
    if measured_bytes(own) <= BROADCAST_BYTES:
        own = F.broadcast(own)
    named = docs.withColumn("__text", text).join(own, ["doc_id", "__text"], "left")
    return named.select(*docs.columns, F.coalesce("__own", "doc_id").alias("__id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays. Rows without doc_id stay. A row that repeats a doc_id with
    another text is a document of its own, after all others; rows that repeat doc_id and text stay or go together."""
    known = _told_apart(docs)
    gone = tensor_minhash.near_duplicates(known, key="__id").where("NOT kept").select(F.col("doc_id").alias("__id"))
    gone = materialize(gone.distinct(), "copies")
    if measured_bytes(gone) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    return known.join(gone, "__id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out. Texts that lose nothing stay as they were; a text that loses every
    word goes. Rows that share a doc_id take nothing from each other, and rows without one neither give nor lose."""
    cut = substrings.remove_repeats(docs, keep=tuple(c for c in docs.columns if c != "text")).where("n_removed = 0 OR n_removed < n_words")
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    new = {"text": text.alias("text"), "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars")}
    return cut.select(*[new[c] if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that copy a benchmark item, edited or not, go. Each row is judged by its text alone."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, in a column ``ids`` (a column of that name is replaced). Each row is encoded, repeated ids or not."""
    return pieces.encode(docs, PIECES)


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_copies),
    ("SentencePiece encoding", encoding),
]

#: Language ID, alignment and Viterbi are not SQL; tests/llm/test_pipeline.py checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
