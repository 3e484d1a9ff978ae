"""Registered queries of this package and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import collocations, decontaminate, mixing, packing, pieces, placement, ppm, prefix_trie, revisits, rules, substrings, tensor_minhash, token_store
from ladle.llm.common import table
from ladle.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLES["op2_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS f FROM win) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM dup),
kept AS (SELECT t.doc_id, string_agg(x, ' ' ORDER BY t.p) AS s
         FROM (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w) t
         ANTI JOIN gone g ON t.doc_id = g.doc_id AND t.p = g.p GROUP BY 1),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.s, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id LEFT JOIN cut c ON w.doc_id = c.doc_id
"""


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensor_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("n_links")


ORACLES["op10_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
sz AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
inter AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM inter JOIN sz p ON p.doc_id = a JOIN sz q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.r = edge.a),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(sz.n, 0)::BIGINT AS n_shingles, comp.component_id, w.doc_id = comp.component_id AS kept
FROM w JOIN comp ON w.doc_id = comp.doc_id LEFT JOIN sz ON w.doc_id = sz.doc_id
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.detect(table(spark, sf_dir, "documents"))


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), PIECES)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_store.read_back(token_store.write_store(docs, BYTE_BPE), docs.select("doc_id"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


SHARDS = [f"shard-{i:03d}" for i in range(64)]


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written to their shards and read back."""
    path = scratch_path(spark, "placed")
    placement.write_placed(table(spark, sf_dir, "documents").select("doc_id", "text"), path, SHARDS, spread=["text"])
    return placement.read_placed(spark, path, "doc_id long, text string").select("doc_id", "slot", "shard", F.md5("text").alias("text_md5"))


ORACLES["op8_sharding"] = f"""
SELECT doc_id, slot::INTEGER AS slot, shard, text_md5
FROM (SELECT doc_id, md5(text) AS text_md5, (('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % {placement.SIZE}) AS slot FROM documents)
JOIN (SELECT unnest(range({placement.SIZE})) AS slot, printf('shard-%03d', unnest([{", ".join(map(str, placement.fill(SHARDS)))}]::INTEGER[])) AS shard) USING (slot)
"""


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def archive(pages: DataFrame) -> DataFrame:
    """Archive records of the pages: each page is fetched five times. Fetches 0 and 3 are full; 1, 2 and 4 ask whether it changed.
    The hash of the page's own row decides what a revisit says: mostly the ETag of the last full fetch, sometimes weak, sometimes
    another one, sometimes only Last-Modified, sometimes nothing."""
    base = pages.select("page_id", "url", F.md5("html").alias("h"), F.octet_length("html").alias("size"), F.explode(F.array(*[F.lit(i) for i in range(5)])).alias("k"))
    full = F.col("k").isin(0, 3)
    version = F.when(F.col("k") >= 3, 3).otherwise(0)
    digit = F.conv(F.substring("h", F.col("k") + 1, 1), 16, 10).cast("int")
    tag = F.concat(F.lit('"'), F.substring("h", 1, 12), version.cast("string"), F.lit('"'))
    sent = F.when(full | (digit <= 8), tag).when(digit <= 10, F.concat(F.lit("W/"), tag)).when(digit <= 12, F.lit('"other"'))
    modified = F.when(full | (digit >= 13) & (digit <= 14), F.concat(F.lit("v"), version.cast("string")))
    pairs = {
        "content-type": F.when(full, F.lit("text/html")), "content-length": F.when(full, F.col("size").cast("string")).otherwise("0"),
        "etag": sent, "last-modified": modified, "date": F.concat(F.lit("t"), F.col("k").cast("string")),
        "cache-control": F.concat(F.lit("max-age="), (digit * 10).cast("string")), "x-cache": F.when(full, F.lit("miss")).otherwise("hit"),
    }
    headers = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(n).alias("k"), v.alias("v")) for n, v in pairs.items()]), lambda x: x["v"].isNotNull()))
    return base.select(
        (F.col("page_id") * 5 + F.col("k")).alias("record_id"), "url", (F.col("page_id") % 1000 + F.col("k") * 700).alias("date"),
        F.when(full, 200).otherwise(304).alias("status"), headers.alias("headers"),
    )


@query
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = revisits.resolve(archive(table(spark, sf_dir, "pages")))
    names = {"etag": "etag", "modified": "last-modified", "dated": "date", "cache": "cache-control", "length": "content-length", "x_cache": "x-cache"}
    return done.select("record_id", "url_key", "outcome", "response_id", *[F.element_at("headers", h).alias(c) for c, h in names.items()], F.size("headers").cast("long").alias("n_headers"))


ORACLES["op1_warc_revisits"] = r"""
WITH base AS (
  SELECT page_id, url, md5(html) AS h, strlen(html) AS size, k, k IN (0, 3) AS whole, CASE WHEN k >= 3 THEN '3' ELSE '0' END AS ver,
         ('0x' || substr(md5(html), k + 1, 1))::INTEGER AS d
  FROM pages, (SELECT unnest(range(5)) AS k)),
rec AS (
  SELECT page_id * 5 + k AS record_id, page_id % 1000 + k * 700 AS ts, whole, d, k, size, ver,
         regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^(?i:https?)://([^/?#]*)([^?]*)(?:\?(.*))?$', ['host', 'path', 'query']) AS u,
         '"' || substr(h, 1, 12) || ver || '"' AS tag
  FROM base),
keyed AS (
  SELECT *, CASE WHEN whole OR d <= 8 THEN tag WHEN d <= 10 THEN 'W/' || tag WHEN d <= 12 THEN '"other"' END AS etag,
         CASE WHEN whole OR d BETWEEN 13 AND 14 THEN 'v' || ver END AS modified,
         regexp_replace(regexp_replace(regexp_replace(lower(u.host), '^[^@]*@', ''), ':(80|443)?$', ''), '^www\.', '') AS host,
         regexp_replace(u.path, '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(u.query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^utm_[^=&]*(=|$)'))), '&') AS q
  FROM rec),
named AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS url_key FROM keyed),
found AS (
  SELECT *, last_value(CASE WHEN whole THEN {'id': record_id, 'etag': etag, 'modified': modified, 'size': size} END IGNORE NULLS)
         OVER (PARTITION BY url_key ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
  FROM named),
told AS (
  SELECT *, CASE WHEN r IS NULL THEN 'missing' WHEN etag IS NULL AND modified IS NULL THEN 'unvalidated'
                 WHEN etag IS NOT NULL AND regexp_replace(etag, '^W/', '') = r.etag THEN 'resolved'
                 WHEN etag IS NULL AND modified = r.modified THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM found WHERE NOT whole)
SELECT record_id, url_key, outcome, r.id AS response_id, CASE WHEN ok THEN coalesce(etag, r.etag) END AS etag,
       CASE WHEN ok THEN coalesce(modified, r.modified) END AS modified, CASE WHEN ok THEN 't' || k END AS dated,
       CASE WHEN ok THEN 'max-age=' || (d * 10) END AS cache, CASE WHEN ok THEN r.size::VARCHAR END AS length, CASE WHEN ok THEN 'miss' END AS x_cache,
       CASE WHEN ok THEN 7 ELSE NULL END::BIGINT AS n_headers
FROM (SELECT *, outcome = 'resolved' AS ok FROM told)
"""


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_phrase_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
cand AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10),
cut AS (SELECT lang, phrase, a, c, array_to_string(ws[1:c], ' ') AS x, array_to_string(ws[c + 1:k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
scored AS (SELECT cut.lang, cut.phrase, a, c, p.f AS l, q.f AS r, (1000000::HUGEINT * a * a) // (p.f::HUGEINT * q.f) AS score
           FROM cut JOIN f p ON p.lang = cut.lang AND p.phrase = x JOIN f q ON q.lang = cut.lang AND q.phrase = y),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand WHERE k > 2)) GROUP BY 1, 2),
kept AS (SELECT weakest.* FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


ORACLES["op12_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn,
         md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, digest) AS ts FROM t GROUP BY 1),
lead AS (
  SELECT conv_id, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
         lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 AS h
  FROM own),
built AS (SELECT c.conv_id, list_concat(coalesce(d.ts, [])[1:c.h], c.ts[c.h + 1:len(c.ts)]) AS s FROM lead c LEFT JOIN own d ON d.conv_id = c.conv_id - c.conv_id % 5),
member AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM built),
node AS (
  SELECT s[1:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(s) = depth) AS ends
  FROM member GROUP BY 1, 2),
child AS (SELECT k[1:depth - 1] AS k, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (
  SELECT node.*, coalesce(child.n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(k[depth].t) END AS saved FROM node LEFT JOIN child USING (k)),
below AS (
  SELECT k[1:j] AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT k, n_children, saved, unnest(range(0, depth + 1)) AS j FROM full_node) GROUP BY 1)
SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM full_node x JOIN below ON below.k = x.k LEFT JOIN node p ON x.depth > 0 AND p.depth = x.depth - 1 AND p.k = x.k[1:x.depth - 1]
"""


@query
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), WORD_BPE)
