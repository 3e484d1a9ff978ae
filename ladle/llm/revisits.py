"""Not-modified revisits of a web archive, resolved to the full response they refer to.

A revisit (status 304) takes its body from the latest earlier full response (status 200) of the same canonical URL. This is an as-of
join. Records are range-partitioned by URL, date and record id, so a URL that holds a third of all records lies in as many
partitions as its share asks for. Each part of a URL is walked by itself, the last response of the parts before is carried in from a table
with one row a URL and part, and no task ever needs a whole URL.

The found response counts if its validators agree: the revisit's ETag (weak comparison) or, without one, its Last-Modified
must equal the response's. The headers of a resolved revisit are those of the response, with those replaced that a 304 may update.

Outcomes: ``resolved``; ``mismatch`` (validators differ, or the response lacks the one asked for); ``unvalidated`` (the revisit names no
validator); ``missing`` (no earlier full response). Cases: a null or unusable URL matches nothing (``missing``). Records with equal
date are ordered by record id, which is unique. A null date sorts
first. Null headers are an empty map. Repeated rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.common import width
from ladle.session import materialize

#: Header fields a 304 response may update (fixed values of the HTTP standard), in lower case.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "utm_[^=&]*"
PART_BYTES = 16 << 20


def canonical(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without trailing slashes, query sorted and without tracking
    parameters; no scheme, no fragment. Null for what is not an http(s) URL."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    part = lambda i: F.regexp_extract(bare, r"^(?i:https?)://([^/?#]*)([^?]*)(?:\?(.*))?$", i)
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(part(1)), "^[^@]*@", ""), r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(part(2), "/+$", "")
    fields = F.sort_array(F.filter(F.split(part(3), "&"), lambda x: (x != "") & ~x.rlike(f"^{TRACKING}(=|$)")))
    query = F.array_join(fields, "&")
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def merged(response: Column, revisit: Column) -> Column:
    """The response's headers with the permitted ones of the revisit over them."""
    own = F.map_filter(revisit, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    rest = F.map_filter(response, lambda k, v: ~F.array_contains(F.map_keys(own), k))
    return F.map_concat(rest, own)


def resolve(records: DataFrame) -> DataFrame:
    """Per revisit: record_id, url_key, outcome, response_id, headers (null unless resolved).

    ``records``: record_id, url, date, status, headers (map of lower-case names to values).
    """
    none = F.create_map().cast("map<string,string>")
    rows = records.where(F.col("status").isin(200, 304)).select(
        "record_id", canonical(F.col("url")).alias("url_key"), F.col("date").alias("at"), (F.col("status") == 200).alias("full"),
        F.coalesce("headers", none).alias("headers"),
    )
    lost = rows.where("url_key IS NULL AND NOT full")
    rows = rows.where("url_key IS NOT NULL")
    dealt = rows.repartitionByRange(width(records, PART_BYTES), "url_key", "at", "record_id").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "records")

    response = F.when(F.col("full"), F.struct("record_id", "headers", "at"))
    line = Window.partitionBy("part", "url_key").orderBy("at", "record_id")
    near = dealt.select("*", F.last(response, ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("near")).where("NOT full")
    tails = dealt.where("full").groupBy("url_key", "part").agg(F.max_by(F.struct("record_id", "headers", "at"), F.struct("at", "record_id")).alias("tail"))
    # One row for every part of a URL that holds a revisit, with the last response of the parts before it.
    parts = near.select("url_key", "part").distinct().withColumn("tail", F.lit(None).cast(tails.schema["tail"].dataType)).withColumn("asks", F.lit(True))
    # Within a part the ask stands first, so that its own tail is not before it.
    chain = Window.partitionBy("url_key").orderBy("part", F.desc("asks")).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumn("asks", F.lit(False)).unionByName(parts)
    carried = carried.select("url_key", "part", "asks", F.last("tail", ignorenulls=True).over(chain).alias("far")).where("asks AND far IS NOT NULL").drop("asks")
    both = near.join(carried, ["url_key", "part"], "left").withColumn("r", F.coalesce("near", "far"))

    asked = F.when(F.element_at("headers", "etag").isNotNull(), "etag").when(F.element_at("headers", "last-modified").isNotNull(), "last-modified")
    mine, theirs = F.element_at("headers", F.col("asked")), F.element_at("r.headers", F.col("asked"))
    agree = F.coalesce(F.when(F.col("asked") == "etag", _weak(mine) == _weak(theirs)).otherwise(mine == theirs), F.lit(False))
    outcome = F.when(F.col("r").isNull(), "missing").when(F.col("asked").isNull(), "unvalidated").when(agree, "resolved").otherwise("mismatch")
    done = both.withColumn("asked", asked).withColumn("outcome", outcome).select(
        "record_id", "url_key", "outcome", F.col("r.record_id").alias("response_id"),
        F.when(F.col("outcome") == "resolved", merged(F.col("r.headers"), F.col("headers"))).alias("headers"),
    )
    empty = lost.select("record_id", "url_key", F.lit("missing").alias("outcome"), F.lit(None).cast(done.schema["response_id"].dataType).alias("response_id"), F.lit(None).cast("map<string,string>").alias("headers"))
    return done.union(empty)
