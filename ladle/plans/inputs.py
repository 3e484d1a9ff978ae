"""Logical inputs over the given tables, for Spark and (as SQL texts) for the check engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.flags import binary_label


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated items: line items with their part's group. ``id`` is unique over the four key columns."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        (F.col("l_quantity") / 10.0).alias("rating"),
        binary_label(F.col("l_quantity") / 10.0).alias("label"),
        F.concat(F.lit("/"), "p_type", F.lit("/"), "p_brand", F.lit("/")).alias("grp"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_discount").alias("discount"),
    )


RATINGS_SQL = """ratings AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         l_quantity / 10.0::DOUBLE AS rating,
         CASE WHEN l_quantity / 10.0::DOUBLE >= 4 THEN 1 ELSE 0 END AS label,
         '/' || p_type || '/' || p_brand || '/' AS grp,
         l_extendedprice AS score, l_discount AS discount
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item table over the documents: names repeat where texts do."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("recipe_id"),
        F.md5("text").alias("recipe_name"),
        F.concat(F.lit("http://example.org/"), "lang").alias("url"),
        F.col("text").alias("ingredients"),
        F.concat(F.lit("/"), "lang", F.lit("/"), "source", F.lit("/")).alias("cuisine_path"),
    )


ITEMS_SQL = """items AS (
  SELECT doc_id AS recipe_id, md5(text) AS recipe_name, 'http://example.org/' || lang AS url,
         text AS ingredients, '/' || lang || '/' || source || '/' AS cuisine_path
  FROM documents)"""


def labelled_text(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select("doc_id", "text", F.col("quality").alias("label"), *more)


LABELLED_SQL = """labelled AS (
  SELECT doc_id, text, quality AS label FROM documents JOIN labels USING (doc_id))"""


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(kind == 0, F.concat(size, F.lit(" mins")))
        .when(kind == 1, F.concat(F.lit("1 hr "), size, F.lit(" mins")))
        .when(kind == 2, F.lit("2 hrs"))
        .when(kind == 3, size)
        .when(kind == 4, F.lit("overnight, ideally"))
        .alias("duration"),
    )


DURATIONS_SQL = """durations AS (
  SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_size || ' mins' WHEN 1 THEN '1 hr ' || p_size || ' mins'
         WHEN 2 THEN '2 hrs' WHEN 3 THEN p_size::VARCHAR WHEN 4 THEN 'overnight, ideally' END AS duration
  FROM part)"""

# Keyword groups that occur in the part names.
NAME_GROUPS = {"tool": ["gear", "bolt", "anvil"], "shape": ["plate", "ring", "rod"], "tint": ["red", "blue"]}


def candidates(spark: SparkSession, sf_dir: str, part: DataFrame | None = None) -> DataFrame:
    """Candidate sets: parts in twenty requests, with missing calories and times; ``part`` may be a stream of them."""
    key = F.col("p_partkey")
    return (table(spark, sf_dir, "part") if part is None else part).select(
        key.alias("pos"),
        (key % 20).alias("request_id"),
        F.concat(F.lit("c"), key.cast("string")).alias("recipe_id"),
        F.col("p_name").alias("title"),
        F.col("p_name").alias("ingredients_parsed"),
        F.when(key % 7 != 0, F.col("p_size").cast("double")).alias("cook_time_minutes"),
        F.when(key % 10 != 0, F.col("p_retailprice")).alias("calories"),
        F.array(F.lower("p_type")).alias("dietary_tags"),
        F.when(key % 5 == 0, F.array(F.concat(F.lit(" "), F.upper(F.split("p_name", " ")[0]), F.lit(" "))))
        .otherwise(F.array().cast("array<string>")).alias("excluded_ingredients_present"),
    )


CANDIDATES_SQL = """candidates AS (
  SELECT p_partkey AS pos, p_partkey % 20 AS request_id, 'c' || p_partkey AS recipe_id, p_name AS title,
         p_name AS ingredients_parsed,
         CASE WHEN p_partkey % 7 <> 0 THEN p_size::DOUBLE END AS cook_time_minutes,
         CASE WHEN p_partkey % 10 <> 0 THEN p_retailprice END AS calories,
         [lower(p_type)] AS dietary_tags,
         CASE WHEN p_partkey % 5 = 0 THEN [' ' || upper(split_part(p_name, ' ', 1)) || ' ']
              ELSE []::VARCHAR[] END AS excluded_ingredients_present
  FROM part)"""


def request_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One constraint row per request; every fourth request has none."""
    r = F.col("request_id")
    ids = table(spark, sf_dir, "part").select((F.col("p_partkey") % 20).alias("request_id")).distinct()
    none = F.array().cast("array<string>")
    return ids.where(r % 4 != 3).select(
        "request_id",
        F.when(r % 4 == 0, F.lit(990.0)).alias("max_calories"),
        F.when(r % 4 <= 1, F.lit(40.0)).alias("max_cook_time_minutes"),
        F.when(r % 8 == 2, F.array(F.lit("economy"))).otherwise(none).alias("required_dietary_tags"),
        F.when(r % 4 == 1, F.array(F.lit(" RED "), F.lit("anvil"), F.lit(" "))).otherwise(none)
        .alias("excluded_ingredients"),
    )


CONSTRAINTS_SQL = """constraints AS (
  SELECT r AS request_id, CASE WHEN r % 4 = 0 THEN 990.0::DOUBLE END AS max_calories,
         CASE WHEN r % 4 <= 1 THEN 40.0::DOUBLE END AS max_cook_time_minutes,
         CASE WHEN r % 8 = 2 THEN ['economy'] ELSE []::VARCHAR[] END AS required_dietary_tags,
         CASE WHEN r % 4 = 1 THEN ['red', 'anvil'] ELSE []::VARCHAR[] END AS excluded_ingredients
  FROM (SELECT DISTINCT p_partkey % 20 AS r FROM part) WHERE r % 4 <> 3)"""


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.lit("GET").alias("method"),
        F.concat(F.lit("/"), "event_type").alias("path"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.col("value").alias("latency_ms"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


REQUEST_LOG_SQL = """request_log AS (
  SELECT event_id, 'GET' AS method, '/' || event_type AS path,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code, value AS latency_ms, ts
  FROM events)"""


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring batch over the parts, with plausible values and some NULLs."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("test_"), key.cast("string")).alias("recipe_id"),
        F.col("p_name").alias("ingredients_parsed"),
        F.when(key % 25 != 0, F.col("p_size").cast("double")).alias("cook_time_minutes"),
        F.when(key % 20 != 0, F.col("p_retailprice")).alias("calories"),
    )


BATCH_SQL = """batch AS (
  SELECT 'test_' || p_partkey AS recipe_id, p_name AS ingredients_parsed,
         CASE WHEN p_partkey % 25 <> 0 THEN p_size::DOUBLE END AS cook_time_minutes,
         CASE WHEN p_partkey % 20 <> 0 THEN p_retailprice END AS calories
  FROM part)"""


def drift_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference (before mid January) and current half of the events."""
    ev = table(spark, sf_dir, "events").select(
        "value", (F.col("event_id") % 97).cast("double").alias("spread"), F.col("ts").cast("timestamp").alias("ts")
    )
    cut = F.lit("2024-01-16").cast("timestamp")
    return ev.where(F.col("ts") < cut).drop("ts"), ev.where(F.col("ts") >= cut).drop("ts")


DRIFT_SQL = """sides AS (
  SELECT ts >= TIMESTAMP '2024-01-16' AS cur, unnest(['value', 'spread']) AS col,
         unnest([value, (event_id % 97)::DOUBLE]) AS v FROM events)"""
