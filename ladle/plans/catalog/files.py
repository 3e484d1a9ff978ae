"""Files and the whole pipeline: what is written is read back with the library's own readers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ladle.operators import estimators, popularity, quality, sampling
from ladle.plans import inputs, pipeline
from ladle.plans.catalog.ranking import SPLIT_CTE
from ladle.plans.catalog.registry import query, rounded
from ladle.plans.inputs import ITEMS_SQL, RATINGS_SQL
from ladle.session import scratch_path
from ladle.sources import readers, writers


@query("csv_roundtrip", "SELECT doc_id::VARCHAR AS doc_id, md5(text) AS digest, lang FROM documents")
def csv_roundtrip(spark, sf):
    """Texts with quotes and line breaks through CSV."""
    path = scratch_path(spark, "csv")
    writers.write_csv(inputs.table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return readers.read_csv(spark, path).select("doc_id", F.md5("text").alias("digest"), "lang")


@query("split_table", "SELECT id, label FROM parts WHERE split = 'val'", (RATINGS_SQL, SPLIT_CTE))
def split_table(spark, sf):
    """One split read from the table partitioned by split."""
    path = scratch_path(spark, "splits")
    split = sampling.stratified_split(inputs.ratings(spark, sf).select("id", "label"), "label", "id")
    writers.write_split(split, path)
    return spark.read.parquet(path).where("split = 'val'").select("id", "label")


@query("uploaded_candidates", """
SELECT p_partkey + 1 AS pos, CASE WHEN p_partkey % 2 = 0 THEN 'c' || p_partkey ELSE 'r_' || (p_partkey + 1) END AS recipe_id,
       CASE WHEN p_partkey % 3 = 0 THEN 'Recipe #' || (p_partkey + 1) ELSE p_name END AS title, p_name AS ingredients,
       lower(p_type) || ',' || lower(p_brand) AS tags FROM part""")
def uploaded_candidates(spark, sf):
    """A candidate file with missing ids and titles, in the order of its rows."""
    key = F.col("p_partkey")
    path = scratch_path(spark, "upload")
    rows = inputs.table(spark, sf, "part").select(
        key.alias("row"), F.when(key % 2 == 0, F.concat(F.lit("c"), key.cast("string"))).alias("id"),
        F.when(key % 3 != 0, F.col("p_name")).alias("recipe_name"), F.col("p_name").alias("ingredients_parsed"),
        F.concat(F.lower("p_type"), F.lit(" , "), F.lower("p_brand"), F.lit(",")).alias("dietary_tags"))
    writers.write_csv(rows, path)
    raw = readers.read_csv(spark, path).withColumn("row", F.col("row").cast("bigint"))
    out = readers.normalize_candidates(raw, "row")
    return out.select("pos", "recipe_id", "title", "ingredients", F.array_join("dietary_tags", ",").alias("tags"))


@query("stored_popularity", """
SELECT doc_id, round(coalesce(m, g), 8) AS score FROM documents
LEFT JOIN (SELECT source, avg(n_chars) AS m FROM documents WHERE lang <> 'en' GROUP BY source) USING (source),
  (SELECT avg(n_chars) AS g FROM documents WHERE lang <> 'en')""")
def stored_popularity(spark, sf):
    """Group means fitted, stored, loaded again and applied."""
    path = scratch_path(spark, "model")
    docs = inputs.table(spark, sf, "documents").select("doc_id", "source", "lang", F.col("n_chars").cast("double").alias("v"))
    popularity.fit_popularity(docs.where("lang <> 'en'"), "source", "v").save(path)
    model = popularity.PopularityModel.load(spark, path)
    return rounded(model.score(docs.select("doc_id", "source")), "score").select("doc_id", "score")


PREPARED = """firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY recipe_name, url ORDER BY recipe_id) AS rn FROM items) WHERE rn = 1),
rated AS (
  SELECT recipe_id, cuisine_path, ingredients, (recipe_id % 51) / 10.0::DOUBLE AS rating,
         CASE WHEN (recipe_id % 51) / 10.0::DOUBLE >= 4 THEN 1 ELSE 0 END AS label FROM firsts),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY label) AS total, round(count(*) OVER (PARTITION BY label) * (1.0::DOUBLE - 0.7::DOUBLE - 0.15::DOUBLE)) AS n_test,
         row_number() OVER (PARTITION BY label ORDER BY md5('42:' || recipe_id), recipe_id) AS r FROM rated),
assigned AS (
  SELECT *, CASE WHEN r <= n_test THEN 'test'
                 WHEN r <= n_test + round((total - n_test) * (0.15::DOUBLE / (0.7::DOUBLE + 0.15::DOUBLE))) THEN 'val' ELSE 'train' END AS split FROM ranked),
stats AS (SELECT cuisine_path, avg(rating) AS m, stddev_samp(rating) AS s FROM assigned WHERE split = 'train' GROUP BY cuisine_path)"""


@query("prepared_features", """
SELECT recipe_id, label, split, (recipe_id % 90)::DOUBLE AS total_time_minutes,
  CASE WHEN recipe_id % 90 >= 60 THEN '1_2h' WHEN recipe_id % 90 >= 30 THEN '30_60m' WHEN recipe_id % 90 >= 15 THEN '15_30m' ELSE 'under_15m' END AS total_time_bucket,
  round(CASE WHEN s <> 0 THEN (rating - m) / s ELSE rating - coalesce(m, (SELECT avg(m) FROM stats)) END, 8) AS zscore,
  round((rank() OVER (PARTITION BY split, cuisine_path ORDER BY rating) + (count(*) OVER (PARTITION BY split, cuisine_path, rating) - 1) / 2.0::DOUBLE)
    / count(*) OVER (PARTITION BY split, cuisine_path), 8) AS rank_pct, (contains(lower(ingredients), 'egg'))::INTEGER AS has_egg
FROM assigned LEFT JOIN stats USING (cuisine_path)""", (ITEMS_SQL, PREPARED))
def prepared_features(spark, sf):
    """The whole pipeline over documents as items: validate, gate, dedupe, label, split, clean, features."""
    n = F.col("recipe_id")
    minutes = F.concat((n % 90).cast("string"), F.lit(" mins"))
    items = inputs.items(spark, sf).select(
        "recipe_id", "recipe_name", "url", "ingredients", "cuisine_path", F.col("ingredients").alias("directions"),
        ((n % 51) / 10.0).alias("rating"), (n % 6 + 1).alias("servings"), F.lit("10 mins").alias("prep_time"),
        F.lit("20 mins").alias("cook_time"), minutes.alias("total_time"), F.lit(None).cast("string").alias("yield"),
        F.concat(F.lit('{"Fat": "'), (n % 9).cast("string"), F.lit('g"}')).alias("nutrition"),
        F.lit("t").alias("timing"), F.lit(None).cast("string").alias("img_src"))
    done = pipeline.prepare(items, "recipe_id").features
    return rounded(done.select(
        "recipe_id", "label", "split", "total_time_minutes", "total_time_bucket",
        F.col("popularity_zscore_within_cuisine").alias("zscore"),
        F.col("popularity_rank_pct_within_cuisine").alias("rank_pct"), "has_egg"), "zscore", "rank_pct")


@query("stored_pipeline", """
WITH s AS (
  SELECT doc_id, source, n_chars, count(DISTINCT w) AS n_terms, coalesce(any_value(m), any_value(g)) AS score
  FROM (SELECT doc_id, source, n_chars, unnest(list_concat([NULL], regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'))) AS w FROM documents)
  LEFT JOIN (SELECT source, avg(n_chars) AS m FROM documents WHERE lang <> 'en' GROUP BY source) USING (source),
    (SELECT avg(n_chars) AS g FROM documents WHERE lang <> 'en')
  GROUP BY doc_id, source, n_chars)
SELECT doc_id, round(score, 6) AS score, n_terms,
       round(0.5::DOUBLE * (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE) / count(*) OVER ()
       + 0.5::DOUBLE * (rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE) / count(*) OVER (), 8) AS blend
FROM s""")
def stored_pipeline(spark, sf):
    """A pipeline of all four stages, fitted, saved, loaded as a plain pipeline model and applied."""
    docs = inputs.table(spark, sf, "documents").select("doc_id", "source", "lang", "text", F.col("n_chars").cast("double").alias("v"), F.col("n_chars").cast("double").alias("size"))
    stages = [
        estimators.PopularityRanker("source", "v", "score"), estimators.TfidfVectorizer("doc_id", "text", "terms", min_df=1),
        estimators.StructuredEncoder(["size"], ["lang"]), estimators.RankBlend({"score": 0.5, "v": 0.5}, "blend"),
    ]
    path = scratch_path(spark, "pipeline")
    fitted = Pipeline(stages=stages).fit(docs)
    popular = Pipeline(stages=stages[:1]).fit(docs.where("lang <> 'en'"))
    writers.save_pipeline(PipelineModel(stages=[popular.stages[0], *fitted.stages[1:]]), path)
    out = writers.load_pipeline(path).transform(docs)
    n = F.size(F.unwrap_udt("terms")["indices"]).cast("bigint")
    return rounded(rounded(out.select("doc_id", "score", n.alias("n_terms"), "blend"), "score", digits=6), "blend")


@query("landed_tables", """
SELECT 'part' AS name, count(*) AS row_count, 3 AS column_count, 'kept' AS second_run FROM part
UNION ALL SELECT 'nation', count(*), 2, 'kept' FROM nation
UNION ALL SELECT 'menu', 0, 0, 'missing'""")
def landed_tables(spark, sf):
    """Two CSV files landed as tables, a second landing that changes nothing but reports the missing file, and a summary of each."""
    src, dest = scratch_path(spark, "files"), scratch_path(spark, "landed")
    writers.write_csv(inputs.table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), f"{src}/part.csv")
    writers.write_csv(inputs.table(spark, sf, "nation").select("n_nationkey", "n_name"), f"{src}/nation.csv")
    names = ["part.csv", "nation.csv"]
    first = writers.land_dataset(spark, src, dest, names)
    again = writers.land_dataset(spark, src, dest, names)
    more = writers.land_dataset(spark, src, dest, ["menu.csv"])
    out = spark.createDataFrame([(n.removesuffix(".csv"), 0, 0, "missing") for n in more["missing"]], "name string, row_count long, column_count int, second_run string")
    for n in first["landed"]:
        name = n.removesuffix(".csv")
        landed = writers.table_summary(spark.read.parquet(f"{dest}/{name}"), name)
        out = out.union(landed.withColumn("second_run", F.lit("kept" if n in again["kept"] else "landed")))
    return out


@query("report_roundtrip", """
SELECT event_id, 'value' AS "column", 'in_range(0, 40)' AS "check", round(value, 6) AS failure_case FROM events WHERE value NOT BETWEEN 0 AND 40""")
def report_roundtrip(spark, sf):
    """A findings report written as JSON and read again."""
    path = scratch_path(spark, "report")
    events = inputs.table(spark, sf, "events")
    found = events.where("value NOT BETWEEN 0 AND 40").select("event_id", F.lit("value").alias("column"), F.lit("in_range(0, 40)").alias("check"), F.col("value").alias("failure_case"))
    writers.write_report(found, path)
    return rounded(spark.read.schema(found.schema).json(path), "failure_case", digits=6)


@query("prediction_table", "SELECT label, round(score, 6) AS score, grp FROM ratings", (RATINGS_SQL,))
def prediction_table(spark, sf):
    """Predictions with their group through the sink."""
    path = scratch_path(spark, "predictions")
    writers.write_predictions(inputs.ratings(spark, sf), path, group="grp")
    return rounded(spark.read.parquet(path), "score", digits=6)


@query("gate_verdicts", """
SELECT 'items' AS name, count(*) > 0 AS refused FROM documents WHERE doc_id IS NULL OR lang = 'de'
UNION ALL SELECT 'warned', false""")
def gate_verdicts(spark, sf):
    """Which table the gate refuses: critical findings refuse, the same findings as warnings do not."""
    docs = inputs.table(spark, sf, "documents")
    found = docs.where("doc_id IS NULL OR lang = 'de'").select(
        F.lit("lang").alias("column"), F.lit("isin").alias("check"), F.col("lang").alias("failure_case"), F.col("doc_id").cast("string").alias("row_id"))
    verdicts = []
    for name, gating in (("items", True), ("warned", False)):
        try:
            quality.require_passed(quality.gate(found, gating))
            verdicts.append((name, False))
        except quality.GateFailed:
            verdicts.append((name, True))
    return spark.createDataFrame(verdicts, "name string, refused boolean")


@query("uploaded_json", """
SELECT p_partkey AS pos_key, 'c' || p_partkey AS recipe_id, p_name AS title, lower(p_type) AS tags FROM part""")
def uploaded_json(spark, sf):
    """Candidates uploaded as several JSON files, each an object with a list of them: every row once, with places of its own."""
    path = scratch_path(spark, "uploads")
    parts = inputs.table(spark, sf, "part").select(
        F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("recipe_id"), F.col("p_name").alias("title"), F.col("p_name").alias("ingredients_parsed"),
        F.array(F.lower("p_type")).alias("dietary_tags"), (F.col("p_partkey") % 37).alias("upload"))
    files = parts.groupBy("upload").agg(F.collect_list(F.struct("recipe_id", "title", "ingredients_parsed", "dietary_tags")).alias("candidates"))
    files.select(F.to_json(F.struct("candidates")).alias("value"), "upload").write.partitionBy("upload").option("compression", "none").text(path)
    out = readers.read_candidates(spark, path, json=True)
    if out.select("pos").distinct().count() != out.count():
        raise ValueError("two rows share a place")
    return out.select(F.substring("recipe_id", 2, 20).cast("bigint").alias("pos_key"), "recipe_id", "title", F.array_join("dietary_tags", ",").alias("tags"))
