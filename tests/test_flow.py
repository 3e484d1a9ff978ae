"""Pipeline, files, drift, streams, text weights and fitted rankers on small fixtures."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from ladle.operators import drift, evaluation, quality, tfidf
from ladle.plans import pipeline, training, validation
from ladle.sources import readers, schemas, writers
from ladle.streaming import sinks, windows

CSV = '''recipe_name,prep_time,cook_time,total_time,servings,yield,ingredients,directions,rating,url,cuisine_path,nutrition,timing,img_src,extra
'''


def csv_rows(n=60):
    out = [CSV]
    for i in range(n):
        rating = 3.0 if i % 6 == 0 else 4.5
        fat = i % 7 + 1
        out.append(
            f'"Dish, {i // 2 if i < 4 else i}",10 mins,{"NA" if i % 5 == 0 else "1 hr 20 mins"},90,{i % 3 + 1},,'
            f'"flour\n2 eggs; Butter!!",Mix  and bake.,{rating},https://e.com/{i // 2 if i < 4 else i},/C{i % 2}/,'
            f'"{{""Fat"": ""{fat}g""}}",t,,x\n')
    return "".join(out)


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    src = tmp_path_factory.mktemp("src")
    (src / "recipes.csv").write_text(csv_rows())
    dest = str(tmp_path_factory.mktemp("dest"))
    return str(src), dest, writers.land_dataset(spark, str(src), dest, ["recipes.csv", "absent.csv"])


def test_landing_is_idempotent(spark, landed):
    src, dest, first = landed
    assert first == {"landed": ["recipes.csv"], "kept": [], "missing": ["absent.csv"]}
    assert writers.land_dataset(spark, src, dest, ["recipes.csv"])["kept"] == ["recipes.csv"]
    assert writers.land_dataset(spark, src, dest, ["recipes.csv"], force=True)["landed"] == ["recipes.csv"]
    assert writers.table_summary(spark.read.parquet(f"{dest}/recipes"), "recipes").first().row_count == 60


def test_pipeline(spark, landed, tmp_path):
    items = readers.read_items(spark, f"{landed[0]}/recipes.csv").withColumn("id", F.regexp_extract("url", r"(\d+)$", 1).cast("long"))
    items = items.withColumn("id", F.monotonically_increasing_id())
    done = pipeline.prepare(items, "id")
    df = done.features
    assert done.findings.count() == 0 and df.count() == 58 and done.nutrition_keys == ["Fat"]
    row = df.where("recipe_name = 'Dish, 10'").first()
    assert row.ingredients_parsed == ["flour", "2 eggs", "butter"] and row.ingredient_unique_word_count == 4
    assert row.cook_time_minutes is None and row.prep_time_minutes == 10.0 and row.total_time_bucket == "1_2h"
    assert row.has_egg == 1 and row.is_likely_vegan == 0 and row.nutrition_fat == 4.0
    assert row.prep_to_cook_ratio is None and row.popularity_zscore_within_cuisine is not None
    balance = {r.split: r for r in pipeline.split_manifest(df).collect()}
    assert sum(b.rows for b in balance.values()) == 58 and balance["val"].rows in (8, 9)
    assert pipeline.warnings(items).count() == 3  # yield, img_src, duplicates
    writers.write_split(df.drop("ingredients_parsed"), str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).where("split = 'val'").count() == balance["val"].rows
    writers.write_csv(df.select("id", "ingredients_parsed"), str(tmp_path / "c"), ["ingredients_parsed"])
    back = readers.read_list_column(readers.read_csv(spark, str(tmp_path / "c")), "ingredients_parsed")
    assert back.first().ingredients_parsed == ["flour", "2 eggs", "butter"]
    with pytest.raises(quality.GateFailed):
        pipeline.prepare(items.withColumn("rating", F.lit(9.0)), "id")


def test_reports(spark, tmp_path):
    found = spark.createDataFrame([("rating", "r", str(i), str(i)) for i in range(30)], quality.FINDING)
    lines = quality.report_lines(found.withColumnRenamed("column", "section"), "section", ["row_id"])
    assert lines.count() == 22
    writers.write_markdown(lines, str(tmp_path / "md"))
    text = [r.value for r in spark.read.text(str(tmp_path / "md")).collect()]
    assert "## rating" in text and "- Critical failures: 30" in text
    writers.write_report(found, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 30


@pytest.mark.parametrize("name,body", [
    ("a.csv", 'recipe_name,ingredients,calories,cook_time,dietary_tags\nSoup,"kale, salt",200,15,"vegan, keto"\n,,5,5,\n,beans,900,,\n'),
    ("b.json", json.dumps([{"title": "Soup", "ingredients": "kale, salt", "calories": 200, "cook_time_minutes": 15, "dietary_tags": ["vegan", "keto"]},
                           {"calories": 5}, {"ingredients": "beans", "calories": 900}])),
    ("c.json", json.dumps({"candidates": [{"title": "Soup", "ingredients_parsed": "kale, salt", "calories": 200, "cook_time": 15,
                                           "dietary_tags": ["vegan", "keto"]}, {"calories": 5}, {"ingredients": "beans"}]})),
])
def test_uploads(spark, tmp_path, name, body):
    (tmp_path / name).write_text(body)
    rows = readers.read_candidates(spark, str(tmp_path / name)).orderBy("pos").collect()
    assert [(r.recipe_id, r.title, r.ingredients) for r in rows] == [("r_1", "Soup", "kale, salt"), ("r_3", "Recipe #3", "beans")]
    assert rows[0].dietary_tags == ["vegan", "keto"] and rows[0].cook_time == "15" and rows[1].dietary_tags == []


def ks_brute(a, b):
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in [*a, *b])


def test_drift(spark):
    r = random.Random(5)
    ref, cur = [r.gauss(0, 1) for _ in range(300)], [round(r.gauss(0.4, 1), 1) for _ in range(200)]
    mk = lambda xs: spark.createDataFrame([(x,) for x in xs], "v double")
    row = drift.ks_drift(mk(cur), mk(ref), ["v"]).first()
    assert row.statistic == pytest.approx(ks_brute(cur, ref), abs=1e-12) and row.drifted
    x = math.sqrt(300 * 200 / 500) * row.statistic
    want = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    assert row.p_value == pytest.approx(want, abs=1e-12)
    same = drift.ks_drift(mk(ref), mk(ref), ["v"]).first()
    assert same.statistic == 0.0 and same.p_value == 1.0 and not same.drifted
    # area between both step functions, by sorted union
    xs = sorted(set(ref) | set(cur))
    area = sum(abs(sum(x <= a for x in ref) / 300 - sum(x <= a for x in cur) / 200) * (b - a) for a, b in zip(xs, xs[1:]))
    mean = sum(ref) / 300
    dev = math.sqrt(sum((x - mean) ** 2 for x in ref) / 300)
    assert drift.wasserstein_drift(mk(cur), mk(ref), ["v"]).first().statistic == pytest.approx(area / dev)
    report = drift.drift_report(mk(cur), mk(ref), ["v"], "ks")
    assert report.first().method == "ks_p_value" and drift.dataset_drift(report).first().dataset_drift_detected
    assert drift.drift_report(mk(cur), mk(ref), ["v"]).first().method == "wasserstein_normed"


def test_alerts(spark):
    r = random.Random(1)
    clean = spark.createDataFrame(
        [(f"t{i}", "x", float(r.randrange(5, 200)), float(r.randrange(50, 900))) for i in range(200)],
        "recipe_id string, ingredients_parsed string, cook_time_minutes double, calories double")
    rows = validation.alert_verification(clean).collect()
    assert len(rows) == 5 and all(x.correctly_classified for x in rows)


def test_production_validation(spark):
    df = spark.createDataFrame([(f"r{i}", i, i % 2) for i in range(45)], "recipe_id string, pos int, label int")

    def perfect(batched):
        assert batched.agg(F.max("batch_id")).first()[0] == 2
        first = batched.where("pos < 44").select("recipe_id", (F.lit(0.9) - F.col("label")).alias("score"), "batch_id", F.lit(1).alias("returned"), (F.col("batch_id") * 3).alias("ms"))
        return first.union(first.select("recipe_id", ((F.lit(0.9) - F.col("score")) * 0.5).alias("score"), "batch_id", F.lit(2).alias("returned"), "ms"))

    row = validation.production_validation(df, perfect, offline_auc=0.9, batch_value="ms").first()
    assert (row.mean_batch_value, row.max_batch_value) == (3.0, 6)  # one value a batch; the last score of an id counts
    assert row.production_roc_auc == 1.0 and row.auc_delta == pytest.approx(0.1)
    assert row.candidates_missing_prediction == 1 and not row.passed


def test_streams_match_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    log = lambda df: df.select(
        F.col("event_type").alias("path"), F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.col("value").alias("latency_ms"), "ts")
    source = tmp_path / "in"
    events.repartition(4).write.parquet(str(source))
    stream = windows.stream_table(spark, str(source), events.schema)
    out = sinks.replay(windows.windowed_telemetry(log(stream), "1 day", lateness="40 days"))
    assert out.count() == 0  # nothing is closed within that lateness
    out = sinks.replay(windows.windowed_telemetry(log(stream), "1 day"))
    batch = windows.windowed_telemetry(log(events), "1 day")
    closed = batch.where(F.col("window_end") <= events.agg(F.max("ts").cast("timestamp") - F.expr("interval 10 minutes")).first()[0])
    key = lambda r: (r.window_start, r.path, r.request_count, r.error_count)
    assert sorted(map(key, out.collect())) == sorted(map(key, closed.collect())) and out.count() > 100


def test_monitor_stream(spark, tmp_path):
    schema = "recipe_id string, ingredients_parsed string, cook_time_minutes double, calories double"
    clean = spark.createDataFrame([(f"t{i}", "x", 10.0 + i % 50, 100.0 + i) for i in range(200)], schema)
    bad = clean.withColumn("calories", F.lit(90000.0))
    clean.coalesce(1).write.parquet(str(tmp_path / "in"))
    bad.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = windows.stream_table(spark, str(tmp_path / "in"), clean.schema, files_per_batch=1)
    seen = []
    q = sinks.monitor_stream(stream, clean, "recipe_id", ["cook_time_minutes", "calories"], str(tmp_path / "out"),
                             str(tmp_path / "state"), True, lambda df, i: seen.append(i))
    q.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(seen) == [0, 1] and sorted(r.issue_count for r in rows) == [0, 1]


def test_tfidf_by_hand(spark, tmp_path):
    docs = {1: "red red fish", 2: "blue fish", 3: "a"}
    df = spark.createDataFrame(list(docs.items()), "id int, text string")
    model, counts = tfidf.fit_tfidf(df, "id", "text", sublinear=True)
    model.save(str(tmp_path / "m"))
    model = tfidf.TfidfModel.load(spark, str(tmp_path / "m"))
    idf = {"blue": math.log(4 / 2) + 1, "fish": math.log(4 / 3) + 1, "red": math.log(4 / 2) + 1}
    raw = {1: {"red": (1 + math.log(2)) * idf["red"], "fish": idf["fish"]}, 2: {"blue": idf["blue"], "fish": idf["fish"]}}
    got = {r.id: dict(zip(r.terms, r.weights)) for r in model.transform(df, "id", "text").collect()}
    assert set(got) == {1, 2}
    for d, w in raw.items():
        norm = math.sqrt(sum(x * x for x in w.values()))
        assert got[d] == pytest.approx({t: x / norm for t, x in w.items()})
    vectors = {r.id: r.features for r in tfidf.to_vectors(df, model.weights(counts, "id"), "id", model.size).collect()}
    assert vectors[3].numNonzeros() == 0 and vectors[1].size == 3


def test_text_rankers_learn(spark, tmp_path):
    r = random.Random(0)
    rows = [(i, " ".join(r.choice(["garlic", "basil"] if i % 3 else ["stale", "burnt"]) for _ in range(6)) + f" w{i % 4}", int(i % 3 > 0))
            for i in range(90)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    specs = {"w": training.TextSpec("word", 1, 2, 1, True, "svm", 1.0), "c": training.TextSpec("char_wb", 2, 3, 1, False, "logistic", 3.0, balanced=True)}
    auc, long = training.repeated_cv(df, "id", "text", specs, {}, {"blend": {"w": 0.5, "c": 0.5}}, 2, 1, max_iter=10)
    assert auc.count() == 6 and auc.agg(F.min("auc")).first()[0] > 0.95
    assert evaluation.oof_average(long.where("model = 'w'"), "id").count() == 90
    champion = training.fit_champion(df, "id", "text", {"w": 0.5, "c": 0.5}, specs, 10)
    scored = champion.score(df.withColumn("req", F.col("id") % 2), "id", "text", ["req"])
    assert evaluation.roc_auc(scored, groups=["req"]).agg(F.min("roc_auc")).first()[0] > 0.95
    champion.save(str(tmp_path / "champion"))
    again = training.ChampionRanker.load(spark, str(tmp_path / "champion"))
    for name, ranker in champion.rankers.items():
        got = {r.id: r.score for r in ranker.score(df, "id", "text").collect()}
        assert got == {r.id: pytest.approx(r.score) for r in again.rankers[name].score(df, "id", "text").collect()}
        counts = training.text_counts(df, ranker.spec, "id", "text")
        weight = {r["index"]: r["coefficient"] for r in ranker.coefficients.collect()}
        for r in ranker.tfidf.weights(counts, "id").collect():
            margin = ranker.intercept + sum(weight.get(i, 0.0) * w for i, w in zip(r.indices, r.weights, strict=True))
            assert got[r.id] == pytest.approx(margin if ranker.spec.model == "svm" else 1 / (1 + math.exp(-margin)))


def test_estimators_in_a_pipeline(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    from ladle.operators.estimators import PopularityRanker, RankBlend, StructuredEncoder, TfidfVectorizer
    from ladle.sources.writers import load_pipeline, save_pipeline  # noqa: F401

    rows = [(i, "ab"[i % 2], float(i % 5), "good dish" if i % 2 else "bad dish", i % 2, None if i % 7 == 0 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, g string, rating double, text string, label int, x double")
    popular = Pipeline(stages=[PopularityRanker("g"), RankBlend({"score": 0.5, "rating": 0.5}, "blend")]).fit(df).transform(df)
    assert popular.where("score IS NULL OR blend IS NULL").count() == 0
    text = Pipeline(stages=[TfidfVectorizer("id"), LogisticRegression(maxIter=5)]).fit(df).transform(df)
    assert text.where("prediction = label").count() == 40
    wide = StructuredEncoder(["x"], ["g"]).fit(df).transform(df)
    assert wide.first().features.size == 3
    with pytest.raises(ValueError):
        StructuredEncoder(["rating"], []).fit(df)


def test_model_files(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([("a", 0.5, 1), ("b", 0.25, 0)], "g string, score double, label int")
    writers.save_pipeline(Pipeline(stages=[StringIndexer(inputCol="g", outputCol="i")]).fit(df), str(tmp_path / "m"))
    assert writers.load_pipeline(str(tmp_path / "m")).transform(df).count() == 2
    writers.write_predictions(df, str(tmp_path / "p"), group="g")
    assert spark.read.parquet(str(tmp_path / "p")).columns == ["label", "score", "g"]
    writers.write_ranking(df.select(F.lit(1).alias("rank"), F.col("g").alias("title"), "score"), str(tmp_path / "r"))
    assert readers.read_csv(spark, str(tmp_path / "r")).first()["Rank"] == "🥇 #1"
    assert schemas.PREDICTIONS.names == ["label", "score", "cuisine_path"]


def test_hot_request_is_split(spark, monkeypatch):
    """All joins on the request key go through the salted path and still give the same answer."""
    from ladle.operators import ordering, scoring, skew
    from ladle.operators.constraints import Constraints

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).alias("request_id"), F.col("id").alias("pos"),
        F.concat(F.lit("r"), "id").alias("recipe_id"), F.lit("t").alias("title"),
        F.when(F.col("id") % 2 == 0, "fresh garlic").otherwise("plain").alias("ingredients_parsed"),
        F.lit(None).cast("double").alias("cook_time_minutes"), (F.col("id") % 100).cast("double").alias("calories"),
        F.array().cast("array<string>").alias("dietary_tags"), F.array().cast("array<string>").alias("excluded_ingredients_present"))
    table = df.select("request_id").distinct().withColumns(Constraints(max_calories=50.0).columns())
    run = lambda: scoring.responses(*scoring.score_requests(df, table))
    want = sorted(map(str, run().collect()))
    monkeypatch.setattr(skew, "measured_bytes", lambda _: 10**12)
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    assert sorted(map(str, run().collect())) == want
    best = run().where("request_id = 1").orderBy("rank").collect()
    assert [r.rank for r in best] == list(range(1, len(best) + 1)) and len(best) > 900
