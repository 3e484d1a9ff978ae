import pytest
from pyspark.sql import functions as F

from ladle.operators import constraints as cons
from ladle.operators import dedupe, inject, popularity, promotion, quality, sampling, scoring, telemetry

CAND = ("request_id int, pos int, recipe_id string, title string, ingredients_parsed string, cook_time_minutes double, "
        "calories double, dietary_tags array<string>, excluded_ingredients_present array<string>")


def cand(i, text="chicken, rice, broccoli", time=30.0, kcal=400.0, tags=(), listed=(), request=1):
    return (request, i, f"r{i}", "Test Recipe", text, time, kcal, list(tags), list(listed))


def survivors(spark, rows, limits):
    kept, counts = cons.apply_constraints(spark.createDataFrame(rows, CAND), limits)
    return sorted(r.recipe_id for r in kept.collect()), counts.first().filtered_out_count


@pytest.mark.parametrize("row,limits,ok", [
    (cand(1, kcal=300.0), cons.Constraints(max_calories=500), True),
    (cand(1, kcal=900.0), cons.Constraints(max_calories=500), False),
    (cand(1, kcal=None), cons.Constraints(max_calories=500), False),
    (cand(1, kcal=None), cons.Constraints(), True),
    (cand(1, time=45.0), cons.Constraints(max_cook_time_minutes=20), False),
    (cand(1, tags=["vegan", "keto"]), cons.Constraints(required_dietary_tags=("vegan",)), True),
    (cand(1, tags=["keto"]), cons.Constraints(required_dietary_tags=("vegan",)), False),
    (cand(1, listed=[" Peanuts "]), cons.Constraints(excluded_ingredients=("peanuts",)), False),
    (cand(1, text="rice, peanuts", listed=["rice"]), cons.Constraints(excluded_ingredients=("peanuts",)), True),
    (cand(1, text="Rice, PEANUTS"), cons.Constraints(excluded_ingredients=("  PEANUTS  ", " ")), False),
    (cand(1), cons.Constraints(excluded_ingredients=("shellfish",)), True),
    (cand(1), None, True),
])
def test_constraints(spark, row, limits, ok):
    ids, dropped = survivors(spark, [row], limits)
    assert (ids == ["r1"]) == ok and dropped == (0 if ok else 1)


def test_requests_without_survivors_keep_their_counts(spark):
    df = spark.createDataFrame([cand(1, kcal=200.0), cand(2, kcal=900.0), cand(3, kcal=900.0, request=2)], CAND)
    best, counts = scoring.score_requests(df, cons.Constraints(max_calories=500), top_k=2)
    rows = {r.request_id: r for r in scoring.responses(best, counts).collect()}
    assert rows[1].recipe_id == "r1" and rows[1].rank == 1 and rows[1].filtered_out_count == 1
    assert rows[2].recipe_id is None and rows[2].filtered_out_count == 1 and rows[2].total_candidates == 1


def test_lenient_reason(spark):
    df = spark.createDataFrame([cand(1, kcal=None), cand(2, kcal=900.5), cand(3, text="has Ham")], CAND)
    out = scoring.mark_reason(df, cons.Constraints(max_calories=500, excluded_ingredients=("ham",)))
    assert [r.reason for r in out.orderBy("pos").collect()] == [
        None, "Exceeds max calories (900 > 500 kcal)", "Contains excluded ingredient: 'ham'"]


def test_item_errors_and_trace(spark):
    df = spark.createDataFrame(
        [("a", "Guac", "avocado; salt", "15 mins", "220", []), ("b", " ", "", "5", "9", []), ("c", "X", "y", "-10", "-50", []),
         ("d", "X", "y", "5", "30000", []), ("e", "X", "y", None, "abc", [])],
        "recipe_id string, title string, ingredients string, cook_time string, calories string, dietary_tags array<string>")
    n = {r.recipe_id: r.n for r in df.select("recipe_id", F.size(scoring.raw_errors()).alias("n")).collect()}
    assert n == {"a": 0, "b": 2, "c": 2, "d": 1, "e": 1}
    trace = {r.recipe_id: r for r in scoring.stage_trace(df).collect()}
    assert len(trace["a"].steps) == 5 and trace["a"].score == 0.78 and len(trace["b"].steps) == 1
    ready = scoring.prepare_items(df).where("recipe_id = 'a'").first()
    assert ready.ingredients_parsed == "avocado, salt" and ready.cook_time_minutes == 15.0
    assert ready.dietary_tags == ["gluten_free", "vegan", "vegetarian"] and ready.time_bucket == "quick_under_15m"


ITEM = ("Test Recipe", "10 mins", None, "30 mins", 4, None, "flour", "Mix.", 4.5, "https://e.com/1", "/Desserts/", "{}", "t", None, 7)
ITEM_COLS = ("recipe_name string, prep_time string, cook_time string, total_time string, servings long, yield string, "
             "ingredients string, directions string, rating double, url string, cuisine_path string, nutrition string, "
             "timing string, img_src string, id long")


@pytest.mark.parametrize("at,value,check", [
    (8, 6.0, "in_range(0, 5)"), (4, -1, "greater_than(0)"), (6, "", "str_length(1, None)"),
    (9, "www.e.com", "str_startswith('http')"), (0, None, "not_nullable"), (None, None, None),
])
def test_item_rules(spark, at, value, check):
    row = list(ITEM)
    if at is not None:
        row[at] = value
    found = quality.check_rules(spark.createDataFrame([tuple(row)], ITEM_COLS), quality.item_rules(), "id").collect()
    assert [f["check"] for f in found] == ([check] if check else [])


def test_gate(spark):
    bad = quality.check_rules(spark.createDataFrame([ITEM], ITEM_COLS).drop("url"), quality.item_rules(), "id")
    with pytest.raises(quality.GateFailed):
        quality.require_passed(quality.gate(bad))
    quality.require_passed(quality.gate(bad, gating=False))


def test_batch_checks(spark):
    df = spark.createDataFrame([(f"t{i}", "x", 10.0 + i, 100.0) for i in range(40)],
                               "recipe_id string, ingredients_parsed string, cook_time_minutes double, calories double")
    assert not quality.verdict(quality.batch_findings(df, df, "recipe_id")).first().anomaly_detected
    nulls = inject.fault_nulls(df)
    assert nulls.where("affected").count() == 10 and nulls.where("calories IS NULL").count() == 10
    ranges = inject.fault_ranges(df)
    assert ranges.where("cook_time_minutes < 0").count() == 4 and ranges.where("calories >= 50000").count() == 4
    assert quality.verdict(quality.batch_findings(nulls, df, "recipe_id")).first().issue_count == 2
    out = {r.column: r for r in quality.out_of_range(ranges, "recipe_id").collect()}
    assert out["calories"].affected_row_count == 4 and len(out["calories"].example_values) == 4
    changed = inject.column_change(df)
    assert [c for _, c, _ in quality.schema_contract(changed)] == ["cook_time_minutes", "calories"]
    assert quality.verdict(quality.batch_findings(changed, df, "recipe_id")).first().issue_count == 2
    kinds = inject.manifest(nulls, "a").unionByName(inject.manifest(inject.column_swap(df), "b"))
    assert {r.corruption_type: r.affected_row_count for r in inject.manifest_counts(kinds).collect()} == {"a": 10, "b": 40}


def test_dedupe(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", "u")], "id int, k string, u string")
    assert sorted(r.id for r in dedupe.dedupe_first(df, ["k", "u"], ["id"]).collect()) == [1, 3]
    assert dedupe.duplicate_count(df, ["k", "u", "absent"]).first().duplicate_count == 1


def test_split_is_exact_and_independent_of_order(spark):
    df = spark.range(1000).select("id", (F.col("id") % 20 != 0).cast("int").alias("label"))
    first = {r.id: r.split for r in sampling.stratified_split(df, "label", "id").collect()}
    again = {r.id: r.split for r in sampling.stratified_split(df.repartition(7).orderBy(F.rand(3)), "label", "id").collect()}
    assert first == again
    sizes = {(r.label, r.split): r.n for r in sampling.stratified_split(df, "label", "id").groupBy("label", "split").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert sizes[(0, "test")] == 8 and sizes[(1, "test")] in (142, 143) and sum(sizes.values()) == 1000
    with pytest.raises(ValueError):
        sampling.stratified_split(df, "label", "id", 0.9, 0.1)
    assert sampling.hash_sample(df, "id", 37).count() == 37
    assert sampling.hash_sample(df, "id", 5000).count() == 1000
    folds = sampling.fold_assignment(df, "label", "id", 5).groupBy("label", "fold").count().collect()
    assert {r["count"] for r in folds} == {10, 190}


def test_popularity(spark, tmp_path):
    train = spark.createDataFrame([("i", 4.0), ("i", 5.0), ("m", 3.0), (None, 1.0)], "g string, r double")
    model = popularity.fit_popularity(train, "g", "r")
    model.save(str(tmp_path / "m"))
    model = popularity.PopularityModel.load(spark, str(tmp_path / "m"))
    new = spark.createDataFrame([(1, "i", 4.5), (2, "m", 5.0), (3, "x", 5.0), (4, None, 3.75)], "id int, g string, r double")
    assert [r.score for r in model.score(new).orderBy("id").collect()] == [4.5, 3.0, 3.25, 3.25]
    assert [r.zscore for r in model.zscore(new, "r").orderBy("id").collect()] == [0.0, 2.0, 1.25, 0.0]


def test_telemetry(spark):
    log = spark.createDataFrame([("GET", "/health", 200, float(i)) for i in range(1, 5)] + [("POST", "/predict", 500, 9.0)],
                                "method string, path string, status_code int, latency_ms double")
    total = telemetry.telemetry_overall(log).first()
    assert (total.request_count, total.error_count, total.error_rate, total.p50_ms, total.p95_ms) == (5, 1, 0.2, 3.0, 9.0)
    by = {r.endpoint: r for r in telemetry.telemetry_by_path(log).collect()}
    assert by["GET /health"]["count"] == 4 and by["GET /health"].p95_latency_ms == 4.0 and by["POST /predict"].error_count == 1
    empty = telemetry.telemetry_overall(log.where("false")).first()
    assert (empty.request_count, empty.error_rate, empty.p95_ms) == (0, 0.0, None)


RUNS = "run_id string, run_name string, status string, start_time int, metrics map<string,double>"
REG = "version long, run_id string, metric_value double, alias string, promoted_at int"


@pytest.mark.parametrize("runs,champion,want", [
    ([], None, "skipped: no candidate run found"),
    ([("a", "n", "FAILED", 1, {"auc": 0.9})], None, "skipped: no candidate run found"),
    ([("a", "n", "FINISHED", 1, {})], None, "skipped: missing validation metric"),
    ([("a", "n", "FINISHED", 1, {"auc": 0.6})], None, "promoted"),
    ([("a", "n", "FINISHED", 1, {"auc": 0.6})], 0.6, "skipped: no improvement"),
    ([("a", "n", "FINISHED", 1, {"auc": 0.9}), ("b", "n", "FINISHED", 2, {"auc": 0.5})], 0.6, "skipped: no improvement"),
    ([("a", "n", "FINISHED", 1, {"auc": 0.7})], 0.6, "promoted"),
])
def test_promotion(spark, runs, champion, want):
    registry = spark.createDataFrame([(3, "old", champion, "champion", 5)] if champion else [], REG)
    gate = promotion.promotion_decision(spark.createDataFrame(runs, RUNS), registry, "n", "auc")
    assert gate.first().decision == want
    added = promotion.register(registry, gate, "champion", F.lit(9), {"target": "label"})
    now = promotion.current_champion(registry.unionByName(added.drop("tags"))).first()
    assert now.run_id == ("a" if want == "promoted" else ("old" if champion else None))


def test_table_findings(spark, sf):
    """Only tables that are not there are found."""
    from ladle.operators import quality

    paths = {"documents": f"{sf}/documents.parquet", "recipes": f"{sf}/recipes.parquet"}
    assert [(r["failure_case"], r["severity"]) for r in quality.table_findings(spark, paths).collect()] == [("recipes", "critical")]
    assert [r["severity"] for r in quality.table_findings(spark, {"menus": f"{sf}/menus.parquet"}, gating=False).collect()] == ["warning"]
    assert quality.table_findings(spark, {"documents": paths["documents"]}).count() == 0
