import math

import pytest
from pyspark.sql import functions as F

from ladle.functions import flags, nutrition, scores, text


def one(spark, expr, value=None, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [
    ("  hello   world  ", "hello world"), ("Cherry Pie", "Cherry Pie"), ("   ", None), (None, None),
    ("a  b\n", "a b"),
])
def test_clean_text(spark, raw, want):
    assert one(spark, text.clean_text, raw) == want


@pytest.mark.parametrize("raw,want", [
    ("45 mins", 45), ("1 hr 30 mins", 90), ("2 hrs", 120), ("30", 30), ("1 hrs 23 mins", 83), ("1 hour 30 mins", 30),
    (None, None), ("", None), ("overnight, ideally", None),
])
def test_duration(spark, raw, want):
    assert one(spark, text.duration_minutes, raw) == want


def test_lines(spark):
    assert one(spark, text.normalize_line, "2 CUPS Flour!!") == "2 cups flour"
    assert one(spark, text.normalize_line, "olive   oil") == "olive oil"
    assert one(spark, text.normalize_line, "Jalapeño ½ cup") == "jalapeño ½ cup"
    assert one(spark, text.split_lines, "flour; sugar\nbutter") == ["flour", "sugar", "butter"]
    assert one(spark, text.split_lines, None) == []
    assert one(spark, text.split_lines, "flour;; sugar;") == ["flour", "sugar"]
    assert one(spark, lambda c: text.split_lines(c, text.LINE_BREAKS_COMMAS), "a, b|c;d") == ["a", "b", "c", "d"]
    assert one(spark, text.unjoin_lines, "a||b|") == ["a", "b"]


def test_model_text(spark):
    assert one(spark, text.model_text, "2 Cups flour 1.5 KG x2 cans, canned 1½") == "flour x2 , canned 1½"
    assert one(spark, text.model_text, None) == ""


def test_word_ngrams(spark):
    got = one(spark, lambda c: text.word_ngrams(text.words(c), 1, 3), "Olive a oil, salt")
    assert got == ["olive", "oil", "salt", "olive oil", "oil salt", "olive oil salt"]


def brute_chars(s, low, high):
    out = []
    for w in s.lower().split():
        w = f" {w} "
        for n in range(low, high + 1):
            if len(w) > n:
                out += [w[i:i + n] for i in range(len(w) - n + 1)]
        if len(w) <= high:
            out.append(w)
    return sorted(out)


@pytest.mark.parametrize("low,high", [(2, 4), (3, 5), (4, 6), (5, 7)])
def test_char_ngrams(spark, low, high):
    s = "Garlic a salt  olive oil été"
    assert sorted(one(spark, lambda c: text.char_ngrams(c, low, high), s)) == brute_chars(s, low, high)


def test_flags(spark):
    df = spark.createDataFrame([(["2 chicken breasts diced"],), (["tofu", "soy sauce"],)], "lines array<string>")
    rows = flags.absence_flags(flags.keyword_flags(df, "lines"), "lines").collect()
    assert (rows[0].has_chicken, rows[1].has_chicken, rows[1].has_tofu_plant) == (1, 0, 1)
    assert (rows[0].is_likely_vegetarian, rows[1].is_likely_vegan, rows[1].is_likely_gluten_free) == (0, 1, 0)
    assert flags.keyword_flags(df, "absent") is df


def test_tags(spark):
    assert one(spark, flags.derived_tags, "kale, salt") == ["gluten_free", "vegan", "vegetarian"]
    assert one(spark, flags.derived_tags, "beef, flour") == []
    assert one(spark, lambda c: flags.derived_tags(c, F.array(F.lit("keto"))), "egg") == ["gluten_free", "keto", "vegetarian"]
    assert one(spark, flags.detected_groups, "egg and ham") == ["pork", "egg"]


@pytest.mark.parametrize("x,left,right", [
    (None, None, "unknown"), (-1.0, None, "quick_under_15m"), (15.0, "15_30m", "quick_under_15m"),
    (29.9, "15_30m", "moderate_15_30m"), (60.0, "1_2h", "standard_30_60m"), (500.0, "over_2h", "long_over_1h"),
])
def test_buckets(spark, x, left, right):
    assert one(spark, flags.bucket_left_closed, x, "double") == left
    assert one(spark, flags.bucket_right_closed, x, "double") == right


def test_ratio_and_label(spark):
    df = spark.createDataFrame([(10.0, 20.0, 4.0), (10.0, 0.0, math.nan), (None, 5.0, None)], "a double, b double, r double")
    rows = df.select(flags.safe_ratio(F.col("a"), F.col("b")).alias("q"), flags.binary_label(F.col("r")).alias("l")).collect()
    assert [r.q for r in rows] == [0.5, None, None] and [r.l for r in rows] == [1, 0, 0]


@pytest.mark.parametrize("raw,want", [
    ('{"Fat": "12g", "b": 3}', {"Fat": "12g", "b": "3"}), ("{'a': None, 'b': True}", {"a": None, "b": "true"}),
    ("[1, 2]", {}), ("junk", {}), (None, {}), ("", {}),
    ("{'a': 'True', 'b': None}", {"a": "True", "b": None}), ("{'a': 'None or False', \"b\": False}", {"a": "None or False", "b": "false"}),
    ("{'say \"hi\"': 'it\\'s', 'n': None}", {'say "hi"': "it's", "n": None}),
])
def test_parse_map(spark, raw, want):
    assert one(spark, nutrition.parse_map, raw) == want


@pytest.mark.parametrize("raw,want", [("12g", 12.0), ("1-2", None), ("true", 1.0), ("-3.5", -3.5), ("", None), (None, None), ("abc", None)])
def test_coerce_number(spark, raw, want):
    assert one(spark, nutrition.coerce_number, raw) == want


def test_map_columns_use_fitted_keys(spark):
    df = spark.createDataFrame([('{"Total Fat": "5g"}',), ('{"Salt ": 2}',)], "nutrition string")
    out = nutrition.map_to_columns(df, "nutrition")
    assert out.columns == ["nutrition", "nutrition_salt", "nutrition_total_fat"]
    assert nutrition.map_to_columns(df, "nutrition", ["x"]).columns == ["nutrition", "nutrition_x"]


@pytest.mark.parametrize("raw,want", [
    ("Total Fat 5g Total Carbohydrate 10.5g Protein 2g", 95.0), ("Protein 0g", None), ("", None), (None, None), ("Total Fat 1.5g", 13.5),
])
def test_calories(spark, raw, want):
    assert one(spark, nutrition.macro_calories, raw) == want


def test_scores(spark):
    assert one(spark, scores.heuristic_score, "plain") == 0.78
    assert one(spark, scores.heuristic_score, "Fresh GARLIC butter lemon honey cheese basil vanilla") == 0.98
    assert one(spark, scores.confidence_tier, 0.85, "double").startswith("High")
    df = spark.createDataFrame([(1, "a", 0.9), (4, "b", 0.5)], "rank long, title string, score double")
    rows = scores.format_ranking(df).collect()
    assert rows[0]["Rank"] == "🥇 #1" and rows[1]["Rank"] == "#4 #4" and rows[1]["Quality Index"] == "50.0%"
