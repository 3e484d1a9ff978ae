"""Text cleaning, durations, flags, buckets and nutrition expressions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ladle.functions import fixed, flags, nutrition, scores, text
from ladle.plans import inputs
from ladle.plans.catalog.registry import query, rounded
from ladle.plans.inputs import CANDIDATES_SQL, DURATIONS_SQL, NAME_GROUPS

# White space as Unicode sees it, for an engine whose \s is ASCII only.
WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NORM = rf"trim(regexp_replace(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}_\s./%-]', ' ', 'g'), '{WS}', ' ', 'g'))"
LINES = rf"""list_filter(list_transform(regexp_split_to_array(text, '[\n;]+'), lambda x: {NORM}), lambda x: x <> '')"""


@query("clean_text", f"SELECT doc_id, nullif(trim(regexp_replace(text, '{WS}', ' ', 'g')), '') AS cleaned FROM documents")
def clean_text(spark, sf):
    return inputs.table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("duration_minutes", r"""
SELECT p_partkey, CASE WHEN h IS NULL AND m IS NULL
   THEN CASE WHEN regexp_full_match(d, '\d+') THEN d::DOUBLE END
   ELSE coalesce(h, 0) * 60.0::DOUBLE + coalesce(m, 0) END AS minutes
FROM (SELECT p_partkey, d, TRY_CAST(regexp_extract(d, '(\d+)\s*hr', 1) AS DOUBLE) AS h,
             TRY_CAST(regexp_extract(d, '(\d+)\s*min', 1) AS DOUBLE) AS m
      FROM (SELECT p_partkey, lower(trim(duration)) AS d FROM durations))""", (DURATIONS_SQL,))
def duration_minutes(spark, sf):
    return inputs.durations(spark, sf).select("p_partkey", text.duration_minutes(F.col("duration")).alias("minutes"))


@query("split_lines", f"""
SELECT doc_id, array_to_string({LINES}, '|') AS lines, len({LINES})::INTEGER AS n_lines FROM documents""")
def split_lines(spark, sf):
    lines = text.split_lines(F.col("text"))
    return inputs.table(spark, sf, "documents").select(
        "doc_id", text.join_lines(lines).alias("lines"), F.size(lines).alias("n_lines"))


@query("split_lines_commas", f"""
SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '[\\n;,|]+'), lambda x: {NORM}),
   lambda x: x <> ''), ', ') AS joined FROM documents""")
def split_lines_commas(spark, sf):
    lines = text.split_lines(F.col("text"), text.LINE_BREAKS_COMMAS)
    return inputs.table(spark, sf, "documents").select("doc_id", text.join_lines(lines, ", ").alias("joined"))


@query("word_diversity", f"""
SELECT doc_id, u::INTEGER AS unique_words, coalesce(round(u / nullif(n, 0)::DOUBLE, 8), 0.0) AS diversity FROM (
  SELECT doc_id, len({LINES}) AS n,
         len(list_distinct(list_filter(string_split(array_to_string({LINES}, ' '), ' '), lambda w: w <> ''))) AS u
  FROM documents)""")
def word_diversity(spark, sf):
    df = inputs.table(spark, sf, "documents").select("doc_id", text.split_lines(F.col("text")).alias("lines"))
    df = df.select("doc_id", text.distinct_words(F.col("lines")).alias("unique_words"), F.size("lines").alias("n"))
    ratio = text.per_item(F.col("unique_words"), F.col("n"))
    return rounded(df.withColumn("diversity", ratio).drop("n"), "diversity")


@query("unjoin_lines", """
SELECT doc_id, len(list_filter(string_split(replace(text, '.', '|'), '|'), lambda x: x <> ''))::INTEGER AS n_parts FROM documents""")
def unjoin_lines(spark, sf):
    df = inputs.table(spark, sf, "documents")
    parts = text.unjoin_lines(F.translate("text", ".", "|"))
    return df.select("doc_id", F.size(parts).alias("n_parts"))


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _flag_sql(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


@query("keyword_flags", "SELECT p_partkey, " + ", ".join(
    f"{_flag_sql('p_name', ws)}::INTEGER AS has_{g}" for g, ws in NAME_GROUPS.items()) + " FROM part")
def keyword_flags(spark, sf):
    df = inputs.table(spark, sf, "part").select("p_partkey", F.split("p_name", ";").alias("lines"))
    return flags.keyword_flags(df, "lines", NAME_GROUPS).drop("lines")


# A line for each part: its name, and some of the default words by turns.
_WORDS = sorted({w for ws in fixed.PROTEIN_GROUPS.values() for w in ws} | set(fixed.MEAT_WORDS) | set(fixed.ANIMAL_WORDS) | set(fixed.GLUTEN_WORDS))
_LINE = f"p_name || ' ' || ({_list(_WORDS)})[p_partkey % {len(_WORDS)} + 1] || CASE WHEN p_partkey % 3 = 0 THEN ' and ' || ({_list(_WORDS)})[p_partkey % 7 + 1] ELSE '' END"


def _word_lines(spark, sf):
    words, key = F.array(*[F.lit(w) for w in _WORDS]), F.col("p_partkey")
    more = F.when(key % 3 == 0, F.concat(F.lit(" and "), F.element_at(words, (key % 7 + 1).cast("int")))).otherwise("")
    line = F.concat("p_name", F.lit(" "), F.element_at(words, (key % len(_WORDS) + 1).cast("int")), more)
    return inputs.table(spark, sf, "part").select("p_partkey", line.alias("line"))


@query("default_flags", "SELECT p_partkey, " + ", ".join(f"{_flag_sql('line', ws)}::INTEGER AS has_{g}" for g, ws in fixed.PROTEIN_GROUPS.items()) + f""",
       (NOT {_flag_sql('line', fixed.MEAT_WORDS)})::INTEGER AS is_likely_vegetarian,
       (NOT {_flag_sql('line', [*fixed.MEAT_WORDS, *fixed.ANIMAL_WORDS])})::INTEGER AS is_likely_vegan,
       (NOT {_flag_sql('line', fixed.GLUTEN_WORDS)})::INTEGER AS is_likely_gluten_free
FROM (SELECT p_partkey, {_LINE} AS line FROM part)""")
def default_flags(spark, sf):
    """All default keyword groups and diet flags."""
    df = _word_lines(spark, sf).withColumn("lines", F.array("line"))
    return flags.absence_flags(flags.keyword_flags(df, "lines"), "lines").drop("line", "lines")


@query("default_tags", f"""
SELECT p_partkey, concat_ws(',', CASE WHEN NOT {_flag_sql('line', fixed.GLUTEN_WORDS)} THEN 'gluten_free' END,
         CASE WHEN NOT {_flag_sql('line', [*fixed.MEAT_WORDS, *fixed.ANIMAL_WORDS])} THEN 'vegan' END,
         CASE WHEN NOT {_flag_sql('line', fixed.MEAT_WORDS)} THEN 'vegetarian' END) AS tags,
       concat_ws(',', {", ".join(f"CASE WHEN {_flag_sql('line', ws)} THEN '{g}' END" for g, ws in fixed.PROTEIN_GROUPS.items())}) AS groups
FROM (SELECT p_partkey, {_LINE} AS line FROM part)""")
def default_tags(spark, sf):
    """Tags and detected groups by the default lists."""
    df = _word_lines(spark, sf)
    return df.select("p_partkey", F.array_join(flags.derived_tags(F.col("line")), ",").alias("tags"), F.array_join(flags.detected_groups(F.col("line")), ",").alias("groups"))


@query("positive_scores", """
SELECT p_partkey, round(p, 8) AS from_probability, round(p, 8) AS from_array, round(3 * p, 8) AS from_margin, p >= 0.5 AS predicted
FROM (SELECT p_partkey, (p_partkey % 1000) / 1000.0::DOUBLE AS p FROM part)""")
def positive_scores(spark, sf):
    """The positive-class score, whichever column a model left: a vector, an array or a margin."""
    p = (F.col("p_partkey") % 1000) / 1000.0
    df = inputs.table(spark, sf, "part").select("p_partkey", p.alias("p"))
    out = None
    for name, col, value in (("from_probability", "probability", array_to_vector(F.array(1 - F.col("p"), F.col("p")))), ("from_array", "probability", F.array(1 - F.col("p"), F.col("p"))),
                             ("from_margin", "rawPrediction", F.array(-3 * F.col("p"), 3 * F.col("p")))):
        left = df.withColumn(col, value)
        part = left.select("p_partkey", scores.positive_score(left).alias(name))
        out = part if out is None else out.join(part, "p_partkey")
    return rounded(out.withColumn("predicted", scores.predicted_positive(F.col("from_probability"))), "from_probability", "from_array", "from_margin")


_MEAT, _ANIMAL, _GLUTEN = ["anvil", "bolt"], ["gear"], ["plate"]


@query("absence_flags", f"""
SELECT p_partkey, (NOT {_flag_sql('p_name', _MEAT)})::INTEGER AS is_likely_vegetarian,
       (NOT {_flag_sql('p_name', _MEAT + _ANIMAL)})::INTEGER AS is_likely_vegan,
       (NOT {_flag_sql('p_name', _GLUTEN)})::INTEGER AS is_likely_gluten_free FROM part""")
def absence_flags(spark, sf):
    df = inputs.table(spark, sf, "part").select("p_partkey", F.split("p_name", ";").alias("lines"))
    return flags.absence_flags(df, "lines", _MEAT, _ANIMAL, _GLUTEN).drop("lines")


@query("derived_tags", f"""
SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat([lower(p_type)],
         CASE WHEN NOT {_flag_sql('p_name', _MEAT)} THEN ['vegetarian'] ELSE [] END,
         CASE WHEN NOT {_flag_sql('p_name', _MEAT)} AND NOT {_flag_sql('p_name', _ANIMAL)} THEN ['vegan'] ELSE [] END,
         CASE WHEN NOT {_flag_sql('p_name', _GLUTEN)} THEN ['gluten_free'] ELSE [] END))), ',') AS tags,
       concat_ws(',', {", ".join(f"CASE WHEN {_flag_sql('p_name', ws)} THEN '{g}' END" for g, ws in NAME_GROUPS.items())}) AS groups_found
FROM part""")
def derived_tags(spark, sf):
    name = F.col("p_name")
    tags = flags.derived_tags(name, F.array(F.lower("p_type")), _MEAT, _ANIMAL, _GLUTEN)
    return inputs.table(spark, sf, "part").select(
        "p_partkey", F.array_join(tags, ",").alias("tags"),
        F.array_join(flags.detected_groups(name, NAME_GROUPS), ",").alias("groups_found"))


@query("time_bucket_left", """
SELECT pos, CASE WHEN t >= 120 THEN 'over_2h' WHEN t >= 60 THEN '1_2h' WHEN t >= 30 THEN '30_60m'
                 WHEN t >= 15 THEN '15_30m' WHEN t >= 0 THEN 'under_15m' END AS bucket
FROM (SELECT pos, cook_time_minutes * 4 - 5 AS t FROM candidates)""", (CANDIDATES_SQL,))
def time_bucket_left(spark, sf):
    df = inputs.candidates(spark, sf)
    return df.select("pos", flags.bucket_left_closed(F.col("cook_time_minutes") * 4 - 5).alias("bucket"))


@query("time_bucket_right", """
SELECT pos, CASE WHEN t IS NULL THEN 'unknown' WHEN t <= 15 THEN 'quick_under_15m' WHEN t <= 30 THEN 'moderate_15_30m'
                 WHEN t <= 60 THEN 'standard_30_60m' ELSE 'long_over_1h' END AS bucket
FROM (SELECT pos, cook_time_minutes * 2 AS t FROM candidates)""", (CANDIDATES_SQL,))
def time_bucket_right(spark, sf):
    df = inputs.candidates(spark, sf)
    return df.select("pos", flags.bucket_right_closed(F.col("cook_time_minutes") * 2).alias("bucket"))


@query("safe_ratio", """
SELECT pos, round(calories / nullif(pos % 3, 0)::DOUBLE, 8) AS ratio FROM candidates""", (CANDIDATES_SQL,))
def safe_ratio(spark, sf):
    df = inputs.candidates(spark, sf)
    return rounded(df.select("pos", flags.safe_ratio(F.col("calories"), F.col("pos") % 3).alias("ratio")), "ratio")


@query("json_map_columns", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS nutrition_k FROM events""")
def json_map_columns(spark, sf):
    df = inputs.table(spark, sf, "events").select("event_id", F.col("props").alias("nutrition"))
    return nutrition.map_to_columns(df, "nutrition").drop("nutrition")


@query("json_map_rows", """
SELECT event_id, k AS name, TRY_CAST(json_extract_string(props, '$."' || k || '"') AS DOUBLE) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def json_map_rows(spark, sf):
    df = inputs.table(spark, sf, "events").select("event_id", F.col("props").alias("nutrition"))
    return nutrition.map_rows(df, "event_id", "nutrition")


@query("macro_calories", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN c > 0 THEN round(c, 1) END AS calories
FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 9 * l_quantity END
        + CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 4 * l_linenumber END + 4 * floor(l_discount * 100) AS c FROM lineitem)""")
def macro_calories(spark, sf):
    n = F.col("l_linenumber")
    whole = F.concat(
        F.when(n % 3 != 0, F.concat(F.lit("Total Fat "), F.col("l_quantity").cast("string"), F.lit("g "))).otherwise(""),
        F.when(n % 2 != 0, F.concat(F.lit("Total Carbohydrate "), n.cast("string"), F.lit("g "))).otherwise(""),
        F.lit("Protein "), F.floor(F.col("l_discount") * 100).cast("string"), F.lit("g"))
    return inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", nutrition.macro_calories(whole).alias("calories"))


UNITS = "|".join(fixed.UNIT_WORDS)
TEXT_OF = "text || ' 2 cups of flour 1.5 kg x2 cans'"


@query("model_text", rf"""
SELECT doc_id, trim(regexp_replace(replace(regexp_replace(regexp_replace(
         regexp_replace(lower({TEXT_OF}), '([\p{{L}}\p{{N}}_]+)', chr(1) || '\1' || chr(1), 'g'),
         '\x01\d+\x01(\.\x01\d+\x01)?', ' ', 'g'), '\x01({UNITS})\x01', ' ', 'g'), chr(1), ''), '{WS}', ' ', 'g')) AS cleaned
FROM documents""")
def model_text(spark, sf):
    whole = F.concat("text", F.lit(" 2 cups of flour 1.5 kg x2 cans"))
    return inputs.table(spark, sf, "documents").select("doc_id", text.model_text(whole).alias("cleaned"))


@query("score_tiers", """
SELECT pos, s AS score, s >= 0.5 AS predicted_positive,
  CASE WHEN s >= 0.85 THEN 'High Confidence (≥85%)' WHEN s >= 0.65 THEN 'Moderate Confidence (65–85%)'
       ELSE 'Borderline / Low Confidence (<65%)' END AS tier,
  CASE WHEN s >= 0.85 THEN '★ ★ ★ ★ ★' WHEN s >= 0.70 THEN '★ ★ ★ ★ ☆' ELSE '★ ★ ★ ☆ ☆' END AS stars
FROM (SELECT pos, (pos % 101) / 100.0::DOUBLE AS s FROM candidates)""", (CANDIDATES_SQL,))
def score_tiers(spark, sf):
    df = inputs.candidates(spark, sf).select("pos", ((F.col("pos") % 101) / 100.0).alias("score"))
    s = F.col("score")
    return df.select("pos", "score", scores.predicted_positive(s).alias("predicted_positive"),
                     scores.confidence_tier(s).alias("tier"), scores.item_stars(s).alias("stars"))


@query("heuristic_score", """
SELECT doc_id, round(least(greatest(0.78::DOUBLE + 0.035::DOUBLE * n, 0.55), 0.98), 4) AS score FROM (
  SELECT doc_id, len(list_filter(['fresh', 'garlic', 'olive oil', 'lemon', 'butter', 'parmesan', 'basil', 'chocolate',
    'vanilla', 'honey', 'cheese', 'rosemary', 'cinnamon', 'the', 'er', 'qu'], lambda w: contains(lower(text), w))) AS n FROM documents)""")
def heuristic_score(spark, sf):
    from ladle.functions.fixed import SIGNAL_WORDS

    score = scores.heuristic_score(F.col("text"), [*SIGNAL_WORDS, "the", "er", "qu"])
    return inputs.table(spark, sf, "documents").select("doc_id", score.alias("score"))


@query("fill_missing", """
SELECT pos, coalesce(calories, (SELECT round(avg(calories), 6) FROM candidates)) AS calories,
       coalesce(cook_time_minutes, 0.0) AS cook_time_minutes FROM candidates""", (CANDIDATES_SQL,))
def fill_missing(spark, sf):
    df = inputs.candidates(spark, sf).select("pos", "calories", "cook_time_minutes")
    mean = df.select(F.round(F.avg("calories"), 6)).scalar()
    return df.withColumn("calories", F.coalesce("calories", mean)).na.fill(0.0, ["cook_time_minutes"])


@query("drop_missing", """
SELECT pos, calories FROM candidates WHERE calories IS NOT NULL AND cook_time_minutes IS NOT NULL""", (CANDIDATES_SQL,))
def drop_missing(spark, sf):
    df = inputs.candidates(spark, sf)
    return df.na.drop(subset=["calories", "cook_time_minutes"]).select("pos", "calories")


@query("value_counts", """
SELECT p_type AS grp, count(*) AS count, (SELECT count(DISTINCT p_type) FROM part) AS n_distinct FROM part GROUP BY p_type""")
def value_counts(spark, sf):
    counts = inputs.table(spark, sf, "part").groupBy(F.col("p_type").alias("grp")).count()
    return counts.withColumn("n_distinct", counts.select(F.count(F.lit(1))).scalar())
