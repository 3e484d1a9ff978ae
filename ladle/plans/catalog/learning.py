"""Encoders, fitted rankers with their optima, grid search and repeated cross-validation."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from ladle.operators import encode, evaluation, linear, sampling, scoring, tfidf
from ladle.plans import inputs, training
from ladle.plans.catalog.registry import query, rounded
from ladle.plans.inputs import CANDIDATES_SQL, LABELLED_SQL
from ladle.session import materialize, scratch_path

_NUMERIC, _CATEGORICAL = ["cook_time_minutes", "calories"], ["title", "kind"]


def _structured(spark, sf):
    p = F.col("pos")
    df = inputs.candidates(spark, sf).select(
        "pos", "cook_time_minutes", "calories", F.when(p % 9 != 0, F.col("title")).alias("title"),
        F.col("dietary_tags")[0].alias("kind"),
        ((F.col("pos") * 7919 + F.coalesce("cook_time_minutes", F.lit(0.0)) * 13).cast("bigint") % 17 > 2).cast("int").alias("label"))
    return sampling.stratified_split(df, "label", "pos")


def _texts(spark, sf, *more):
    """Labelled texts with their split, stored as the table every model reads."""
    return materialize(sampling.stratified_split(inputs.labelled_text(spark, sf, *more), "label", "doc_id"), "labelled")


@query("impute_encode", """
WITH m AS (SELECT median(cook_time_minutes) AS mt, median(calories) AS mc FROM c),
f AS (SELECT pos, coalesce(cook_time_minutes, mt) AS t, coalesce(calories, mc) AS k,
        coalesce(name, (SELECT name FROM c WHERE name IS NOT NULL GROUP BY name ORDER BY count(*) DESC, name LIMIT 1)) AS name FROM c, m),
g AS (SELECT avg(t) AS t_mean, stddev_pop(t) AS t_dev, avg(k) AS k_mean, stddev_pop(k) AS k_dev FROM f),
h AS (SELECT name, row_number() OVER (ORDER BY count(*) DESC, name) - 1 + 2 AS slot FROM f GROUP BY name)
SELECT pos, round((t - t_mean) / t_dev, 6) AS cook_time_minutes, round((k - k_mean) / k_dev, 6) AS calories, name AS title, slot::BIGINT AS hot_slot
FROM f JOIN h USING (name), g""", (CANDIDATES_SQL, """c AS (
  SELECT pos, cook_time_minutes, calories, CASE WHEN pos % 9 <> 0 THEN title END AS name FROM candidates)"""))
def impute_encode(spark, sf):
    p = F.col("pos")
    df = inputs.candidates(spark, sf).select(
        "pos", "cook_time_minutes", "calories", F.when(p % 9 != 0, F.col("title")).alias("title"))
    enc = encode.fit_encoder(df, _NUMERIC, ["title"])
    out = enc.transform(df)
    # The slot of the one-hot vector's only entry, after the numeric columns; nothing is made dense.
    hot = F.get(F.unwrap_udt("__h_title")["indices"], 0) + len(_NUMERIC)
    return rounded(out.select("pos", *_NUMERIC, "title", hot.cast("bigint").alias("hot_slot")), *_NUMERIC, digits=6)


def _fit_text(spark, sf, name):
    texts = _texts(spark, sf)
    train = texts.where("split = 'train'")
    spec = training.RANKERS[name]
    counts = training.text_counts(train, spec, "doc_id", "text")
    ranker = training.fit_ranker(train.select("doc_id", "label"), counts, spec, "doc_id")
    held = texts.where("split = 'val'").select("doc_id", "label", "text")
    return ranker.score(held, "doc_id", "text").drop("text")


@query("logistic_scores")
def logistic_scores(spark, sf):
    return _fit_text(spark, sf, "char_logistic")


@query("svm_scores")
def svm_scores(spark, sf):
    return _fit_text(spark, sf, "word_svm")


@query("structured_logistic")
def structured_logistic(spark, sf):
    """All eight candidates are fitted; the one that ranks the validation part best scores it."""
    df = materialize(_structured(spark, sf), "structured")
    held = df.where("split = 'val'")
    models = training.structured_candidates(df.where("split = 'train'"), _NUMERIC, _CATEGORICAL)
    best, _ = training.choose_candidate(models, held, "pos")
    return best.score(held).select("pos", "label", "score")


@query("logistic_optima", """
WITH RECURSIVE m AS (SELECT median(cook_time_minutes) AS mt, median(calories) AS mc FROM candidates),
f AS (SELECT coalesce(cook_time_minutes, mt) AS t, coalesce(calories, mc) AS k,
        CASE WHEN ((pos * 7919 + coalesce(cook_time_minutes, 0.0) * 13)::BIGINT % 17) > 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM candidates, m),
g AS (SELECT avg(t) AS ta, stddev_pop(t) AS td, avg(k) AS ka, stddev_pop(k) AS kd, count(*) AS n, sum(y) AS n1 FROM f),
x AS (SELECT y, (t - ta) / td AS a, (k - ka) / kd AS b, n / (2 * CASE WHEN y > 0 THEN n1 ELSE n - n1 END) AS s FROM f, g),
newton AS (
  SELECT 0 AS step, c, balanced, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2
  FROM (SELECT unnest([0.01, 0.1, 1.0, 10.0]::DOUBLE[]) AS c), (SELECT unnest([false, true]) AS balanced)
  UNION ALL
  SELECT step + 1, c, balanced,
         w0 - (g0 * (e * i - f * f) - g1 * (b1 * i - c1 * f) + g2 * (b1 * f - c1 * e)) / det,
         w1 - (-g0 * (b1 * i - c1 * f) + g1 * (a1 * i - c1 * c1) - g2 * (a1 * f - b1 * c1)) / det,
         w2 - (g0 * (b1 * f - c1 * e) - g1 * (a1 * f - b1 * c1) + g2 * (a1 * e - b1 * b1)) / det
  FROM (
    SELECT *, a1 * (e * i - f * f) - b1 * (b1 * i - c1 * f) + c1 * (b1 * f - c1 * e) AS det FROM (
      SELECT step, c, balanced, w0, w1, w2, c * sum(r) AS g0, c * sum(r * a) + w1 AS g1, c * sum(r * b) + w2 AS g2,
             c * sum(h) AS a1, c * sum(h * a) AS b1, c * sum(h * b) AS c1, c * sum(h * a * a) + 1 AS e, c * sum(h * a * b) AS f, c * sum(h * b * b) + 1 AS i
      FROM (SELECT *, q * (p - y) AS r, q * p * (1 - p) AS h FROM (
        SELECT newton.*, y, a, b, CASE WHEN balanced THEN s ELSE 1.0 END AS q, 1 / (1 + exp(-(w0 + w1 * a + w2 * b))) AS p FROM newton, x WHERE step < 12))
      GROUP BY step, c, balanced, w0, w1, w2)))
SELECT c, balanced, round(w0, 6) AS intercept, round(w1, 6) AS cook_time_minutes, round(w2, 6) AS calories,
       round(any_value((w1 * w1 + w2 * w2) / 2) + c * sum(CASE WHEN balanced THEN s ELSE 1.0 END * ln(1 + exp(-(2 * y - 1) * (w0 + w1 * a + w2 * b)))), 4) AS objective
FROM newton, x WHERE step = 12 GROUP BY c, balanced, w0, w1, w2""", (CANDIDATES_SQL,))
def logistic_optima(spark, sf):
    """Optimal coefficients of all eight structured candidates, on two standardised inputs."""
    df = inputs.candidates(spark, sf).select(
        "pos", "cook_time_minutes", "calories",
        ((F.col("pos") * 7919 + F.coalesce("cook_time_minutes", F.lit(0.0)) * 13).cast("bigint") % 17 > 2).cast("int").alias("label"))
    models = training.structured_candidates(materialize(df, "structured"), _NUMERIC, [])
    rows = [(m.candidate.c, m.candidate.balanced, float(m.fit.w[2]), float(m.fit.w[0]), float(m.fit.w[1]), float(m.fit.objective)) for m in models]
    out = spark.createDataFrame(rows, "c double, balanced boolean, intercept double, cook_time_minutes double, calories double, objective double")
    return rounded(rounded(out, "intercept", "cook_time_minutes", "calories", digits=6), "objective", digits=4)


SIGNALS = 7
_SIGNALS_SQL = """signals AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN 1.0 ELSE -1.0 END::DOUBLE AS y, unnest(range(8)) AS i,
         unnest([ln(1 + n_chars) / 10, (lang = 'de')::INTEGER, (lang = 'fr')::INTEGER, (lang = 'es')::INTEGER, contains(text, '#')::INTEGER,
                 regexp_matches(text, '[0-9]')::INTEGER, least(1, (length(text) - length(replace(text, chr(10), ''))) / 10), 1]::DOUBLE[]) AS x
  FROM documents JOIN labels USING (doc_id))"""


def _signals(spark, sf) -> linear.Design:
    """Seven plain signals of labelled documents."""
    docs = inputs.table(spark, sf, "documents").join(inputs.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    values = [F.log(F.lit(1) + F.col("n_chars")) / 10, *[(F.col("lang") == x).cast("double") for x in ("de", "fr", "es")],
              F.contains("text", F.lit("#")).cast("double"), F.col("text").rlike("[0-9]").cast("double"), F.least(F.lit(1.0), lines / 10)]
    table = docs.select(F.col("quality").alias("y"), F.lit(1.0).alias("s"), F.sequence(F.lit(0), F.lit(SIGNALS - 1)).alias("indices"), F.array(*values).alias("weights"))
    return linear.Design(materialize(table, "signals"), SIGNALS)


@query("l1_optimum", """
WITH RECURSIVE scale AS (SELECT 0.25 * 3 * sum(x * x) AS l FROM signals),
r AS (
  SELECT 0 AS step, i, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM (SELECT unnest(range(8)) AS i)
  UNION ALL
  SELECT step + 1, i, nw, nw + 0.96 * (nw - w) FROM (
    SELECT step, r.i, w, sign(v - g / l) * greatest(abs(v - g / l) - 1 / l, 0) AS nw
    FROM r, scale, (
      SELECT d.i, sum(-3 * d.y / (1 + exp(d.y * m)) * d.x) AS g
      FROM signals d JOIN (SELECT doc_id, sum(x * v) AS m FROM signals JOIN r USING (i) GROUP BY doc_id) USING (doc_id) GROUP BY d.i) s
    WHERE s.i = r.i AND step < 2500)),
w AS (SELECT i, w FROM r WHERE step = 2500),
m AS (SELECT doc_id, y, y * sum(x * w) AS m FROM signals JOIN w USING (i) GROUP BY doc_id, y),
g AS (SELECT d.i, sum(-3 * d.y / (1 + exp(m)) * d.x) AS g FROM signals d JOIN m USING (doc_id) GROUP BY d.i),
u AS (SELECT m, (SELECT least(1, 1 / max(abs(g))) FROM g) / (1 + exp(m)) AS u FROM m),
gap AS (SELECT (SELECT sum(abs(w)) FROM w) + 3 * sum(ln(1 + exp(-m))) + 3 * sum(u * ln(u) + (1 - u) * ln(1 - u)) AS gap FROM u)
SELECT i::INTEGER AS input, round(w, 4) AS coefficient, round(CASE WHEN w <> 0 THEN abs(g + sign(w)) ELSE greatest(abs(g) - 1, 0) END, 3) AS residual, round(gap, 4) AS gap
FROM w JOIN g USING (i), gap""", (_SIGNALS_SQL,))
def l1_optimum(spark, sf):
    """Coefficients under an absolute penalty, the residual of optimality of each, and the bound on the distance to the optimum."""
    fit = linear.l1_logistic(_signals(spark, sf), 3.0)
    rows = [(i, float(w), float(r), fit.gap) for i, (w, r) in enumerate(zip(fit.w, fit.residual, strict=True))]
    out = spark.createDataFrame(rows, "input int, coefficient double, residual double, gap double")
    return rounded(rounded(out, "coefficient", "gap", digits=4), "residual", digits=3)


@query("hinge_optimum", """
WITH RECURSIVE scale AS (SELECT 1 + 0.2 * sum(x * x) AS l FROM signals),
r AS (
  SELECT 0 AS step, i, 0.0::DOUBLE AS w, 0.0::DOUBLE AS v FROM (SELECT unnest(range(8)) AS i)
  UNION ALL
  SELECT step + 1, i, nw, nw + (sqrt(l) - 1) / (sqrt(l) + 1) * (nw - w) FROM (
    SELECT step, r.i, w, l, v - (g + v) / l AS nw
    FROM r, scale, (
      SELECT d.i, sum(-0.2 * d.y * greatest(1 - d.y * m, 0) * d.x) AS g
      FROM signals d JOIN (SELECT doc_id, sum(x * v) AS m FROM signals JOIN r USING (i) GROUP BY doc_id) USING (doc_id) GROUP BY d.i) s
    WHERE s.i = r.i AND step < 900))
SELECT i::INTEGER AS input, round(w, 5) AS coefficient FROM r WHERE step = 900""", (_SIGNALS_SQL,))
def hinge_optimum(spark, sf):
    """Coefficients of the squared-hinge classifier."""
    fit = linear.newton_cg(_signals(spark, sf), 0.1, tol=1e-10)
    return rounded(spark.createDataFrame([(i, float(w)) for i, w in enumerate(fit.w)], "input int, coefficient double"), "coefficient", digits=5)


@query("ranker_optima")
def ranker_optima(spark, sf):
    """How near the tuned text rankers are to their optima: objective, largest residual, and with the absolute penalty the gap."""
    train = _texts(spark, sf).where("split = 'train'")
    rows = train.select("doc_id", "label")
    out = []
    for name in ("char_logistic", "word_svm"):
        spec = training.RANKERS[name]
        counts = training.text_counts(train, spec, "doc_id", "text")
        model = training.fit_counts(counts, rows.count(), spec.analyzer, spec.low, spec.high, spec.min_df, spec.sublinear)
        fit = training.fit_linear(training.text_design(rows, model.weights(counts, "doc_id", named=False), "doc_id", model.size), spec)
        out.append((name, float(fit.objective), float(fit.residual.max()), fit.gap, int((fit.w != 0).sum())))
    return spark.createDataFrame(out, "model string, objective double, residual double, gap double, non_zero int")


@query("gbt_scores")
def gbt_scores(spark, sf):
    df = materialize(_structured(spark, sf), "structured")
    fit = training.boosted_trees(maxIter=10, maxDepth=3, subsamplingRate=0.8)
    score = training.fit_structured(df.where("split = 'train'"), _NUMERIC, _CATEGORICAL, fit)
    return score(df.where("split = 'val'")).select("pos", "label", "score")


@query("grid_search")
def grid_search(spark, sf):
    """Structured logistic models over strengths, on fixed stratified folds."""
    train = _structured(spark, sf).where("split = 'train'")
    enc = encode.fit_encoder(train, _NUMERIC, _CATEGORICAL)
    data = sampling.fold_assignment(enc.transform(train).select("pos", "label", "features"), "label", "pos", 5)
    data = materialize(data, "folded")
    n = data.count()
    lr = LogisticRegression(maxIter=20, standardization=False)
    grid = [{lr.regParam: 1.0 / (c * n)} for c in (0.01, 0.1, 1.0, 10.0)]
    return training.grid_search(data, lr, grid, 5, 4)


@query("text_grid")
def text_grid(spark, sf):
    """Word rankers over ranges, vocabulary floors, term weights and strengths, with a ledger that a restart reads."""
    return training.tune_text(inputs.labelled_text(spark, sf), "doc_id", "text", "word", [(1, 1), (1, 2)], [1, 3], [False, True], "svm", [0.03, 0.3], n_folds=3,
                              ledger=scratch_path(spark, "ledger"))


@query("fold_vocabulary", """
WITH f AS (
  SELECT doc_id, text, repeat, (row_number() OVER (PARTITION BY repeat, label ORDER BY md5('42:' || repeat || ':' || doc_id), doc_id) - 1) % 5 AS fold
  FROM (SELECT doc_id, text, label, unnest(range(3)) AS repeat FROM labelled)),
w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM labelled),
train AS (SELECT f.doc_id, f.repeat, g.fold FROM f JOIN (SELECT unnest(range(5)) AS fold) g ON f.fold <> g.fold),
n AS (SELECT repeat, fold, count(*) AS n FROM train GROUP BY ALL)
SELECT repeat::INTEGER AS repeat, fold::INTEGER AS fold, term, count(*) AS df, round(ln((1.0 + any_value(n)) / (1.0 + count(*))::DOUBLE) + 1, 8) AS idf
FROM train JOIN w USING (doc_id) JOIN n USING (repeat, fold) GROUP BY repeat, fold, term HAVING count(*) >= 3""", (LABELLED_SQL,))
def fold_vocabulary(spark, sf):
    """Document frequency and IDF of each fold's training documents, for fifteen folds at once."""
    docs = inputs.labelled_text(spark, sf)
    folds = sampling.repeated_folds(docs, "label", "doc_id", 5, 3)
    counts = materialize(tfidf.text_term_counts(docs, "doc_id", "text", "word", 1, 1), "counts")
    return rounded(training.fold_vocabulary(counts, materialize(folds, "folds"), "doc_id", 3), "idf")


_CV_SPECS = {n: training.RANKERS[n] for n in ("word_logistic", "word_svm")}


@query("repeated_cv")
def repeated_cv(spark, sf):
    """Two rankers and their rank blend on identical folds, summarised per model."""
    auc, _ = training.repeated_cv(
        inputs.labelled_text(spark, sf), "doc_id", "text", _CV_SPECS, {},
        {"blend": {"word_logistic": 0.5, "word_svm": 0.5}}, n_folds=3, repeats=1)
    return evaluation.leaderboard(evaluation.fold_summary(auc), "model", "mean_auc")


@query("champion_requests")
def champion_requests(spark, sf):
    """The blended text champion ranks labelled documents within their source."""
    texts = _texts(spark, sf)
    champion = training.fit_champion(texts.where("split = 'train'"), "doc_id", "text")
    docs = inputs.table(spark, sf, "documents").select("doc_id", F.col("source").alias("request_id"))
    rest = texts.where("split <> 'train'").join(docs, "doc_id").select(
        "request_id", F.col("doc_id").alias("pos"), "doc_id", F.col("doc_id").cast("string").alias("recipe_id"),
        F.concat(F.lit("document "), F.col("doc_id").cast("string")).alias("title"), "text")
    best, counts = scoring.score_requests(
        rest, None, lambda df: champion.score(df, "doc_id", "text", ["request_id"]), top_k=5)
    return scoring.responses(best, counts)


@query("compare_models")
def compare_models(spark, sf):
    """Metric bundles of all four text rankers and of their blends on the held-out split, best first."""
    texts = _texts(spark, sf, F.concat(F.lit("/"), "lang", F.lit("/"), "source", F.lit("/")).alias("cuisine_path"))
    train, held = texts.where("split = 'train'"), texts.where("split = 'val'").drop("split")
    scores = training.validation_scores(train, held, "doc_id", "text")
    preds = {n: scores.select("doc_id", "label", "cuisine_path", F.col(n).alias("score")) for n in scores.columns if n not in held.columns}
    return training.compare_models(preds, "cuisine_path", "doc_id")
