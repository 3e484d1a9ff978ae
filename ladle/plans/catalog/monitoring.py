"""Batch quality, drift, fault injection, telemetry, streams and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import drift, inject, promotion, quality, ranks, scoring, telemetry
from ladle.plans import inputs, validation
from ladle.plans.catalog.registry import query, rounded
from ladle.plans.catalog.screening import MENU_SQL, menu
from ladle.plans.inputs import BATCH_SQL, CANDIDATES_SQL, DRIFT_SQL, REQUEST_LOG_SQL
from ladle.session import scratch_path
from ladle.streaming import sinks, sketches, windows

_DRIFT_COLUMNS = ["value", "spread"]


@query("range_check", """
WITH hits AS (
  SELECT 'cook_time_minutes' AS col, cook_time_minutes * 40 AS v, recipe_id FROM batch WHERE cook_time_minutes * 40 NOT BETWEEN 0 AND 1440
  UNION ALL SELECT 'calories', (calories - 905) * 100, recipe_id FROM batch WHERE (calories - 905) * 100 NOT BETWEEN 0 AND 5000)
SELECT col AS "column", count(*) AS affected_row_count,
       array_to_string(list(round(v, 4)::DECIMAL(18,4) ORDER BY recipe_id)[1:5], '|') AS examples FROM hits GROUP BY col""", (BATCH_SQL,))
def range_check(spark, sf):
    df = inputs.batch(spark, sf).withColumns({
        "cook_time_minutes": F.col("cook_time_minutes") * 40, "calories": (F.col("calories") - 905) * 100})
    out = quality.out_of_range(df, "recipe_id")
    texts = F.transform("example_values", lambda v: F.round(v, 4).cast("decimal(18,4)").cast("string"))
    return out.select("column", "affected_row_count", F.array_join(texts, "|").alias("examples"))


_CHOSEN = """chosen AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || recipe_id), recipe_id) AS r, count(*) OVER () AS n FROM batch)"""


@query("null_spike", """
WITH f AS (SELECT cook_time_minutes AS ref_t, calories AS ref_c,
    CASE WHEN r > greatest(1, floor(n * 0.25::DOUBLE)) THEN cook_time_minutes END AS t,
    CASE WHEN r > greatest(1, floor(n * 0.25::DOUBLE)) THEN calories END AS c FROM chosen),
g AS (SELECT 'cook_time_minutes' AS "column", round(avg((ref_t IS NULL)::INTEGER), 8) AS reference_rate, round(avg((t IS NULL)::INTEGER), 8) AS current_rate FROM f
UNION ALL SELECT 'calories', round(avg((ref_c IS NULL)::INTEGER), 8), round(avg((c IS NULL)::INTEGER), 8) FROM f)
SELECT * FROM g WHERE current_rate - reference_rate > 0.15""", (BATCH_SQL, _CHOSEN))
def null_spike(spark, sf):
    clean = inputs.batch(spark, sf)
    return rounded(quality.null_spikes(inject.fault_nulls(clean), clean), "reference_rate", "current_rate")


@query("batch_verdict", """
SELECT count(*) > 0 AS anomaly_detected, count(*) AS issue_count FROM (
  SELECT 1 FROM batch HAVING count(*) FILTER (cook_time_minutes * 40 NOT BETWEEN 0 AND 1440) > 0
  UNION ALL SELECT 1 FROM batch HAVING count(*) FILTER (calories NOT BETWEEN 0 AND 5000) > 0)""", (BATCH_SQL,))
def batch_verdict(spark, sf):
    clean = inputs.batch(spark, sf)
    current = clean.withColumn("cook_time_minutes", F.col("cook_time_minutes") * 40)
    return quality.verdict(quality.batch_findings(current, clean, "recipe_id"))


@query("fault_nulls", """
SELECT recipe_id, CASE WHEN r > k THEN cook_time_minutes END AS cook_time_minutes,
       CASE WHEN r > k THEN calories END AS calories, r <= k AS affected
FROM (SELECT *, greatest(1, floor(n * 0.25::DOUBLE)) AS k FROM chosen)""", (BATCH_SQL, _CHOSEN))
def fault_nulls(spark, sf):
    return inject.fault_nulls(inputs.batch(spark, sf)).drop("ingredients_parsed")


@query("fault_ranges", """
SELECT recipe_id, CASE WHEN r <= floor(k / 2) THEN -(h % 55 + 5)::DOUBLE ELSE cook_time_minutes END AS cook_time_minutes,
       CASE WHEN r > floor(k / 2) AND r <= k THEN (h % 150000 + 50000)::DOUBLE ELSE calories END AS calories, r <= k AS affected
FROM (SELECT *, greatest(1, floor(n * 0.2::DOUBLE)) AS k,
        ('0x' || substr(md5('42:value:' || recipe_id), 25, 8))::BIGINT AS h FROM chosen)""", (BATCH_SQL, _CHOSEN))
def fault_ranges(spark, sf):
    return inject.fault_ranges(inputs.batch(spark, sf)).drop("ingredients_parsed")


@query("column_swap", """
SELECT recipe_id, calories AS cook_time_minutes, cook_time_minutes AS calories, true AS affected FROM batch""", (BATCH_SQL,))
def column_swap(spark, sf):
    return inject.column_swap(inputs.batch(spark, sf)).drop("ingredients_parsed")


@query("column_change", "SELECT recipe_id, cook_time_minutes AS cook_minutes, true AS affected FROM batch", (BATCH_SQL,))
def column_change(spark, sf):
    return inject.column_change(inputs.batch(spark, sf)).drop("ingredients_parsed")


@query("fault_manifest", """
SELECT 'missing_values' AS corruption_type, recipe_id FROM chosen WHERE r <= greatest(1, floor(n * 0.25::DOUBLE))
UNION ALL SELECT 'out_of_range', recipe_id FROM chosen WHERE r <= greatest(1, floor(n * 0.2::DOUBLE))
UNION ALL SELECT 'schema_swap', recipe_id FROM batch UNION ALL SELECT 'schema_change', recipe_id FROM batch""", (BATCH_SQL, _CHOSEN))
def fault_manifest(spark, sf):
    clean = inputs.batch(spark, sf)
    parts = [
        inject.manifest(inject.fault_nulls(clean), "missing_values"),
        inject.manifest(inject.fault_ranges(clean), "out_of_range"),
        inject.manifest(inject.column_swap(clean), "schema_swap"),
        inject.manifest(inject.column_change(clean), "schema_change"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CDF = """steps AS (
  SELECT col, v, sum(cur) OVER w / sum(cur) OVER p::DOUBLE - sum(ref) OVER w / sum(ref) OVER p::DOUBLE AS gap,
         sum(cur) OVER p AS n_cur, sum(ref) OVER p AS n_ref, lead(v) OVER (PARTITION BY col ORDER BY v) AS nxt
  FROM (SELECT col, v, count(*) FILTER (cur) AS cur, count(*) FILTER (NOT cur) AS ref FROM sides GROUP BY col, v)
  WINDOW w AS (PARTITION BY col ORDER BY v), p AS (PARTITION BY col))"""


@query("ks_drift", """
SELECT col AS "column", n_cur::BIGINT AS n_current, n_ref::BIGINT AS n_reference, round(d, 8) AS statistic, round(p, 8) AS p_value, p < 0.05 AS drifted
FROM (SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
        lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE * exp(-2.0::DOUBLE * k * k * x * x))), 0.0), 1.0) END AS p
  FROM (SELECT col, max(n_cur) AS n_cur, max(n_ref) AS n_ref, max(abs(gap)) AS d,
        sqrt(max(n_cur)::DOUBLE * max(n_ref) / (max(n_cur) + max(n_ref))) * max(abs(gap)) AS x FROM steps GROUP BY col))""",
       (DRIFT_SQL, CDF))
def ks_drift(spark, sf):
    ref, cur = inputs.drift_sides(spark, sf)
    return rounded(drift.ks_drift(cur, ref, _DRIFT_COLUMNS), "statistic", "p_value")


WASSERSTEIN = """distances AS (
  SELECT s.col, s.d / greatest(r.dev, 0.001) AS statistic, s.n_ref FROM
    (SELECT col, sum(abs(gap) * (nxt - v)) AS d, max(n_ref) AS n_ref FROM steps GROUP BY col) s
    JOIN (SELECT col, stddev_pop(v) AS dev FROM sides WHERE NOT cur GROUP BY col) r USING (col))"""


@query("wasserstein_drift", """
SELECT col AS "column", round(statistic, 8) AS statistic, statistic >= 0.1 AS drifted FROM distances""",
       (DRIFT_SQL, CDF, WASSERSTEIN))
def wasserstein_drift(spark, sf):
    ref, cur = inputs.drift_sides(spark, sf)
    return rounded(drift.wasserstein_drift(cur, ref, _DRIFT_COLUMNS), "statistic")


@query("dataset_drift", """
SELECT avg((statistic >= 0.1)::INTEGER)::DOUBLE AS drifted_column_share, avg((statistic >= 0.1)::INTEGER) > 0.5 AS dataset_drift_detected
FROM distances""", (DRIFT_SQL, CDF, WASSERSTEIN))
def dataset_drift(spark, sf):
    ref, cur = inputs.drift_sides(spark, sf)
    return drift.dataset_drift(drift.wasserstein_drift(cur, ref, _DRIFT_COLUMNS))


ALERTS = """faulted AS (
  SELECT recipe_id, cook_time_minutes AS t, calories AS c, r <= greatest(1, floor(n * 0.25::DOUBLE)) AS hit_null,
         r <= floor(k / 2) AS hit_t, r > floor(k / 2) AND r <= k AS hit_c, h
  FROM (SELECT *, greatest(1, floor(n * 0.2::DOUBLE)) AS k,
          ('0x' || substr(md5('42:value:' || recipe_id), 25, 8))::BIGINT AS h FROM chosen)),
cases AS (
  SELECT 'clean_baseline' AS s, t, c, t AS ref_t, c AS ref_c FROM faulted
  UNION ALL SELECT 'missing_values', CASE WHEN NOT hit_null THEN t END, CASE WHEN NOT hit_null THEN c END, t, c FROM faulted
  UNION ALL SELECT 'out_of_range', CASE WHEN hit_t THEN -(h % 55 + 5) ELSE t END, CASE WHEN hit_c THEN h % 150000 + 50000 ELSE c END, t, c FROM faulted
  UNION ALL SELECT 'schema_swap', c, t, t, c FROM faulted),
issues AS (
  SELECT s, (count(*) FILTER (t NOT BETWEEN 0 AND 1440) > 0)::BIGINT + (count(*) FILTER (c NOT BETWEEN 0 AND 5000) > 0)::BIGINT
    + (avg((t IS NULL)::INTEGER) - avg((ref_t IS NULL)::INTEGER) > 0.15)::BIGINT
    + (avg((c IS NULL)::INTEGER) - avg((ref_c IS NULL)::INTEGER) > 0.15)::BIGINT AS i FROM cases GROUP BY s
  UNION ALL SELECT 'schema_change', 2),
points AS (
  SELECT s, 't' AS col, t AS v, 1 AS cur FROM cases UNION ALL SELECT s, 'c', c, 1 FROM cases
  UNION ALL SELECT s, 't', ref_t, 0 FROM cases UNION ALL SELECT s, 'c', ref_c, 0 FROM cases),
gaps AS (
  SELECT s, col, v, abs(sum(n_cur) OVER w / sum(n_cur) OVER p::DOUBLE - sum(n_ref) OVER w / sum(n_ref) OVER p::DOUBLE) AS gap,
         sum(n_cur) OVER p AS n, sum(n_ref) OVER p AS m, lead(v) OVER (PARTITION BY s, col ORDER BY v) - v AS width
  FROM (SELECT s, col, v, sum(cur) AS n_cur, sum(1 - cur) AS n_ref FROM points WHERE v IS NOT NULL GROUP BY s, col, v)
  WINDOW w AS (PARTITION BY s, col ORDER BY v), p AS (PARTITION BY s, col)),
tests AS (
  SELECT s, col, sum(gap * width) / greatest(any_value(dev), 0.001) AS dist
  FROM gaps JOIN (SELECT s, col, stddev_pop(v) AS dev FROM points WHERE cur = 0 GROUP BY s, col) USING (s, col) GROUP BY s, col),
found AS (
  SELECT s, avg((dist >= 0.1)::INTEGER) > 0.5 AS f FROM tests GROUP BY s)"""


@query("alert_verification", """
SELECT s AS scenario, s <> 'clean_baseline' AS expected_anomaly, i > 0 OR coalesce(f, false) AS detected_anomaly,
       (i > 0 OR coalesce(f, false)) = (s <> 'clean_baseline') AS correctly_classified, i::BIGINT AS quality_check_issues,
       coalesce(f, false) AS dataset_drift_detected
FROM issues LEFT JOIN found USING (s)""", (BATCH_SQL, _CHOSEN, ALERTS))
def alert_verification(spark, sf):
    return validation.alert_verification(inputs.batch(spark, sf))


@query("production_auc", """
WITH scored AS (
  SELECT *, (row_number() OVER (ORDER BY pos) - 1) // 20 AS b, (pos % 3 > 0)::INTEGER AS label FROM candidates),
told AS (
  SELECT label, b, calories, CASE WHEN calories IS NOT NULL THEN (rank() OVER (PARTITION BY b, calories IS NULL ORDER BY calories)
             + (count(*) OVER (PARTITION BY b, calories) - 1) / 2.0::DOUBLE) / count(calories) OVER (PARTITION BY b)
             * CASE WHEN pos % 10 = 0 THEN 0.5 ELSE 1.0 END END AS score FROM scored)
SELECT count(*) AS candidates_sent, count(score) AS candidates_scored, count(*) - count(score) AS candidates_missing_prediction,
   round(avg(score), 8) AS mean_score, round(max(score), 8) AS max_score,
   round((sum(CASE WHEN label = 1 THEN rk END) - sum(label) FILTER (score IS NOT NULL) * (sum(label) FILTER (score IS NOT NULL) + 1) / 2.0::DOUBLE)
     / ((sum(label) FILTER (score IS NOT NULL))::DOUBLE * (count(score) - sum(label) FILTER (score IS NOT NULL))), 8) AS production_roc_auc,
   0.5::DOUBLE AS offline_validation_roc_auc, round(production_roc_auc - 0.5::DOUBLE, 8) AS auc_delta, count(*) = count(score) AS passed,
   (SELECT round(avg(v), 8) FROM (SELECT DISTINCT b, (b % 7 * 10)::DOUBLE AS v FROM told WHERE calories IS NOT NULL)) AS mean_batch_value,
   (SELECT max((b % 7 * 10)::DOUBLE) FROM told WHERE calories IS NOT NULL) AS max_batch_value
FROM (SELECT label, score, CASE WHEN score IS NOT NULL THEN rank() OVER (ORDER BY score NULLS LAST)
             + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE END AS rk FROM told)""", (CANDIDATES_SQL,))
def production_auc(spark, sf):
    """A tenth of the candidates is returned twice, some are not returned; the last returned score counts."""
    rows = inputs.candidates(spark, sf).select(
        "recipe_id", "pos", "calories", (F.col("pos") % 3 > 0).cast("int").alias("label"))

    def by_batch(batched):
        once = ranks.rank_pct(batched, "calories", "score", ["batch_id"]).where("score IS NOT NULL")
        once = once.withColumns({"returned": F.col("pos"), "latency_ms": (F.col("batch_id") % 7 * 10).cast("double")})
        again = once.where("pos % 10 = 0").withColumns({"score": F.col("score") * 0.5, "returned": F.col("pos") + 1_000_000_000_000})
        return once.unionByName(again)

    out = validation.production_validation(rows, by_batch, offline_auc=0.5, batch_value="latency_ms")
    return rounded(out, "mean_score", "max_score", "production_roc_auc", "auc_delta", "mean_batch_value")


@query("telemetry_overall", """
SELECT count(*) AS request_count, count(*) FILTER (status_code >= 500) AS error_count,
       round(count(*) FILTER (status_code >= 500) / count(*)::DOUBLE, 4) AS error_rate, round(avg(latency_ms), 2) AS mean_ms,
       round(list(latency_ms ORDER BY latency_ms)[least(count(*), floor(count(*) * 0.5::DOUBLE)::BIGINT + 1)], 2) AS p50_ms,
       round(list(latency_ms ORDER BY latency_ms)[least(count(*), floor(count(*) * 0.95::DOUBLE)::BIGINT + 1)], 2) AS p95_ms
FROM request_log""", (REQUEST_LOG_SQL,))
def telemetry_overall(spark, sf):
    return telemetry.telemetry_overall(inputs.request_log(spark, sf))


@query("telemetry_by_path", """
SELECT method || ' ' || path AS endpoint, count(*) AS count, count(*) FILTER (status_code >= 500) AS error_count,
       round(avg(latency_ms), 2) AS mean_latency_ms,
       round(list(latency_ms ORDER BY latency_ms)[least(count(*), floor(count(*) * 0.95::DOUBLE)::BIGINT + 1)], 2) AS p95_latency_ms
FROM request_log GROUP BY method, path""", (REQUEST_LOG_SQL,))
def telemetry_by_path(spark, sf):
    return telemetry.telemetry_by_path(inputs.request_log(spark, sf))


@query("recent_requests", """
SELECT event_id, path, latency_ms FROM request_log ORDER BY ts DESC, event_id DESC LIMIT 2000""", (REQUEST_LOG_SQL,))
def recent_requests(spark, sf):
    return telemetry.recent_requests(inputs.request_log(spark, sf)).select("event_id", "path", "latency_ms")


def _stream(spark, sf, width, slide=None):
    schema = inputs.table(spark, sf, "events").schema
    events = windows.stream_table(spark, sf, schema, "events.parquet")
    log = events.select(
        F.concat(F.lit("/"), "event_type").alias("path"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.col("value").alias("latency_ms"), "ts")
    out = sinks.replay(windows.windowed_telemetry(log, width, slide))
    return rounded(out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
                   .drop("window_end"), "mean_ms", digits=6)


_CLOSED = """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, path, count(*) AS request_count,
       count(*) FILTER (status_code >= 500) AS error_count,
       round(count(*) FILTER (status_code >= 500) / count(*)::DOUBLE, 4) AS error_rate, round(avg(latency_ms), 6) AS mean_ms,
       list(latency_ms ORDER BY latency_ms)[ceil(count(latency_ms) * 0.95::DOUBLE)::BIGINT] AS p95_ms
FROM windows WHERE w + INTERVAL {width} <= (SELECT max(ts) FROM request_log) - INTERVAL 10 MINUTE GROUP BY w, path"""


@query("telemetry_windows", _CLOSED.format(width="1 DAY"), (REQUEST_LOG_SQL, """windows AS (
  SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS w FROM request_log)"""))
def telemetry_windows(spark, sf):
    """Tumbling windows replayed as a stream; the last, open window is not emitted."""
    return _stream(spark, sf, "1 day")


@query("telemetry_sliding", _CLOSED.format(width="2 DAY"), (REQUEST_LOG_SQL, """windows AS (
  SELECT *, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS w FROM request_log)"""))
def telemetry_sliding(spark, sf):
    return _stream(spark, sf, "2 days", "1 day")


@query("stream_quarantine", """
SELECT event_id, 'negative or huge value' AS errors FROM events WHERE value > 40""")
def stream_quarantine(spark, sf):
    """Rejected rows of an event stream, as its quarantine sink holds them."""
    schema = inputs.table(spark, sf, "events").schema
    events = windows.stream_table(spark, sf, schema, "events.parquet")
    bad = F.filter(F.array(F.when(F.col("value") > 40, F.lit("negative or huge value"))), lambda e: e.isNotNull())
    out = scratch_path(spark, "quarantine")
    sinks.quarantine_stream(events, bad, out, scratch_path(spark, "quarantine-state"), True).awaitTermination()
    rejected = spark.read.parquet(out).where("NOT valid")
    return rejected.select("event_id", F.array_join("errors", "|").alias("errors"))


@query("stream_item_quarantine", """
SELECT pos, errors = '' AS valid, errors FROM (
  SELECT pos, concat_ws('|',
   CASE WHEN trim(title) = '' THEN 'no title' END,
   CASE WHEN trim(ingredients) = '' THEN 'no ingredients' END,
   CASE WHEN calories = 'many' THEN 'calories are no number: many'
        WHEN TRY_CAST(calories AS DOUBLE) < 0 THEN 'calories below zero'
        WHEN TRY_CAST(calories AS DOUBLE) > 25000 THEN 'calories above 25000' END) AS errors FROM menu)""", (CANDIDATES_SQL, MENU_SQL))
def stream_item_quarantine(spark, sf):
    """Every row of a stream of raw items, judged by the item rules, from whichever sink holds it."""
    parts = windows.stream_table(spark, sf, inputs.table(spark, sf, "part").schema, "part.parquet")
    out = scratch_path(spark, "quarantine")
    sinks.quarantine_stream(menu(spark, sf, parts), scoring.raw_errors(), out, scratch_path(spark, "quarantine-state"), True).awaitTermination()
    return spark.read.parquet(out).select("pos", F.col("valid").cast("boolean").alias("valid"), F.array_join("errors", "|").alias("errors"))


@query("stream_monitor", """
SELECT count(*) AS row_count, 0::BIGINT AS issue_count FROM batch""", (BATCH_SQL,))
def stream_monitor(spark, sf):
    """Quality findings of one micro-batch of parts against a reference half."""
    schema = inputs.table(spark, sf, "part").schema
    parts = windows.stream_table(spark, sf, schema, "part.parquet")
    as_batch = parts.select(
        F.concat(F.lit("test_"), F.col("p_partkey").cast("string")).alias("recipe_id"), F.col("p_name").alias("ingredients_parsed"),
        F.col("p_size").cast("double").alias("cook_time_minutes"), F.col("p_retailprice").alias("calories"))
    reference = inputs.batch(spark, sf)
    out = scratch_path(spark, "monitor")
    sinks.monitor_stream(as_batch, reference, "recipe_id", ["cook_time_minutes", "calories"], out,
                         scratch_path(spark, "monitor-state"), True).awaitTermination()
    return spark.read.parquet(out).select("row_count", "issue_count")


@query("window_drift", """
WITH b AS (SELECT event_id % 4 AS b, unnest(['value', 'spread']) AS "column", unnest([value, (event_id % 97)::DOUBLE]) AS v FROM events)
SELECT e AS batch_id, "column", count(v) AS n_current, (SELECT count(v) FROM b r WHERE r.b = 0 AND r."column" = b."column") AS n_reference, true AS holds
FROM b, (SELECT unnest(range(4)) AS e) WHERE b.b BETWEEN e - 1 AND e GROUP BY "column", e""")
def window_drift(spark, sf):
    """Four micro-batches stored as sketches; for each run of two whether the exact distance to the first batch lies within the bound."""
    events = inputs.table(spark, sf, "events").select((F.col("event_id") % 4).alias("b"), "value", (F.col("event_id") % 97).cast("double").alias("spread"))
    src, out = scratch_path(spark, "batches"), scratch_path(spark, "sketches")
    for i in range(4):  # a file a batch, in order
        events.where(F.col("b") == i).coalesce(1).write.mode("append").parquet(src)
    stream = windows.stream_table(spark, src, events.schema, files_per_batch=1)
    sketches.sketch_stream(stream, _DRIFT_COLUMNS, out, scratch_path(spark, "sketches-state"), True).awaitTermination()
    first = events.where("b = 0")
    reference = sketches.sketches(first, _DRIFT_COLUMNS)
    told = sketches.sketch_drift(sketches.last_batches(sketches.stored(spark, out), 2), reference, ["batch_id"])
    exact = None
    for end in range(4):
        part = drift.ks_drift(events.where(F.col("b").between(end - 1, end)), first, _DRIFT_COLUMNS).select(F.lit(end).cast("bigint").alias("batch_id"), "column", "statistic")
        exact = part if exact is None else exact.union(part)
    near = F.abs(F.col("distance") - F.col("statistic")) <= F.col("bound")
    return told.join(exact, ["batch_id", "column"]).select("batch_id", "column", "n_current", "n_reference", near.alias("holds"))


RUNS_SQL = """runs AS (
  SELECT o_orderkey::VARCHAR AS run_id, o_orderpriority AS run_name, CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' ELSE 'FAILED' END AS status,
         o_orderdate AS start_time, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice / 1000000.0::DOUBLE END AS auc FROM orders)"""


def _runs(spark, sf):
    return inputs.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("run_name"),
        F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("FAILED").alias("status"),
        F.col("o_orderdate").alias("start_time"),
        F.create_map(F.lit("validation_roc_auc"),
                     F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") / 1000000.0)).alias("metrics"))


def _registry(spark, sf):
    c = inputs.table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("version"), F.col("c_name").alias("run_id"), (F.col("c_acctbal") / 100000.0).alias("metric_value"),
        F.lower("c_mktsegment").alias("alias"), F.col("c_nationkey").alias("promoted_at"))


@query("promotion_decision", """
WITH best AS (SELECT * FROM runs WHERE run_name = '1-URGENT' AND status = 'FINISHED' ORDER BY start_time DESC, run_id DESC LIMIT 1),
champ AS (SELECT c_acctbal / 100000.0::DOUBLE AS v FROM customer WHERE c_mktsegment = 'MACHINERY' ORDER BY c_nationkey DESC, c_custkey DESC LIMIT 1)
SELECT run_id, auc AS candidate, v AS champion, CASE WHEN auc IS NULL THEN 'skipped: missing validation metric'
   WHEN auc > v THEN 'promoted' ELSE 'skipped: no improvement' END AS decision FROM best, champ""", (RUNS_SQL,))
def promotion_decision(spark, sf):
    return promotion.promotion_decision(_runs(spark, sf), _registry(spark, sf), "1-URGENT", "validation_roc_auc", "machinery")


@query("champion_registry", """
WITH best AS (SELECT * FROM runs WHERE run_name = '1-URGENT' AND status = 'FINISHED' ORDER BY start_time DESC, run_id DESC LIMIT 1),
rows AS (SELECT c_custkey AS version, c_name AS run_id, c_acctbal / 100000.0::DOUBLE AS metric_value, c_nationkey AS promoted_at
         FROM customer WHERE c_mktsegment = 'MACHINERY'),
champ AS (SELECT * FROM rows ORDER BY promoted_at DESC, version DESC LIMIT 1)
SELECT version, run_id, metric_value, target, approved FROM (
  SELECT *, NULL AS target, NULL AS approved, 0 AS o FROM champ
  UNION ALL SELECT (SELECT max(c_custkey) + 1 FROM customer), b.run_id, b.auc, 99, 'rating>=4', 'yes', 1 FROM best b, champ c WHERE b.auc > c.metric_value)
ORDER BY o DESC LIMIT 1""", (RUNS_SQL,))
def champion_registry(spark, sf):
    registry = _registry(spark, sf)
    gate = promotion.promotion_decision(_runs(spark, sf), registry, "1-URGENT", "validation_roc_auc", "machinery")
    added = promotion.register(registry, gate, "machinery", F.lit(99), {"target": "rating>=4", "approved": "yes"})
    now = promotion.current_champion(registry.withColumn("tags", F.lit(None).cast("map<string,string>")).unionByName(added), "machinery")
    return now.select("version", "run_id", "metric_value", *[F.try_element_at("tags", F.lit(t)).alias(t) for t in ("target", "approved")])
