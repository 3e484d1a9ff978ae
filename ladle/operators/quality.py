"""Data-quality rules, gates, quarantine and batch checks. Findings stay tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ladle.functions import fixed
from ladle.functions.text import duration_minutes
from ladle.operators.dedupe import duplicate_count
from ladle.sources.readers import file_exists

FINDING = "`column` string, `check` string, failure_case string, row_id string"


@dataclass(frozen=True)
class ColumnRule:
    """What a column must be: type family, nullability and named value checks (true = good)."""

    column: str
    kind: str | None = "string"
    nullable: bool = True
    checks: Mapping[str, Column] = field(default_factory=dict)


_KINDS = {
    "string": ("string", "varchar", "char"),
    "int": ("tinyint", "smallint", "int", "bigint"),
    "float": ("float", "double"),
}


def _nonempty(c: str) -> dict[str, Column]:
    return {"str_length(1, None)": F.char_length(F.col(c)) >= 1}


def item_rules() -> list[ColumnRule]:
    """Rules of the rated item table; extra columns are allowed."""
    return [
        ColumnRule("recipe_name", nullable=False),
        ColumnRule("prep_time"),
        ColumnRule("cook_time"),
        ColumnRule("total_time"),
        ColumnRule("servings", "int", False, {"greater_than(0)": F.col("servings") > 0}),
        ColumnRule("yield"),
        ColumnRule("ingredients", nullable=False, checks=_nonempty("ingredients")),
        ColumnRule("directions", nullable=False, checks=_nonempty("directions")),
        ColumnRule("rating", "float", False, {"in_range(0, 5)": F.col("rating").between(0, 5)}),
        ColumnRule("url", nullable=False, checks={"str_startswith('http')": F.col("url").startswith("http")}),
        ColumnRule("cuisine_path", nullable=False),
        ColumnRule("nutrition", nullable=False),
        ColumnRule("timing", nullable=False),
        ColumnRule("img_src"),
    ]


def candidate_file_rules() -> list[ColumnRule]:
    """Rules of the unrated candidate table with its capitalised headers."""
    return [
        ColumnRule("Name", nullable=False),
        ColumnRule("Prep Time"),
        ColumnRule("Cook Time"),
        ColumnRule("Total Time"),
        ColumnRule("Servings", None),
        ColumnRule("Ingredients", nullable=False, checks=_nonempty("Ingredients")),
        ColumnRule("Directions", nullable=False, checks=_nonempty("Directions")),
        ColumnRule("url", nullable=False, checks={"str_startswith('http')": F.col("url").startswith("http")}),
    ]


def request_rules() -> list[ColumnRule]:
    """Contract of a scoring request's candidates."""
    tags = F.array(*[F.lit(t) for t in fixed.TAG_NAMES])
    given = F.coalesce(F.col("dietary_tags"), F.array().cast("array<string>"))
    return [
        ColumnRule("recipe_id", nullable=False),
        ColumnRule("ingredients_parsed", nullable=False),
        ColumnRule("cook_time_minutes", None, True, {"ge(0)": F.col("cook_time_minutes") >= 0}),
        ColumnRule("calories", None, True, {"ge(0)": F.col("calories") >= 0}),
        ColumnRule("dietary_tags", None, True, {"enum": F.size(F.array_except(given, tags)) == 0}),
    ]


def request_level_rules() -> list[ColumnRule]:
    """Contract of a scoring request itself: its limits, its tags, at least one candidate and at least one result."""
    tags = F.array(*[F.lit(t) for t in fixed.TAG_NAMES])
    asked = F.coalesce(F.col("required_dietary_tags"), F.array().cast("array<string>"))
    return [
        ColumnRule("max_calories", None, True, {"ge(0)": F.col("max_calories") >= 0}),
        ColumnRule("max_cook_time_minutes", None, True, {"ge(0)": F.col("max_cook_time_minutes") >= 0}),
        ColumnRule("required_dietary_tags", None, True, {"enum": F.size(F.array_except(asked, tags)) == 0}),
        ColumnRule("n_candidates", None, False, {"ge(1)": F.col("n_candidates") >= 1}),
        ColumnRule("top_k", None, True, {"ge(1)": F.col("top_k") >= 1}),
    ]


def table_findings(spark: SparkSession, paths: Mapping[str, str], gating: bool = True) -> DataFrame:
    """A finding for each named table whose path is not there: critical if later stages need it, else a warning. Nothing is read; a table that
    is there gives no row."""
    absent = [(None, "table_exists", name, None) for name, path in paths.items() if not file_exists(spark, path)]
    return gate(spark.createDataFrame(absent, FINDING), gating)


def column_findings(df: DataFrame, rules: Sequence[ColumnRule]) -> list[tuple[str, str, str]]:
    """Missing columns and wrong types, from the schema alone."""
    types = dict(df.dtypes)
    out = []
    for r in rules:
        if r.column not in types:
            out.append((r.column, "column_in_dataframe", r.column))
        elif r.kind and not types[r.column].startswith(_KINDS[r.kind]):
            out.append((r.column, f"dtype('{r.kind}')", types[r.column]))
    return out


def check_rules(df: DataFrame, rules: Sequence[ColumnRule], row_id: str) -> DataFrame:
    """All failures as rows ``(column, check, failure_case, row_id)``, collected in one pass over the table."""
    spark = df.sparkSession
    schema_level = column_findings(df, rules)
    bad_columns = {c for c, _, _ in schema_level}
    found = []
    for r in rules:
        if r.column in bad_columns:
            continue
        value = F.col(f"`{r.column}`")

        def finding(check: str, column: str = r.column, value: Column = value) -> Column:
            return F.struct(
                F.lit(column).alias("column"), F.lit(check).alias("check"), value.cast("string").alias("failure_case")
            )

        if not r.nullable:
            found.append(F.when(value.isNull(), finding("not_nullable")))
        for name, good in r.checks.items():
            found.append(F.when(value.isNotNull() & ~F.coalesce(good, F.lit(False)), finding(name)))
    rows = None
    if found:
        cases = F.filter(F.array(*found), lambda f: f.isNotNull())
        rows = df.select(F.explode(cases).alias("f"), F.col(row_id).cast("string").alias("row_id")).select(
            "f.column", "f.check", "f.failure_case", "row_id"
        )
    if schema_level or rows is None:
        head = spark.createDataFrame([(c, k, v, None) for c, k, v in schema_level], FINDING)
        rows = head if rows is None else head.unionByName(rows)
    return rows


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_rate) for all columns in one pass; absent columns are skipped. NaN counts as missing."""
    cols = [c for c in (columns or df.columns) if c in df.columns]
    kinds = dict(df.dtypes)

    def missing(c: str) -> Column:
        col = F.col(f"`{c}`")
        return col.isNull() | F.isnan(col) if kinds[c] in ("double", "float") else col.isNull()

    one = df.agg(*[F.avg(missing(c).cast("double")).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_rate")) for c in cols])
    return one.select(F.explode(pairs).alias("p")).select("p.column", "p.null_rate")


def null_rate_warnings(df: DataFrame, columns: Sequence[str], above: float = fixed.NULL_WARN) -> DataFrame:
    return null_rates(df, columns).where(F.col("null_rate") > above)


def duplicate_warning(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of repeats, or none when every key is unique."""
    return duplicate_count(df, keys).where("duplicate_count > 0").select("duplicate_count")


def gate(findings: DataFrame, gating: bool = True) -> DataFrame:
    """Findings with severity: critical for a gating table, warning otherwise."""
    return findings.withColumn("severity", F.lit("critical" if gating else "warning"))


class GateFailed(RuntimeError):
    """Validation found critical failures; later stages must not run."""


def require_passed(findings: DataFrame) -> None:
    """Raise when any critical finding exists; only one row is looked at."""
    first = findings.where(F.col("severity") == "critical").limit(1).collect()
    if first:
        raise GateFailed(f"validation failed: {first[0].asDict()}")


def schema_contract(df: DataFrame, required: Sequence[str] = tuple(fixed.REQUIRED_COLUMNS)) -> list[tuple]:
    return [
        ("schema_contract", c, "required column is missing from the current batch") for c in required
        if c not in df.columns
    ]


def out_of_range(
    df: DataFrame, order: str, bounds: Mapping[str, tuple[float, float]] = fixed.PLAUSIBLE, examples: int = 5
) -> DataFrame:
    """Per column the number of values outside inclusive bounds and the first few in row order.

    NULL is not out of range. Only the first examples per column and task are moved.
    """
    cols = [c for c in bounds if c in df.columns]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame(
            [], "`column` string, affected_row_count bigint, example_values array<double>")
    bad = F.filter(
        F.array(*[
            F.when(
                (F.col(c) < F.lit(float(bounds[c][0]))) | (F.col(c) > F.lit(float(bounds[c][1]))),
                F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")),
            )
            for c in cols
        ]),
        lambda x: x.isNotNull(),
    )
    hits = df.select(F.explode(bad).alias("b"), F.col(order).alias("o")).select("b.column", "b.value", "o")
    counts = hits.groupBy("column").agg(F.count(F.lit(1)).alias("affected_row_count"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy("o"))
    first = (
        hits.withColumn("__rn", rank)
        .where(F.col("__rn") <= examples)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("__rn", "value"))).alias("x"))
        .select("column", F.col("x.value").alias("example_values"))
    )
    return counts.join(first, "column")


def range_findings(df: DataFrame, order: str, bounds: Mapping[str, tuple[float, float]] = fixed.PLAUSIBLE) -> DataFrame:
    """Range check as findings ``(check, column, issue, affected_row_count)``."""
    text = F.lit(None).cast("string")
    for c, (low, high) in bounds.items():
        msg = F.concat(F.col("affected_row_count").cast("string"),
                       F.lit(f" value(s) not within {low:g} to {high:g}"))
        text = F.when(F.col("column") == c, msg).otherwise(text)
    return out_of_range(df, order, bounds).select(
        F.lit("range").alias("check"), "column", text.alias("issue"), "affected_row_count"
    )


def null_spikes(
    current: DataFrame,
    reference: DataFrame,
    columns: Sequence[str] = tuple(fixed.PLAUSIBLE),
    above: float = fixed.NULL_SPIKE,
) -> DataFrame:
    """Columns whose NULL rate rose by more than ``above`` over the reference."""
    cols = [c for c in columns if c in current.columns and c in reference.columns]
    ref = null_rates(reference, cols).withColumnRenamed("null_rate", "reference_rate")
    both = null_rates(current, cols).join(ref, "column")
    return both.where(F.col("null_rate") - F.col("reference_rate") > above).select(
        "column", "reference_rate", F.col("null_rate").alias("current_rate")
    )


def batch_findings(
    current: DataFrame,
    reference: DataFrame | None,
    order: str,
    required: Sequence[str] = tuple(fixed.REQUIRED_COLUMNS),
    bounds: Mapping[str, tuple[float, float]] = fixed.PLAUSIBLE,
) -> DataFrame:
    """Contract, range and NULL-spike findings of a batch as one table ``(check, column, issue)``."""
    spark = current.sparkSession
    out = range_findings(current, order, bounds).select("check", "column", "issue")
    contract = schema_contract(current, required)
    if contract:
        out = out.unionByName(spark.createDataFrame(contract, "`check` string, `column` string, issue string"))
    shared = reference is not None and [c for c in bounds if c in current.columns and c in reference.columns]
    if shared:
        pct = [F.format_string("%.1f", F.col(c) * 100.0) for c in ("reference_rate", "current_rate")]
        issue = F.concat(F.lit("NULL share went up: "), pct[0], F.lit("% before, "), pct[1], F.lit("% now"))
        out = out.unionByName(
            null_spikes(current, reference, shared).select(
                F.lit("null_rate_spike").alias("check"), "column", issue.alias("issue"))
        )
    return out


def verdict(findings: DataFrame) -> DataFrame:
    return findings.agg(
        (F.count(F.lit(1)) > 0).alias("anomaly_detected"), F.count(F.lit(1)).alias("issue_count")
    )


def item_errors(
    title: Column, ingredients: Column, calories: Column, cook_time: Column, max_calories: float = 25000.0
) -> Column:
    """Error texts of one raw item: blank title or ingredients, calories not numeric or outside range,
    negative cook time. Inputs may be text or numbers."""
    cal_text = F.trim(calories.cast("string"))
    cal = cal_text.try_cast("double")
    time_text = F.trim(cook_time.cast("string"))
    minutes = F.coalesce(time_text.try_cast("double"), duration_minutes(time_text))
    blank_title = F.coalesce(F.trim(title.cast("string")) == "", F.lit(True))
    blank_items = F.coalesce(F.trim(ingredients.cast("string")) == "", F.lit(True))
    has_cal = F.coalesce(cal_text != "", F.lit(False))
    found = F.array(
        F.when(blank_title, F.lit("no title")),
        F.when(blank_items, F.lit("no ingredients")),
        F.when(has_cal & cal.isNull(),
               F.concat(F.lit("calories are no number: "), cal_text))
        .when(cal < 0, F.lit("calories below zero"))
        .when(cal > F.lit(max_calories),
              F.lit(f"calories above {max_calories:g}")),
        F.when(minutes < 0, F.lit("cook time below zero")),
    )
    return F.filter(found, lambda e: e.isNotNull())


def quarantine(df: DataFrame, errors: Column, name: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their error list."""
    marked = df.withColumn(name, errors)
    return marked.where(F.size(name) == 0).drop(name), marked.where(F.size(name) > 0)


def report_lines(findings: DataFrame, section: str, order: Sequence[str], first: int = 20) -> DataFrame:
    """Report text: per section a heading, the count, and its first findings. One row per line."""
    w = Window.partitionBy(section).orderBy(*order)
    lines = (
        findings.withColumn("no", F.row_number().over(w))
        .where(F.col("no") <= first)
        .select(
            section,
            F.col("no").cast("bigint").alias("line_no"),
            F.concat(F.lit("  - `"), F.to_json(F.struct(*[c for c in findings.columns if c != section])), F.lit("`"))
            .alias("line"),
        )
    )
    heads = findings.groupBy(section).agg(F.count(F.lit(1)).alias("n")).select(
        section,
        F.explode(F.array(
            F.struct(F.lit(-1).cast("bigint").alias("line_no"), F.concat(F.lit("## "), F.col(section)).alias("line")),
            F.struct(F.lit(0).cast("bigint").alias("line_no"),
                     F.concat(F.lit("- Critical failures: "), F.col("n").cast("string")).alias("line")),
        )).alias("h"),
    ).select(section, "h.line_no", "h.line")
    return heads.unionByName(lines)
