"""Sinks: landed tables, split tables, reports, predictions, models and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.scores import format_ranking
from ladle.sources.readers import file_exists, read_csv


def land_dataset(
    spark: SparkSession, src: str, dest: str, expected: Sequence[str], force: bool = False
) -> dict[str, list[str]]:
    """Land expected CSV files as Parquet tables. Nothing happens when all exist already, unless forced.

    Returns the landed, kept and missing names; a missing file is reported, not an error.
    """
    tables = {n: f"{dest}/{n.rsplit('.', 1)[0]}" for n in expected}
    done = [n for n, t in tables.items() if file_exists(spark, f"{t}/_SUCCESS")]
    if len(done) == len(tables) and not force:
        return {"landed": [], "kept": done, "missing": []}
    out: dict[str, list[str]] = {"landed": [], "kept": [], "missing": []}
    for name, target in tables.items():
        if not file_exists(spark, f"{src}/{name}"):
            out["missing"].append(name)
            continue
        df = read_csv(spark, f"{src}/{name}")
        renamed = df.toDF(*[c.strip() or f"_c{i}" for i, c in enumerate(df.columns)])
        renamed.write.mode("overwrite").parquet(target)
        out["landed"].append(name)
    return out


def table_summary(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("name"), "row_count", F.lit(len(df.columns)).alias("column_count"))


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """One table partitioned by split, so reading one split prunes the others."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_csv(df: DataFrame, path: str, lists: Sequence[str] = (), sep: str = "|") -> None:
    """CSV export with list columns joined."""
    out = df.withColumns({c: F.array_join(c, sep) for c in lists}) if lists else df
    (
        out.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def write_report(findings: DataFrame, path: str) -> None:
    """Findings as JSON lines; they stay distributed."""
    findings.write.mode("overwrite").json(path)


def write_markdown(lines: DataFrame, path: str, section: str = "section") -> None:
    """Report lines as text, in section and line order (a bounded report: headings and first findings)."""
    lines.orderBy(section, "line_no").select("line").write.mode("overwrite").text(path)


def write_predictions(df: DataFrame, path: str, label: str = "label", score: str = "score",
                      group: str | None = None) -> None:
    df.select(label, score, *([group] if group else [])).write.mode("overwrite").parquet(path)


def write_ranking(df: DataFrame, path: str) -> None:
    write_csv(format_ranking(df), path)


def save_pipeline(model, path: str) -> None:
    """Persist a fitted Spark ML model."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
