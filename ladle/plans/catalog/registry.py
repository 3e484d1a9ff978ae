from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = ()):
    """Register a query; ``ctes`` are put in front of its check SQL."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            head = "WITH " + ",\n".join(ctes) + "\n" if ctes else ""
            body = sql.strip()
            if ctes and body.upper().startswith("WITH RECURSIVE "):
                head, body = head.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ",\n", body[15:]
            elif ctes and body.upper().startswith("WITH "):
                head, body = head.rstrip() + ",\n", body[5:]
            ORACLES[name] = head + body
        return fn

    return add


def rounded(df: DataFrame, *cols: str, digits: int = 8) -> DataFrame:
    """Round doubles whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
