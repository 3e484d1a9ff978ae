"""JSON maps turned into numeric columns, and energy estimated from macro grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions import fixed

_MAP = "map<string,string>"
# A table may have this many columns made of keys; the long form has no such limit.
MAX_COLUMNS = 1000


#: Quoted texts, words, and what is between them.
_PIECES = r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|\w+|[^\w'"]+|['"])"""
_LITERALS = {"None": "null", "True": "true", "False": "false"}


def literal_as_json(c: Column) -> Column:
    """A Python literal as JSON: its three words outside quotes, and texts in double quotes. What is quoted stays as it is."""

    def piece(x: Column) -> Column:
        inner = F.replace(F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit("\\'"), F.lit("'")), F.lit('"'), F.lit('\\"'))
        out = F.when(x.startswith("'") & (F.length(x) > 1), F.concat(F.lit('"'), inner, F.lit('"')))
        for word, json_word in _LITERALS.items():
            out = out.when(x == word, json_word)
        return out.otherwise(x)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECES), 1), piece), "")


def parse_map(c: Column) -> Column:
    """JSON object, or a Python dict literal, as a string map; anything else is an empty map."""
    empty = F.create_map().cast(_MAP)
    return F.coalesce(F.from_json(c, _MAP), F.from_json(literal_as_json(c), _MAP), empty)


def coerce_number(c: Column) -> Column:
    """Number in a text cell: plain numbers as they are, else the digits, dots and minus signs left over."""
    plain = F.when(c.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"), c.try_cast("double"))
    truth = F.when(c == "true", F.lit(1.0)).when(c == "false", F.lit(0.0))
    rest = F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")
    return F.coalesce(plain, truth, rest)


def map_rows(df: DataFrame, key: str, col: str) -> DataFrame:
    """(key, name, value): one row per entry of a JSON text column. Any number of names; nothing visits the driver."""
    entries = df.select(key, F.explode(parse_map(F.col(col))).alias("name", "text"))
    return entries.select(key, "name", coerce_number(F.col("text")).alias("value"))


def map_keys(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct keys of a map column, for the wide form; more than MAX_COLUMNS are refused."""
    found = df.select(F.explode(F.map_keys(col)).alias("k")).distinct().limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} keys: use map_rows")
    return sorted(r.k for r in found)


def map_to_columns(
    df: DataFrame, col: str, keys: Sequence[str] | None = None, prefix: str = "nutrition_"
) -> DataFrame:
    """One numeric column per key of a JSON text column. Fit ``keys`` on train and pass them for the rest."""
    if col not in df.columns:
        return df
    parsed = df.withColumn("__map", parse_map(F.col(col)))
    keys = map_keys(parsed, "__map") if keys is None else list(keys)
    cols = {
        prefix + k.strip().lower().replace(" ", "_"): coerce_number(F.try_element_at("__map", F.lit(k)))
        for k in keys
    }
    return parsed.withColumns(cols).drop("__map") if cols else parsed.drop("__map")


def macro_calories(c: Column) -> Column:
    """Energy from ``Total Fat 5g ...``: absent macros count 0, a total of 0 or blank text is NULL."""
    total = F.lit(0.0)
    for name, label in fixed.MACRO_LABELS.items():
        grams = F.regexp_extract(c, label + r" (\d+(?:\.\d+)?)g", 1).try_cast("double")
        total = total + F.coalesce(grams, F.lit(0.0)) * F.lit(fixed.MACRO_KCAL[name])
    return F.when(total > 0, F.round(total, 1))
