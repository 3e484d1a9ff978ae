"""Declared schemas of the files that are read and landed."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


ITEMS = _struct({
    "recipe_name": _S, "prep_time": _S, "cook_time": _S, "total_time": _S, "servings": _L, "yield": _S,
    "ingredients": _S, "directions": _S, "rating": _D, "url": _S, "cuisine_path": _S, "nutrition": _S,
    "timing": _S, "img_src": _S,
})
CANDIDATE_FILE = _struct({
    "Name": _S, "Prep Time": _S, "Cook Time": _S, "Total Time": _S, "Servings": _S, "Ingredients": _S,
    "Directions": _S, "url": _S,
})
PREDICTIONS = _struct({"label": T.IntegerType(), "score": _D, "cuisine_path": _S})
REQUEST_LOG = _struct({
    "method": _S, "path": _S, "status_code": T.IntegerType(), "latency_ms": _D, "timestamp": _D,
})
