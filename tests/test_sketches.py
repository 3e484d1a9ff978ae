"""Drift from stored sketches against the exact distance; several micro-batches, runs of batches, odd columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.operators.drift import ks_drift
from ladle.session import materialize
from ladle.streaming import sketches, windows


def table(spark, n, shift, seed):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(shift, 2, n), 1)
    w = rng.integers(0, 50, n) + 0.0
    rows = [(float(a) if i % 11 else None, float(b) if i % 7 else float("nan"), "x") for i, (a, b) in enumerate(zip(v, w, strict=True))]
    return spark.createDataFrame(rows, "v double, w double, name string")


@pytest.mark.parametrize(("k", "n"), [(2000, 900), (200, 20000)])
def test_bound_holds_the_exact_distance(spark, k, n):
    current, reference = table(spark, n, 0.5, 1), table(spark, 2 * n, 0.0, 2)
    got = {r["column"]: r for r in sketches.sketch_drift(sketches.sketches(current, ["v", "w"], k), sketches.sketches(reference, ["v", "w"], k), k=k).collect()}
    for r in ks_drift(current, reference, ["v", "w"]).collect():
        g = got[r["column"]]
        assert (g["n_current"], g["n_reference"]) == (r["n_current"], r["n_reference"])
        assert abs(g["distance"] - r["statistic"]) <= g["bound"] < 0.1


def test_runs_of_batches(spark, tmp_path):
    """Four micro-batches: each run of two has the distance of its own rows."""
    parts = [table(spark, 500, s, i) for i, s in enumerate((0.0, 0.0, 3.0, 3.0))]
    src = str(tmp_path / "src")
    for i, p in enumerate(parts):
        p.withColumn("i", F.lit(i)).coalesce(1).write.mode("append").parquet(src)
    stream = windows.stream_table(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    out = str(tmp_path / "out")
    sketches.sketch_stream(stream, ["v", "w", "missing"], out, str(tmp_path / "state"), True).awaitTermination()
    batches = materialize(sketches.stored(spark, out), "batches")
    assert batches.count() == 8 and batches.select("batch_id").distinct().count() == 4
    reference = sketches.sketches(parts[0], ["v", "w"])
    got = {(r["batch_id"], r["column"]): r for r in sketches.sketch_drift(sketches.last_batches(batches, 2), reference, ["batch_id"]).collect()}
    assert len(got) == 8 and got[0, "v"]["n_current"] < got[1, "v"]["n_current"]
    assert got[0, "v"]["distance"] == 0 and got[1, "v"]["distance"] < 0.1 < got[2, "v"]["distance"] < got[3, "v"]["distance"]
    for end in range(1, 4):
        exact = ks_drift(parts[end - 1].union(parts[end]), parts[0], ["v"]).first()["statistic"]
        assert abs(got[end, "v"]["distance"] - exact) <= got[end, "v"]["bound"]


def test_without_values(spark):
    none = sketches.sketches(spark.createDataFrame([(None,), (float("nan"),)], "v double"), ["v"])
    some = sketches.sketches(spark.createDataFrame([(1.0,)], "v double"), ["v"])
    assert none.count() == 0
    assert sketches.sketch_drift(some, none).first()["distance"] is None
