"""Rows for trees: their partitions follow what the trees keep of them, not the stored bytes."""

from pyspark.sql import functions as F

from ladle.plans import training


def test_rows_for_trees_spread_by_inputs(spark, monkeypatch):
    rows = spark.range(600).select("id", F.format_string("t%d", F.col("id") % 40).alias("title"), (F.col("id") % 3 > 0).cast("int").alias("label"))
    got = []

    class Estimator:
        def fit(self, df):
            got.append(df)
            return training.boosted_trees(maxIter=1)(600, False).fit(df)

    monkeypatch.setattr(training, "BINNED_BYTES", 1 << 13)
    score = training.fit_structured(rows.withColumn("x", F.col("id") * 1.0), ["x"], ["title"], lambda n, weighted: Estimator())
    sizes = [r[0] for r in got[0].groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 600 and max(sizes) * 40 * 4 <= 2 << 13
    assert score(rows.withColumn("x", F.lit(1.0))).count() == 600
    small = rows.coalesce(1)
    monkeypatch.setattr(training, "BINNED_BYTES", 1 << 25)
    assert training.spread_rows(small, 600, 41).rdd.getNumPartitions() == 1
