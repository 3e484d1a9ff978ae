"""The comparison table: every ranker and blend, with metrics over groups."""

import random

from ladle.plans.catalog import QUERIES


def test_all_rankers_and_blends_are_compared(spark, tmp_path, monkeypatch):
    from ladle.plans import training

    monkeypatch.setattr(training, "fit_ranker", lambda *a, fit=training.fit_ranker: fit(*a[:4], 4))  # a few passes tell these words apart
    r = random.Random(3)
    words = ["olive", "basil", "onion"], ["stale", "burnt", "onion"]
    docs = [(i, " ".join(r.choice(words[i % 4 == 0]) for _ in range(8)), "en" if i % 3 else "de", f"src{i % 2}") for i in range(200)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = QUERIES["compare_models"](spark, str(tmp_path)).collect()
    assert {x["model"] for x in got} == {*training.RANKERS, *training.PROBABILITY_BLENDS, *training.RANK_BLENDS}
    assert {x["n_samples"] for x in got} == {29} and {x["num_groups"] for x in got} == {4}
    assert all(x["macro_avg_precision_at_k"] is not None and x["roc_auc"] > 0.8 for x in got)
    assert [x["roc_auc"] for x in got] == sorted((x["roc_auc"] for x in got), reverse=True)


def test_models_are_evaluated_together_as_alone(spark):
    """Ties, null groups, a model of one class and one without rows."""
    from ladle.operators import evaluation
    from ladle.plans import training

    schema = "id long, label int, score double, g string"
    a = spark.createDataFrame([(i, i % 2, [0.5, 0.9, None, 0.1][i % 4], "xy"[i % 2] if i % 5 else None) for i in range(23)], schema)
    preds = {"a": a, "b": a.where("label = 1"), "c": a.where("false")}
    for group in ("g", None):
        alone = {n: evaluation.evaluate(d, group).first().asDict() | {"model": n} for n, d in preds.items()}
        got = training.compare_models(preds, group)
        assert {r["model"]: r.asDict() for r in got.collect()} == alone
        assert got.columns == [*evaluation.evaluate(a, group).columns, "model"]
