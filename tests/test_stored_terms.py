"""Term vectors hold places and weights; the terms themselves stay where they were counted."""

from pyspark.ml import Pipeline

from ladle.operators import estimators


def test_vectors_do_not_carry_terms(spark):
    df = spark.createDataFrame([(1, "red blue blue", "a", 1.0), (2, "blue", "b", 2.0), (3, None, "a", 3.0)], "id long, text string, g string, x double")
    model = estimators.TfidfVectorizer("id", "text", "terms").fit(df)
    out = model.transform(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and not any("term, " in line.split("collect_list", 1)[1].split(")")[0] for line in plan.splitlines() if "collect_list" in line)
    got = {r["id"]: r["terms"].toArray().tolist() for r in out.collect()}
    named = {r["id"]: (r["indices"], r["weights"], r["terms"]) for r in model.fitted.transform(df, "id", "text").collect()}
    assert named[1][2] == ["blue", "red"] and set(named) == {1, 2}
    assert {i: [v[0], v[1]] for i, v in named.items()} == {i: [[j for j, x in enumerate(got[i]) if x], [x for x in got[i] if x]] for i in (1, 2)}
    assert not any(got[3])
    wide = Pipeline(stages=[estimators.TfidfVectorizer("id", "text", "terms"), estimators.StructuredEncoder(["x"], ["g"])]).fit(df).transform(df)
    assert wide.count() == 3
