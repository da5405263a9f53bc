"""A choice of models is fitted on counted rows."""

from pyspark.sql import functions as F

from rillstone.operators import modelchoice as mc


def test_folds_count_rows_that_are_fitted_once(spark, monkeypatch):
    rows = spark.range(3000).select("id", (F.col("id") % 7).cast("int").alias("a"), (F.col("id") % 7 >= 4).cast("int").alias("y"))
    sizes = []
    plain = mc.ESTIMATORS["decision_tree"]

    def watched(**kw):
        model = plain(**kw)
        fit = model.fit
        model.fit = lambda df: sizes.append((df.count(), df.agg(F.sum("_weight")).first()[0])) or fit(df)
        return model

    monkeypatch.setitem(mc.ESTIMATORS, "decision_tree", watched)
    choice = mc.choose(rows, ["a"], "y", ["id"], [mc.Candidate("decision_tree")])
    assert all(n <= 21 for n, _ in sizes) and sizes[-1][1] == 3000
    assert sum(r["n"] for r in choice.scores.collect()) == 3000
    assert choice.predict(rows).filter("predicted_class = y").count() == 3000
