"""Raking: the targets join the cells once, a pass has one join a dimension."""

from pyspark.sql import functions as F

from tessera.llm import mixing


def test_a_pass_has_one_join_a_dimension(spark, monkeypatch):
    cells = spark.createDataFrame([("a", "x", "p", 10), ("a", "y", "q", 20), (None, "x", "q", 30), ("b", "y", "p", 5)],
                                  "source string, lang string, topic string, n long")
    goals = {"source": spark.createDataFrame([("a", 0.5), (None, 0.25), ("b", 0.25)], "value string, share double"),
             "lang": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "value string, share double")}
    joins, write = [], mixing.materialise

    def watched(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, name)
    monkeypatch.setattr(mixing, "materialise", watched)
    got, error = mixing.rake(cells, goals)
    assert error < 1e-8 and len(joins) > 1 and max(joins) <= 3          # the second step holds the plan of the first twice
    total = {r.source: r.f for r in got.groupBy("source").agg(F.sum("fitted").alias("f")).collect()}
    assert abs(total["a"] - 32.5) < 1e-6 and abs(total[None] - 16.25) < 1e-6 and abs(total["b"] - 16.25) < 1e-6
    assert sorted(got.columns) == ["fitted", "lang", "n", "source", "topic"]
