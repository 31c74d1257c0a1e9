"""Changed lines whose other shape is one row, against the grid."""

from pyspark.sql import functions as F

from cairnfield.operators import measures


def test_off_runs_of_few_and_of_many_segments(spark, monkeypatch):
    rows = [(line, i, 10.0 + i * 3e-4, 45.0 + line * 0.01 + (2e-4 if line % 2 and i % 4 > 1 else 0.0)) for line in range(6) for i in range(5 if line < 4 else 80)]
    own = spark.createDataFrame(rows, "line int, seq int, x double, y double")
    # line 3 has no other shape
    other = measures.segments(own.where("line <> 3").withColumn("y", F.lit(45.0) + F.col("line") * 0.01), ["line"]).drop("seq")
    run = lambda: sorted((r["line"], r["run"], r["points"], round(r["metres"], 6)) for r in measures.off_runs(own, other, ["line"], 3.0).collect())
    mixed = run()
    monkeypatch.setattr(measures, "FEW_SIDES", 1000)
    few = run()
    monkeypatch.setattr(measures, "FEW_SIDES", 0)
    assert mixed == few == run() and {r[0] for r in few} == {1, 3, 5}


def test_lines_of_few_segments_need_no_cells(spark):
    own = spark.createDataFrame([(line, i, 10.0 + i * 3e-4, 45.0 + line * 0.01) for line in range(6) for i in range(5)], "line int, seq int, x double, y double")
    other = measures.segments(own.withColumn("y", F.col("y") + 1e-3), ["line"]).drop("seq")
    plan = measures.off_runs(own, other, ["line"], 3.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "cx" not in plan and "level" not in plan
    assert measures.off_runs(own, other, ["line"], 3.0).count() == 6
