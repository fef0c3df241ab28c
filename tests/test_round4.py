"""Fourth round: how many tasks read the rows of a fit, and which columns it holds."""

from pyspark.ml.linalg import Vectors

from lathe.operators import flows, models


def parts(df):
    return [len(x) for x in df.rdd.glom().collect()]


def test_rows_of_a_large_forest_are_dealt_over_more_tasks_than_cores(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    got = parts(models.spread_rows(spark.range(0, 1_000, numPartitions=1), rows_per_task=500))
    assert len(got) == 10 and sum(got) == 1_000 and max(got) <= 110
    assert len(parts(models.spread_rows(spark.range(0, 90, numPartitions=1), rows_per_task=500))) == 1


def test_a_large_forest_reads_staged_rows(spark, monkeypatch):
    rows = models.assemble(spark.range(0, 300, numPartitions=2).selectExpr("id", "id % 7 as a", "id * 1.0 as y"), ["a"])
    held, _ = models._forest_rows(rows)
    assert held.is_cached
    held.unpersist()
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    held, dealt = models._forest_rows(rows)
    assert not held.is_cached and held.inputFiles() and max(parts(dealt)) <= 110
    model = models.fit_rf_regressor(rows.drop("features"), ["a"], "y", n_trees=3)
    assert model.getNumTrees == 3


def test_rows_of_boosting_are_dealt_evenly_over_the_cores(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    uneven = spark.range(0, 2_000, numPartitions=1).union(spark.range(2_000, 2_010, numPartitions=20))
    got = parts(models.few_tasks(uneven, rows_per_task=20))
    assert len(got) == cores and sum(got) == 2_010 and max(got) - min(got) <= 2 * 21
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    assert len(parts(models.few_tasks(uneven, rows_per_task=20))) == 21
    assert len(parts(models.few_tasks(uneven))) == 1


def test_rows_of_a_flow_are_dealt_in_the_same_way(spark):
    rows = spark.range(0, 500, numPartitions=1).selectExpr("id as y", "array(id) as features")
    got = parts(flows.fit_rows(rows, ["y"], rows_per_task=10))
    assert len(got) == spark.sparkContext.defaultParallelism and sum(got) == 500


def test_a_fit_holds_only_the_columns_it_reads(spark, monkeypatch):
    seen = []
    real = models._persisted
    monkeypatch.setattr(models, "_persisted", lambda df: seen.append(sorted(df.columns)) or real(df))
    rows = spark.range(0, 40).selectExpr("id", "cast(id as string) as name", "cast(id % 5 as double) as a", "id * 2.0 as t", "int(id % 2) as y")
    assert abs(models.fit_ridge(rows, ["a"], "t").predict(Vectors.dense([2.0])) - 39.0) < 5
    models.fit_linear(rows, ["a"], "t")
    models.fit_logistic(rows, ["a"], "y", max_iter=3)
    models.fit_gbt_regressor(rows, ["a"], "t", n_trees=1, depth=1)
    assert seen == [["features", "t"], ["features", "t"], ["features", "weight", "y"], ["features", "t"]]
