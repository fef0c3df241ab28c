"""Sources and sinks: CSV with quoted multi-line fields and an explicit
schema, snapshot union with widening, fitted-state round trip."""

from pyspark.sql import functions as F

from lathe.sources import files


def test_csv_multiline_quotes_explicit_schema(spark, tmp_path):
    p = tmp_path / "survey.csv"
    p.write_text('id,job,salary\n1,"Senior ""Lead""\nManager","1,250,000"\n2,Analyst,"60,000"\n')
    df = files.read_csv_table(spark, str(p), "id int, job string, salary string")
    rows = sorted(df.collect(), key=lambda r: r.id)
    assert len(rows) == 2
    assert rows[0].job == 'Senior "Lead"\nManager' and rows[0].salary == "1,250,000"


def test_snapshots_union_widens_and_tags(spark, tmp_path):
    a = spark.createDataFrame([(1, 2)], "id int, x int")
    b = spark.createDataFrame([(2, 2.5, "only_here")], "id long, x double, extra string")
    pa, pb = str(tmp_path / "a"), str(tmp_path / "b")
    a.write.parquet(pa)
    b.write.parquet(pb)
    u = files.read_snapshots(spark, [pa, pb], drop=["extra"])
    assert dict((f.name, f.dataType.simpleString()) for f in u.schema.fields) == \
        {"id": "bigint", "x": "double", "snapshot": "int"}
    assert sorted((r.id, r.x, r.snapshot) for r in u.collect()) == [(1, 2.0, 1), (2, 2.5, 2)]


def test_fitted_table_round_trip(spark, tmp_path):
    t = files.fitted_table(spark, [("x", "scaler", "mean", 1.5), ("x", "scaler", "std", 2.0)])
    files.save_fitted(t, str(tmp_path / "fit"))
    back = files.load_fitted(spark, str(tmp_path / "fit"))
    assert sorted(back.select("key", "value").collect()) == sorted(t.select("key", "value").collect())
    m = spark.createDataFrame([("a", 1.0)], "k string, v double")
    files.write_metrics(m, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).where(F.col("k") == "a").count() == 1
