"""NULL as a category, colliding and many names, CSV round trip, empty lists."""

from pyspark.sql import functions as F


def test_null_is_a_category(spark):
    from lathe.operators.encode import frequency_encode, frequency_ordinal, route_by_cardinality
    df = spark.createDataFrame([(None,), (None,), (None,), ("a",), ("a",), ("b",)], "c string")
    new = spark.createDataFrame([(None,), ("a",), ("z",)], "c string")
    got = {r.c: r.c_freq for r in frequency_encode(df, new, "c").collect()}
    assert got == {None: 3.0, "a": 2.0, "z": 0.0}
    codes = {r.c: r.c_ordinal for r in frequency_ordinal(df, new, ["c"]).collect()}
    assert codes == {None: 0, "a": 1, "z": -1}
    assert route_by_cardinality(df, ["c"]).first()["n_unique"] == 3


def test_null_id_is_filled(spark):
    from lathe.operators.windows import forward_fill
    rows = [(i, t, "x" if t == 0 else None) for i in (None, 1) for t in range(40)]
    out = forward_fill(spark.createDataFrame(rows, "id int, t int, v string"), "id", "t", ["v"], partitions=8)
    assert out.where("v is null").count() == 0


def test_colliding_and_many_tokens(spark):
    from lathe.operators.encode import multi_select_flags, one_hot_all, top_k_one_hot
    df = spark.createDataFrame([("a-b",), ("a_b",), ("a-b,a_b",)], "c string")
    out = multi_select_flags(df, df, "c")
    flags = {r.c: (r.verified_a_b, r.verified_a_b_2) for r in out.collect()}
    assert flags == {"a-b": (1, 0), "a_b": (0, 1), "a-b,a_b": (1, 1)}
    assert len(set(one_hot_all(df, df, "c").columns)) == 4
    long = spark.createDataFrame([("x" * 60 + s,) for s in "pqr"], "c string")
    assert len(set(top_k_one_hot(long, long, "c", 3).columns)) == 5
    many = spark.range(20_000).select(F.concat(F.lit("t"), "id").alias("c"))
    from lathe.operators.encode import fit_vocabulary
    assert len(fit_vocabulary(many, "c")) == 20_000


def test_csv_keeps_texts(spark, tmp_path):
    from lathe.sources.files import read_csv_table, write_csv_table
    rows = [(1, 'say "hi", ok'), (2, ""), (3, None), (4, "  padded\t"), (5, "two\nlines, \\ \"\""), (6, '"'), (7, "\\N x")]
    df = spark.createDataFrame(rows, "id int, t string")
    write_csv_table(df, str(tmp_path / "c"))
    back = read_csv_table(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_empty_list_matches_nothing(spark):
    from lathe.operators.filters import contains_any
    assert spark.createDataFrame([("a",)], "c string").where(contains_any("c", [])).count() == 0


def test_splits_without_limit(spark):
    from lathe.operators.sets import overlap_check
    from lathe.operators.split import stratified_split
    df = spark.range(400).select((F.col("id") % 150).alias("u"), (F.col("id") % 120).alias("s"))
    got = overlap_check(df, "s", "u")
    assert got.count() == 120 * 119 // 2 and got.agg(F.sum("shared_ids")).first()[0] > 0
    out = stratified_split(spark.range(3000).withColumn("g", F.lit(1)), "id", "g", fractions=(0.333, 0.333, 0.334))
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 999, "val": 999, "test": 1002}


def test_stage_tables_are_deleted(spark):
    from lathe.session import clear_stages, stage_table
    kept = stage_table(spark.range(5), "gone")
    assert kept.count() == 5
    clear_stages(spark)
    assert not __import__("os").path.exists(kept.inputFiles()[0].removeprefix("file://"))
