"""Fuzzy rules (known ratios) and the driver contract."""

from pyspark.sql import functions as F

from lathe.operators import fuzzy


def test_ratio_matches_the_standard_library():
    import difflib
    import random
    rng = random.Random(5)
    assert round(fuzzy.ratio("us", "united states"), 3) == 0.267
    for _ in range(2000):
        a, b = ("".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 14))) for _ in range(2))
        assert fuzzy.ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio()


def test_word_match_semantics(spark):
    rows = [("US",), ("United Kingdom",), (None,), ("",), ("  UNTIED  states ",), ("canada",)]
    df = spark.createDataFrame(rows, "c string")
    got = {r.c: r.is_match for r in fuzzy.fuzzy_word_match(df, "c", "united states", 0.6).collect()}
    assert got == {"US": False, "United Kingdom": True, None: False, "": False, "  UNTIED  states ": True, "canada": False}
    pair = ("united", "states")
    df = spark.createDataFrame([("untied states",), ("united arab emirates",), ("states",)], "c string")
    got = {r.c: r.is_match for r in fuzzy.fuzzy_bigram_match(df, "c", pair).collect()}
    assert got == {"untied states": True, "united arab emirates": False, "states": False}


def test_bound_is_never_below_the_ratio(spark):
    import random
    rng = random.Random(6)
    words = [("".join(rng.choice("unitedsax") for _ in range(rng.randrange(1, 16))),) for _ in range(500)]
    rows = spark.createDataFrame(words, "w string").select("w", fuzzy.ratio_bound(F.col("w"), "united states").alias("b"))
    assert all(r.b >= fuzzy.ratio(r.w, "united states") - 1e-12 for r in rows.collect())


def test_fuzzy_join_back_on_distinct_values(spark):
    df = spark.createDataFrame([("united states",), ("untied states",), (None,), ("canada",)], "c string")
    got = [r.is_match for r in fuzzy.fuzzy_bigram_match(df, "c", ("united", "states")).orderBy(F.col("c").asc_nulls_first()).collect()]
    assert got == [False, False, True, True]


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.columns == ["split", "n", "mean", "median", "std", "skewness", "kurtosis"]
    assert out.count() == 3
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 100


def test_stream_scoring_matches_batch(spark, tmp_path):
    from lathe.operators.scale import apply_scaler, fit_standard_scaler
    from lathe.streaming.scoring import read_stream, score_stream, start_sink
    src = str(tmp_path / "in")
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_totalprice")
    o.write.parquet(src)
    fitted = fit_standard_scaler(o, ["o_totalprice"])
    out = str(tmp_path / "out")
    q = start_sink(score_stream(read_stream(spark, src, o.schema), scaler=fitted), out, trigger_once=True)
    q.awaitTermination(120)
    got = {r.o_orderkey: r.o_totalprice for r in spark.read.parquet(out).collect()}
    exp = {r.o_orderkey: r.o_totalprice for r in apply_scaler(o, fitted).collect()}
    assert got.keys() == exp.keys() and all(abs(got[k] - exp[k]) < 1e-12 for k in exp)
