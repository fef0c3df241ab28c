"""Scalars, encoders and scaler on hand-written edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from lathe.functions import numeric, text
from lathe.operators import encode, scale


def test_parsers(spark):
    df = spark.createDataFrame([("1,250,000", "$1,234.00", "97%"), ("15,000", "bad", "N/A")], "a string, p string, r string")
    got = df.select(text.parse_amount("a").alias("a"), text.parse_price("p").alias("p"),
                    text.parse_percent("r").alias("r")).collect()
    assert got[0].a == 1250000.0 and got[0].p == 1234.0 and got[0].r == 97.0
    assert got[1].p is None and got[1].r is None


def test_range_label_and_flags(spark):
    df = spark.createDataFrame([("5-7 years",), (" 5-7 years",), ("1 year or less",), (None,)], "e string")
    got = [r[0] for r in df.select(text.normalize_range_label("e")).collect()]
    assert got[:3] == ["5 - 7 years", "5 - 7 years", "1 year or less"] and got[3] is None
    f = spark.createDataFrame([("t",), ("f",), (None,)], "x string").select(text.parse_flag("x")).collect()
    assert [r[0] for r in f] == [True, False, None]


def test_row_mean_and_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    r = df.select(numeric.row_mean(["a", "b", "c"]).alias("m"), numeric.safe_ratio("a", F.lit(0)).alias("s")).collect()
    assert r[0].m == 2.0 and r[1].m is None and r[0].s == 1.0


def test_ordinal_encode_unknown_and_strict(spark):
    df = spark.createDataFrame([("18-24",), ("weird",), (None,)], "age string")
    out = encode.ordinal_encode(df, {"age": ["under 18", "18-24", "25-34"]}).collect()
    assert [r.age_ordinal for r in out] == [1, -1, None]
    with pytest.raises(Exception):
        encode.ordinal_encode(df, {"age": ["under 18", "18-24"]}, strict=True).collect()


def test_frequency_encode_unseen_is_zero(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    df = spark.createDataFrame([("a",), ("z",)], "c string")
    out = {r.c: r.c_freq for r in encode.frequency_encode(train, df, "c").collect()}
    assert out == {"a": 2.0, "z": 0.0}


def test_population_scaler_and_constant_column(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "x double, k double")
    scaled, fitted = scale.standard_scale(train, train, ["x", "k"])
    f = {r.feature: (r.mean, r.std) for r in fitted.collect()}
    assert f["k"] == (5.0, 1.0) and math.isclose(f["x"][1], math.sqrt(1.25))
    chk = {r.feature: r.ok for r in scale.scaled_feature_check(scaled, ["x", "k"]).collect()}
    assert chk == {"x": True, "k": True}


def test_median_impute_fits_on_train(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    df = spark.createDataFrame([(None,), (10.0,)], "v double")
    assert [r.v for r in encode.median_impute(train, df, ["v"]).collect()] == [2.0, 10.0]


def test_route_by_cardinality_bands(spark):
    rows = [(f"a{i % 1}", f"b{i % 5}", f"c{i % 20}", f"d{i % 40}") for i in range(200)]
    train = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = {r.column: (r.n_unique, r.route) for r in encode.route_by_cardinality(train, ["a", "b", "c", "d"]).collect()}
    assert got == {"a": (1, "drop"), "b": (5, "frequency_ordinal"), "c": (20, "top_k_one_hot"),
                   "d": (40, "frequency_encode")}


def test_top_k_one_hot_unseen_and_same_columns(spark):
    train = spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "c string")
    val = spark.createDataFrame([("x",), ("new",)], "c string")
    a = encode.top_k_one_hot(train, train, "c", k=2)
    b = encode.top_k_one_hot(train, val, "c", k=2)
    assert a.columns == b.columns == ["c", "c_x", "c_y", "c_other"]
    got = {r.c: (r.c_x, r.c_y, r.c_other) for r in b.collect()}
    assert got == {"x": (1, 0, 0), "new": (0, 0, 1)}


def test_multi_select_flags_and_count(spark):
    train = spark.createDataFrame([("email, phone",), ("phone",)], "v string")
    df = spark.createDataFrame([("email, phone",), ("work_email",), ("",)], "v string")
    out = encode.multi_select_flags(train, df, "v").collect()
    assert [(r.verified_email, r.verified_phone, r.verification_count) for r in out] == \
        [(1, 1, 2), (1, 0, 1), (0, 0, 1)]


def test_frequency_ordinal_most_frequent_is_zero_unseen_minus_one(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), ("c",)], "t string")
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("zz",)], "t string")
    got = {r.t: r.t_ordinal for r in encode.frequency_ordinal(train, df, ["t"]).collect()}
    assert got == {"b": 0, "c": 1, "a": 2, "zz": -1}
