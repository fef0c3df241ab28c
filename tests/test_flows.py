"""End-to-end invariants in the spirit of the reference's smoke tests, on
the driver tables (sf0.01)."""

import math

from pyspark.sql import functions as F

from conftest import SF01
from lathe.operators import encode, scale, sets
from lathe.plans import catalog_features as CF, catalog_panel as CP, catalog_regression as CR


def test_regression_clean_and_split_shares(spark):
    s = CR.split_orders(spark, SF01)
    r = s.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"), F.count("*").alias("n")).first()
    assert r.lo >= 15000 and r.hi <= 500000 and r.n > 0
    shares = {x.split: x["count"] / r.n for x in s.groupBy("split").count().collect()}
    assert 0.65 <= shares["train"] <= 0.75 and 0.10 <= shares["val"] <= 0.20 and 0.10 <= shares["test"] <= 0.20
    assert sum(x["count"] for x in s.groupBy("split").count().collect()) == r.n


def test_scaled_train_mean_zero_std_one(spark):
    ls = CF.line_split(spark, SF01)
    tr = ls.where(F.col("split") == "train")
    scaled, fitted = scale.standard_scale(tr, ls, CF.LINE_FEATS)
    chk = scale.scaled_feature_check(scaled.where(F.col("split") == "train"), CF.LINE_FEATS).collect()
    assert all(x.ok for x in chk)
    assert fitted.count() == len(CF.LINE_FEATS)


def test_panel_split_disjoint_and_conserved(spark):
    p = CP.panel_split(spark, SF01)
    assert p.count() == spark.read.parquet(f"{SF01}/events.parquet").count()
    assert all(x.shared_ids == 0 for x in sets.overlap_check(p, "split", "user_id").collect())
    assert p.where(F.col("is_purchase").isNull()).count() == 0


def test_encoded_features_have_no_strings(spark):
    ps = CF.part_split(spark, SF01)
    tr = ps.where(F.col("split") == "train")
    out = encode.frequency_ordinal(tr, ps, ["p_type"])
    out = encode.top_k_one_hot(tr, out, "p_brand", k=10)
    out = encode.frequency_encode(tr, out, "p_name")
    feats = out.drop("p_name", "p_brand", "p_type", "split")
    assert not [f.name for f in feats.schema.fields if f.dataType.simpleString() == "string"]


def test_flow_metrics_are_valid(spark):
    import __spark_entry__ as E
    q = E.queries()
    reg = q["m36_regression_flow_metrics"](spark, SF01).collect()
    assert {x.split for x in reg} == {"train", "val", "test"}
    assert all(math.isfinite(x.rmse_log) and x.rmse_log > 0 for x in reg)
    cls = q["m36_classification_flow"](spark, SF01).collect()
    assert all(0 <= x.accuracy <= 1 and 0 <= x.auc <= 1 for x in cls)
