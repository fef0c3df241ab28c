"""Joins (K01-K03): plain joins that AQE may turn into a broadcast after
measuring the smaller side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_features(base: DataFrame, feats: DataFrame, key, how: str = "inner") -> DataFrame:
    return base.join(feats, key, how)


def semi_join_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def map_encode_join(df: DataFrame, col: str, dictionary: DataFrame, out: str,
                    default=None, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Left lookup of ``col`` in a fitted ``(key, value)`` table; NULL is a
    key like any other, and ``default`` is for keys without a row only."""
    d = dictionary.select(F.col(key_col).alias("_k"), F.col(value_col).alias("_v"), F.lit(True).alias("_met"))
    j = df.join(d, df[col].eqNullSafe(d["_k"]), "left")
    v = F.col("_v") if default is None else F.when(F.col("_met"), F.col("_v")).otherwise(F.lit(default))
    return j.withColumn(out, v).drop("_k", "_v", "_met")
