"""Explanation aggregates.

Per-row tree SHAP is a single-machine library; for linear models exact
attributions are ``w_j·(x_j − mean_j)``, computed here as column arithmetic
into a long ``(row, feature, attr)`` table; every importance, group and
local view is a grouped aggregate over that table.  Permutation importance
replaces input-gradient importance and shuffles a column by a hash-rank
join (distributed, deterministic)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lathe.functions.hashing import keyed_permutation
from lathe.operators.ordering import rank_within
from lathe.operators.windows import top_k_per_group


def coefficient_table(spark, names: list[str], coefs, k: int | None = None) -> DataFrame:
    """``(feature, coefficient, rank_desc, rank_asc)``; top / bottom k when
    ``k`` is given.  The table has one row per feature."""
    df = spark.createDataFrame([(n, float(c)) for n, c in zip(names, coefs)], "feature string, coefficient double")
    w_d = Window.orderBy(F.desc("coefficient"), "feature")  # one row per feature: tiny
    w_a = Window.orderBy(F.asc("coefficient"), "feature")
    out = df.select("*", F.row_number().over(w_d).alias("rank_desc"), F.row_number().over(w_a).alias("rank_asc"))
    if k:
        out = out.where((F.col("rank_desc") <= k) | (F.col("rank_asc") <= k))
    return out


def tree_importance(spark, names: list[str], importances, k: int | None = None) -> DataFrame:
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, importances)], "feature string, importance double")
    out = df.orderBy(F.desc("importance"), "feature")
    return out.limit(k) if k else out


def linear_attribution(df: DataFrame, id_col: str, coefs: dict, means: dict) -> DataFrame:
    """Long table ``(id, feature, attr)`` with ``attr = w_j·(x_j − mean_j)``."""
    feats = list(coefs)
    wide = df.select(id_col, *[(F.lit(float(coefs[c])) * (F.col(c) - F.lit(float(means[c])))).alias(c) for c in feats])
    return wide.unpivot([id_col], feats, "feature", "attr")


def attribution_importance(attr: DataFrame, k: int | None = None, digits: int = 6) -> DataFrame:
    """Mean |attr| per feature and its share of the total, sorted."""
    g = attr.groupBy("feature").agg(F.avg(F.abs("attr")).alias("mean_abs"))
    total = g.agg(F.sum("mean_abs")).first()[0] or 1.0  # one value per feature
    out = g.select("feature", F.round("mean_abs", digits).alias("mean_abs"),
                   F.round(F.col("mean_abs") * 100 / F.lit(total), 4).alias("share_pct")) \
        .orderBy(F.desc("mean_abs"), "feature")
    return out.limit(k) if k else out


def _group_map(spark, groups: dict) -> DataFrame:
    return spark.createDataFrame(list(groups.items()), "feature string, group string")


def group_attribution(attr: DataFrame, id_col: str, groups: dict, signed: bool = False,
                      digits: int = 6) -> DataFrame:
    """Per row, the sum of |attr| (or of signed attr) inside each feature
    group; then per group mean |.|, pop std and sum over rows.  The
    feature -> group map has one row per feature (broadcast)."""
    m = F.broadcast(_group_map(attr.sparkSession, groups))
    j = attr.join(m, "feature")
    val = F.col("attr") if signed else F.abs("attr")
    per_row = j.groupBy(id_col, "group").agg(F.sum(val).alias("_g"))
    return per_row.groupBy("group").agg(F.round(F.avg(F.abs("_g")), digits).alias("mean_abs"),
                                        F.round(F.stddev_pop("_g"), digits).alias("std"),
                                        F.round(F.sum("_g"), digits).alias("total"))


def group_importance_ratio(attr: DataFrame, groups: dict, group: str, digits: int = 6) -> DataFrame:
    """Mean |attr| of one group's features divided by the overall mean."""
    m = F.broadcast(_group_map(attr.sparkSession, groups))
    j = attr.join(m, "feature", "left")
    return j.agg(F.round(F.avg(F.when(F.col("group") == group, F.abs("attr"))) / F.avg(F.abs("attr")), digits)
                 .alias("ratio"))


def local_explanation(attr: DataFrame, id_col: str, ids: DataFrame, k: int = 3, digits: int = 6) -> DataFrame:
    """Top-k features by |attr| for the chosen rows."""
    a = attr.join(ids.select(id_col).distinct(), id_col, "left_semi")
    a = a.withColumn("_abs", F.abs("attr"))
    out = top_k_per_group(a, [id_col], [F.col("_abs").desc(), F.col("feature").asc()], k, salts=1)
    return out.select(id_col, "feature", F.round("attr", digits).alias("attr"), F.col("rank").cast("int"))


def feature_target_corr(df: DataFrame, feature: str, target: str, digits: int = 6) -> DataFrame:
    return df.agg(F.round(F.corr(feature, target), digits).alias("r"))


def permuted_values(df: DataFrame, key: str, cols: list[str], seed=42) -> DataFrame:
    """``df`` with ``_p0``, ``_p1``, ...: each column's values dealt to other rows
    by a keyed permutation of its own.  One range sort numbers the rows by
    ``key`` (unique); the permutations are arithmetic on that number, and the
    values travel in one narrow shuffle."""
    ranked = rank_within(df, [], [F.col(key)], rank_col="_rk", count_col=None)
    n = ranked.count()
    moved = ranked.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), keyed_permutation(F.col("_rk") - 1, n, f"{c}|{seed}").alias("to"),
                 F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])).alias("m"))
    dealt = moved.groupBy((F.col("m.to") + 1).alias("_rk")).agg(
        *[F.max(F.when(F.col("m.i") == i, F.col("m.v"))).alias(f"_p{i}") for i in range(len(cols))])
    return ranked.join(dealt, "_rk").drop("_rk")


def permutation_importance(model, df: DataFrame, key: str, feats: list[str], score, assemble_fn, seed=42) -> DataFrame:
    """Drop of a score (an aggregate expression over the scored rows, higher is
    better) when each feature is permuted.  All variants of a row are scored
    in one pass."""
    dealt = permuted_values(df, key, feats, seed)
    rest = [c for c in df.columns if c not in feats]
    variants = [F.struct(F.lit(k).alias("_variant"), *[(F.col(f"_p{k}") if i == k else F.col(f).cast("double")).alias(f)
                                                      for i, f in enumerate(feats)]) for k in range(-1, len(feats))]
    rows = dealt.select(*rest, F.explode(F.array(*variants)).alias("_v")).select(*rest, "_v.*")
    scored = model.transform(assemble_fn(rows)).groupBy("_variant").agg(score.alias("s"))
    scores = {r["_variant"]: float(r["s"]) for r in scored.collect()}  # a row a feature
    base = scores[-1]
    out = [(f, base, scores[k], base - scores[k]) for k, f in enumerate(feats)]
    return df.sparkSession.createDataFrame(
        out, "feature string, base_score double, permuted_score double, drop double").orderBy(F.desc("drop"), "feature")
