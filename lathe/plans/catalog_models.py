"""Model queries and source/sink round trips.  Linear and ridge fits have an
oracle that solves the normal equations in SQL; fitted trees, networks and
logistic models are not SQL-expressible (rows-only).  Of the round trips,
what is written and read back must equal the SQL result.

Model frame: lineitem ⋈ part, target ``log1p(l_extendedprice)`` for
regression and ``l_linestatus = 'F'`` for classification, split 70/15/15 by
hashed line key.  Fits use the library defaults (the reference's values)."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lathe.operators import evaluate, explain, gram, models, scale, split, tree_explain
from lathe.plans.catalog_features import _LINE_SPLIT_SQL, LINE_FEATS, line_split
from lathe.plans.catalog_regression import _SQL_BASE, split_orders
from lathe.plans.registry import query
from lathe.plans.sql_ridge import predicted, ridge_ctes
from lathe.session import checkpoint_dir, stage_table
from lathe.sources import files
from lathe.sources.tables import table

FEATS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


def model_frame(spark, sf):
    ls = line_split(spark, sf).join(
        table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice",
                                        F.col("p_size").cast("double").alias("p_size")), "l_partkey")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return ls.select("line_key", key.alias("row_key"), "split", *FEATS, F.log1p("l_extendedprice").alias("target"),
                     (F.col("l_linestatus") == "F").cast("int").alias("y"))


_FRAME_SQL = _LINE_SPLIT_SQL.replace("WITH", "WITH RECURSIVE", 1) + """
, mf AS (SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key, split, l_quantity, l_discount, l_tax, p_retailprice, CAST(p_size AS DOUBLE) AS p_size,
                ln(1 + l_extendedprice) AS target FROM ls JOIN part ON l_partkey = p_partkey),
tr AS (SELECT 0 AS g, * FROM mf WHERE split = 'train'),
"""
_METRICS_SQL = """SELECT split, count(*) AS n, round(sqrt(avg(power(yhat - y, 2))), 6) AS rmse_log,
       round(avg(abs(yhat - y)), 6) AS mae_log,
       round(1 - sum(power(yhat - y, 2)) / (count(*) * var_pop(y)), 6) AS r2_log,
       round(sqrt(avg(power((exp(yhat) - 1) - (exp(y) - 1), 2))), 4) AS rmse,
       round(avg(abs((exp(yhat) - 1) - (exp(y) - 1))), 4) AS mae,
       round(1 - sum(power((exp(yhat) - 1) - (exp(y) - 1), 2)) / (count(*) * var_pop(exp(y) - 1)), 6) AS r2
FROM pred GROUP BY split"""
_FOLD_SQL = _FRAME_SQL + """
folded AS (SELECT * EXCLUDE (g), row_number() OVER (ORDER BY md5(concat_ws('|', row_key, '42')), row_key) AS rk,
                  count(*) OVER () AS n FROM tr),
"""


def _linear_sql(alpha: float) -> str:
    return (_FRAME_SQL + ridge_ctes("tr", FEATS, "target", alpha)
            + f", pred AS (SELECT split, target AS y, {predicted(FEATS)} AS yhat FROM mf, fit)\n" + _METRICS_SQL)


def _train(mf):
    return mf.where(F.col("split") == "train")


def _reg_eval(model, mf):
    d = models.assemble(mf, FEATS)
    p = model.transform(d).withColumnRenamed("prediction", "yhat")
    return evaluate.regression_metrics(p, "target", "yhat", by=["split"])


def _cls_eval(model, mf):
    """Metrics by split.  They read the scores three times, so these are staged; a
    small table, often one part of one file, is scored on all cores."""
    d = models.spread_rows(models.assemble(mf, FEATS).select("split", "y", "features"))
    p = stage_table(model.transform(d).select("split", "y", F.col("prediction").cast("int").alias("yhat"),
                                              vector_to_array("probability")[1].alias("p1")), "scored-rows")
    return evaluate.classification_metrics(p, "y", "yhat", "p1", by=["split"])


@query("m01_fit_linear", _linear_sql(0.0))
def m01(spark, sf):
    mf = model_frame(spark, sf)
    return _reg_eval(models.fit_linear(_train(mf), FEATS, "target"), mf)


@query("m02_fit_ridge", _linear_sql(1.0))
def m02(spark, sf):
    mf = model_frame(spark, sf)
    return _reg_eval(models.fit_ridge(_train(mf), FEATS, "target", alpha=1.0), mf)


@query("m03_fit_gbt_regressor")
def m03(spark, sf):
    mf = model_frame(spark, sf)
    m = models.fit_gbt_regressor(_train(mf), FEATS, "target", subsample=0.8, colsample="0.8")
    return _reg_eval(m, mf)


@query("m04_fit_rf_regressor")
def m04(spark, sf):
    mf = model_frame(spark, sf)
    return _reg_eval(models.fit_rf_regressor(_train(mf), FEATS, "target"), mf)


@query("m05_fit_stacking")
def m05(spark, sf):
    mf = model_frame(spark, sf)
    tr = split.assign_folds(_train(mf), "row_key", k=5)
    st = models.fit_stacking(tr, FEATS, "target", "fold", k=5, passthrough=True, base_factories={
        "ridge": lambda d, f, y: models.fit_ridge(d, f, y, 1.0),
        "gbt": lambda d, f, y: models.fit_gbt_regressor(d, f, y)})
    p = st.transform(mf).withColumnRenamed("prediction", "yhat")
    return evaluate.regression_metrics(p, "target", "yhat", by=["split"])


@query("m06_fit_logistic")
def m06(spark, sf):
    mf = model_frame(spark, sf)
    return _cls_eval(models.fit_logistic(_train(mf), FEATS, "y"), mf)


@query("m06_logistic_optimality", "SELECT unnest(['intercept', " + ", ".join(f"'{f}'" for f in FEATS)
       + "]) AS term, true AS gradient_is_zero")
def m06o(spark, sf):
    """The fitted weights are a minimum of the balanced, penalised log-loss: its
    gradient over the train rows is 0 in every direction."""
    tr = _train(model_frame(spark, sf))
    g = models.logistic_gradient(models.fit_logistic(tr, FEATS, "y"), tr, FEATS, "y")
    return g.select("term", (F.abs("gradient") <= 1e-3 * F.col("scale")).alias("gradient_is_zero"))


@query("m08_fit_rf_classifier")
def m08(spark, sf):
    mf = model_frame(spark, sf)
    return _cls_eval(models.fit_rf_classifier(_train(mf), FEATS, "y"), mf)


@query("m09_fit_gbt_classifier")
def m09(spark, sf):
    mf = model_frame(spark, sf)
    return _cls_eval(models.fit_gbt_classifier(_train(mf), FEATS, "y"), mf)


@query("m10_fit_mlp_classifier")
def m10(spark, sf):
    mf = model_frame(spark, sf)
    tr = _train(mf)
    scaled, fitted = scale.standard_scale(tr, tr, FEATS)
    m = models.fit_mlp_classifier(scaled, FEATS, "y", hidden=(127, 64, 32))
    return _cls_eval(m, scale.apply_scaler(mf, fitted))


@query("m12_cross_validate", _FOLD_SQL + """
fr AS (SELECT *, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM folded),
fo AS (SELECT DISTINCT fold AS g FROM fr),
sets AS (SELECT fo.g, fr.* FROM fr JOIN fo ON fr.fold <> fo.g),""" + ridge_ctes("sets", FEATS, "target") + """,
pr AS (SELECT fit.g, CASE WHEN fold = fit.g THEN 'validation' ELSE 'train' END AS part, target AS y, """
       + predicted(FEATS) + """ AS yhat FROM fr, fit),
sc AS (SELECT g, part, sqrt(avg(power(yhat - y, 2))) AS rmse, avg(abs(yhat - y)) AS mae,
              1 - sum(power(yhat - y, 2)) / (count(*) * var_pop(y)) AS r2 FROM pr GROUP BY g, part),
long AS (SELECT g, part, unnest(['rmse', 'mae', 'r2']) AS metric, unnest([rmse, mae, r2]) AS value FROM sc)
SELECT part, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min,
       round(max(value), 6) AS max FROM long GROUP BY part, metric""")
def m12(spark, sf):
    tr = stage_table(split.assign_folds(_train(model_frame(spark, sf)), "row_key", k=5), "fold-rows")
    return models.summarize_folds(gram.cross_validate_ridge(tr, FEATS, "target", "fold"))


#: the reference's search space in Spark's names
GBT_SPACE = {"maxIter": [100, 200, 300, 500], "maxDepth": [3, 4, 5, 6, 7, 8], "stepSize": [0.01, 0.05, 0.1, 0.15],
             "subsamplingRate": [0.6, 0.7, 0.8, 0.9], "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9"],
             "minInfoGain": [0.0, 0.1, 0.2, 0.3], "minInstancesPerNode": [1, 2, 3, 5]}


def _gbt_search(spark, sf):
    """30 draws over 5 folds: (estimator, rows, table, best)."""
    from pyspark.ml.regression import GBTRegressor
    tr = split.assign_folds(_train(model_frame(spark, sf)), "row_key", k=5)
    tr = stage_table(models.assemble(tr, FEATS).select("features", "target", "fold"), "search-rows")
    est = GBTRegressor(featuresCol="features", labelCol="target", seed=42)
    return est, tr, *models.tune_boosted(est, models.draw_param_maps(est, GBT_SPACE, 30), tr, "fold")


@query("m13_random_search")
def m13(spark, sf):
    return _gbt_search(spark, sf)[2]


@query("m14_refine_grid")
def m14(spark, sf):
    """The grid around m13's best draw."""
    est, tr, _, best = _gbt_search(spark, sf)
    grid = models.refine_grid(est, best, {"maxIter": [-50, 0, 50], "maxDepth": [-1, 0, 1]},
                              valid=lambda n, v: v > 0, factors={"stepSize": [0.8, 1.0, 1.2]})
    return models.tune_boosted(est, grid, tr, "fold")[0]


_SIZES = [0.25 + 0.75 * i / 7 for i in range(8)]


@query("m15_learning_curve", _FOLD_SQL + """
fr AS (SELECT *, CAST((rk - 1) % 5 AS INTEGER) AS fold, CAST(CASE """ + " ".join(
    f"WHEN rk <= floor(n * {f!r} + 0.5) THEN {i}" for i, f in enumerate(_SIZES)) + """ END AS INTEGER) AS size_index FROM folded),
sets AS (SELECT s.size * 10 + f.fold AS g, fr.* FROM fr JOIN (SELECT DISTINCT size_index AS size FROM fr) s ON fr.size_index <= s.size
         JOIN (SELECT DISTINCT fold FROM fr) f ON fr.fold <> f.fold),""" + ridge_ctes("sets", FEATS, "target") + """,
tp AS (SELECT sets.g, 'train' AS part, target AS y, """ + predicted(FEATS) + """ AS yhat FROM sets JOIN fit USING (g)),
vp AS (SELECT fit.g, 'validation' AS part, target AS y, """ + predicted(FEATS) + """ AS yhat FROM fr JOIN fit ON fit.g % 10 = fr.fold),
sc AS (SELECT g, part, 1 - sum(power(yhat - y, 2)) / (count(*) * var_pop(y)) AS r2
       FROM (SELECT * FROM tp UNION ALL SELECT * FROM vp) GROUP BY g, part)
SELECT CAST(g // 10 AS INTEGER) AS size_index, part, round(avg(r2), 6) AS mean, round(stddev_pop(r2), 6) AS std
FROM sc GROUP BY g // 10, part""")
def m15(spark, sf):
    tr = split.assign_folds(_train(model_frame(spark, sf)), "row_key", k=5)
    tr = stage_table(split.learning_sizes(tr, "row_key", n_sizes=8, lo=0.25, hi=1.0), "curve-rows")
    return gram.learning_curve_ridge(tr, FEATS, "target", "size_index", "fold")


@query("m26_coefficient_table", _FRAME_SQL + ridge_ctes("tr", FEATS, "target") + f"""
, long AS (SELECT unnest({FEATS!r}) AS feature, unnest(w) AS coefficient FROM fit),
rk AS (SELECT *, CAST(row_number() OVER (ORDER BY coefficient DESC, feature) AS INTEGER) AS rank_desc,
              CAST(row_number() OVER (ORDER BY coefficient, feature) AS INTEGER) AS rank_asc FROM long)
SELECT feature, round(coefficient, 8) AS coefficient, rank_desc, rank_asc FROM rk WHERE rank_desc <= 2 OR rank_asc <= 2""")
def m26(spark, sf):
    m = models.fit_ridge(_train(model_frame(spark, sf)), FEATS, "target")
    return explain.coefficient_table(spark, FEATS, m.coefficients.toArray(), k=2) \
        .withColumn("coefficient", F.round("coefficient", 8))


@query("m27_tree_importance")
def m27(spark, sf):
    m = models.fit_rf_regressor(_train(model_frame(spark, sf)), FEATS, "target")
    return explain.tree_importance(spark, FEATS, m.featureImportances.toArray(), k=3)


def _feature_of(row: str) -> str:
    return "CASE f " + " ".join(f"WHEN '{f}' THEN {row}.{f}" for f in FEATS) + " END"


_PERMUTED_SQL = _FRAME_SQL + ridge_ctes("tr", FEATS, "target") + f""",
te AS (SELECT *, row_number() OVER (ORDER BY row_key) - 1 AS rk FROM mf WHERE split = 'test'),
dims AS (SELECT n, a, (n + a - 1) // a AS b FROM (
  SELECT n, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS a FROM (SELECT count(*) AS n FROM te))),
names AS (SELECT i, f, w FROM (SELECT unnest(range(1, {len(FEATS) + 1})) AS i, unnest({FEATS!r}) AS f, unnest(w) AS w FROM fit)),
walk(f, rk, x, t) AS (
  SELECT f, rk, rk, 0 FROM te, names UNION ALL
  SELECT f, rk, y.l * b + y.r, t + 1 FROM (
    SELECT f, rk, t, b, list_reduce([1, 2, 3, 4], lambda s, i: CASE WHEN i % 2 = 1
      THEN {{'l': (s.l + CAST('0x' || substr(md5(f || '|42|' || i || '|' || s.r), 1, 8) AS BIGINT)) % a, 'r': s.r}}
      ELSE {{'l': s.l, 'r': (s.r + CAST('0x' || substr(md5(f || '|42|' || i || '|' || s.l), 1, 8) AS BIGINT)) % b}} END,
      {{'l': x // b, 'r': x % b}}) AS y FROM walk, dims WHERE t = 0 OR x >= n)),
dealt AS (SELECT walk.f, x AS rk, {_feature_of("te")} AS v FROM walk JOIN te USING (rk), dims WHERE t > 0 AND x < n),
own AS (SELECT te.*, {predicted(FEATS)} AS yhat FROM te, fit),
base AS (SELECT 1 - sum(power(yhat - target, 2)) / (count(*) * var_pop(target)) AS r2 FROM own),
moved AS (SELECT f, target, yhat + w * (v - ({_feature_of("own")})) AS yhat FROM own JOIN dealt USING (rk) JOIN names USING (f)),
sc AS (SELECT f, 1 - sum(power(yhat - target, 2)) / (count(*) * var_pop(target)) AS s FROM moved GROUP BY f)
SELECT f AS feature, round(r2, 8) AS base_score, round(s, 8) AS permuted_score, round(r2 - s, 8) AS drop FROM sc, base"""


@query("m28_permutation_importance", _PERMUTED_SQL)
def m28(spark, sf):
    mf = model_frame(spark, sf)
    m = models.fit_ridge(_train(mf), FEATS, "target")
    test = mf.where(F.col("split") == "test")
    return explain.permutation_importance(
        m, test, "row_key", FEATS,
        score=1 - F.sum((F.col("prediction") - F.col("target")) ** 2) / (F.count(F.lit(1)) * F.var_pop("target")),
        assemble_fn=lambda d: models.assemble(d, FEATS)) \
        .select("feature", *[F.round(c, 8).alias(c) for c in ("base_score", "permuted_score", "drop")])


@query("m30_tree_attribution_importance")
def m30t(spark, sf):
    """Shapley values of the boosted trees on the test rows: mean |attribution|
    per feature and its share."""
    mf = model_frame(spark, sf)
    m = models.fit_gbt_regressor(_train(mf), FEATS, "target", subsample=0.8, colsample="0.8")
    test = models.spread_rows(stage_table(mf.where(F.col("split") == "test").select("line_key", *FEATS), "explained-rows"))
    attr = tree_explain.tree_attribution(test, "line_key", FEATS, tree_explain.leaf_table(m))
    return explain.attribution_importance(attr)


@query("m36_classification_flow")
def m36c(spark, sf):
    """Classification end to end on embeddings: split -> population scaling
    fitted on train -> SMOTE + undersampling on train -> balanced logistic
    -> metrics per split."""
    from lathe.operators import balance
    e = table(spark, sf, "embeddings").select("vec_id", "embedding",
                                              (F.col("label") == 0).cast("int").alias("y"))
    e = split.stratified_split(e, "vec_id", "y")
    dims = [f"x{i}" for i in range(64)]
    flat = e.select("vec_id", "split", "y", "embedding", *[F.col("embedding")[i].cast("double").alias(d)
                                                           for i, d in enumerate(dims)])
    tr = flat.where(F.col("split") == "train")
    scaled, fitted = scale.standard_scale(tr, flat, dims)
    scaled = scaled.withColumn("vec", F.array(*dims))
    tr_s = scaled.where(F.col("split") == "train")
    bal = balance.rebalance(tr_s.select("vec_id", "vec", "y"), "vec_id", "vec", "y", 1)
    bal = bal.select("y", *[F.col("vec")[i].alias(d) for i, d in enumerate(dims)])
    m = models.fit_logistic(bal, dims, "y")
    p = m.transform(models.assemble(scaled, dims))
    p = p.withColumn("p1", vector_to_array(F.col("probability"))[1])
    return evaluate.classification_metrics(p.withColumn("yhat", F.col("prediction").cast("int")),
                                           "y", "yhat", "p1", by=["split"])


def _io_dir(spark, name):
    return f"{checkpoint_dir(spark)}/lathe-io/{name}-{uuid.uuid4().hex}"


@query("i01_i05_csv_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def i01(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = _io_dir(spark, "csv")
    files.write_csv_table(o, path)
    return files.read_csv_table(spark, path, o.schema)


@query("i01_i05_csv_text_roundtrip", """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN '  ' || text || chr(9) WHEN 2 THEN 'say "hi", \\ ' || text
  WHEN 3 THEN '' ELSE NULL END AS text FROM documents""")
def i01t(spark, sf):
    d = table(spark, sf, "documents")
    kind = F.col("doc_id") % 5
    t = (F.when(kind == 0, F.col("text")).when(kind == 1, F.concat(F.lit("  "), "text", F.lit("\t")))
         .when(kind == 2, F.concat(F.lit('say "hi", \\ '), "text")).when(kind == 3, F.lit("")))
    path = _io_dir(spark, "csv-text")
    files.write_csv_table(d.select("doc_id", t.alias("text")), path)
    return files.read_csv_table(spark, path, "doc_id long, text string")


@query("i03_i04_parquet_roundtrip", _SQL_BASE + """
SELECT split, count(*) AS rows FROM splitted GROUP BY split""")
def i03(spark, sf):
    path = _io_dir(spark, "split")
    files.write_parquet_table(split_orders(spark, sf).select("o_orderkey", "y", "split"), path, partition_by=["split"])
    back = files.read_parquet_table(spark, path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query("i06_write_metrics", """
WITH b AS (SELECT ln(1 + o_totalprice) AS y, o_orderstatus FROM orders WHERE o_totalprice BETWEEN 15000 AND 500000)
SELECT o_orderstatus, count(*) AS n, round(avg(y), 6) AS mean_y FROM b GROUP BY o_orderstatus""")
def i06(spark, sf):
    o = split_orders(spark, sf)
    m = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("mean_y"))
    path = _io_dir(spark, "metrics")
    files.write_metrics(m, path)
    return spark.read.schema(m.schema).json(path)


@query("i07_save_load_fitted", """
WITH b AS (SELECT *, l_orderkey * 100 + l_linenumber AS line_key FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(line_key AS VARCHAR), '42')), line_key) AS rk,
                count(*) OVER () AS n FROM b),
tr AS (SELECT * FROM r WHERE rk <= floor((n * 70 + 50) / 100))
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 'scaler' AS kind, 'mean' AS key, round(avg({c}), 6) AS value FROM tr UNION ALL "
    f"SELECT '{c}', 'scaler', 'std', round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END, 6) FROM tr"
    for c in LINE_FEATS) + ")")
def i07(spark, sf):
    ls = line_split(spark, sf)
    fitted = scale.fit_standard_scaler(ls.where(F.col("split") == "train"), LINE_FEATS)
    long = fitted.select("feature", F.lit("scaler").alias("kind"), F.lit("mean").alias("key"),
                         F.round("mean", 6).alias("value")).unionByName(
        fitted.select("feature", F.lit("scaler").alias("kind"), F.lit("std").alias("key"),
                      F.round("std", 6).alias("value")))
    path = _io_dir(spark, "fitted")
    files.save_fitted(long, path)
    return files.load_fitted(spark, path)


@query("m36_regression_flow_metrics")
def m36r(spark, sf):
    """Regression track end to end as one Spark program: clean (range) ->
    log1p target -> 20-edge bins -> exact stratified split -> ordinal,
    one-hot and date features -> population scaler fitted on train ->
    ridge on train -> RMSE / MAE / R² on log and price scale per split."""
    from lathe.functions import dates, rules
    from lathe.operators import encode
    from lathe.plans.catalog_regression import PRIORITY_ORDER
    s = split_orders(spark, sf)
    f = encode.ordinal_encode(s, {"o_orderpriority": PRIORITY_ORDER})
    f = f.select("o_orderkey", "split", "y", "o_orderpriority_ordinal",
                 *rules.one_hot_fixed("o_orderstatus", ["F", "O", "P"], "status"),
                 *dates.timestamp_parts("o_orderdate"))
    feats = ["o_orderpriority_ordinal", "status_f", "status_o", "status_p", "month", "day_of_week", "hour"]
    f = f.select("o_orderkey", "split", "y", *[F.col(c).cast("double").alias(c) for c in feats])
    tr = f.where(F.col("split") == "train")
    scaled, _ = scale.standard_scale(tr, f, feats)
    m = models.fit_ridge(scaled.where(F.col("split") == "train"), feats, "y", alpha=1.0)
    p = m.transform(models.assemble(scaled, feats)).withColumnRenamed("prediction", "yhat")
    return evaluate.regression_metrics(p, "y", "yhat", by=["split"])
