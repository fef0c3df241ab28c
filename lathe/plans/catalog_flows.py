"""Both flows from raw tables to three saved models each.

Regression: ``orders`` with customer, nation and line aggregates -> price
range -> log target -> bins -> stratified split -> features -> ridge, boosted
trees, stacking.  Classification: ``events`` as a panel of users -> forward
fill -> split by user, stratified by the last known label -> features -> SMOTE
and undersampling of the train rows -> logistic, forest, boosted trees.

The tables that enter the fits have an oracle, and so have the ridge
pipeline's metrics; fitted trees and logistic models are not SQL-expressible."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lathe.functions.dates import iso_weekday
from lathe.operators import balance, evaluate, flows, split, stages, windows
from lathe.operators.trees import BoostedClassifier, BoostedRegressor
from lathe.plans.catalog_panel import panel_split
from lathe.plans.catalog_regression import _SQL_BASE, PRIORITY_ORDER, split_orders
from lathe.plans.registry import query
from lathe.plans.sql_ridge import predicted, ridge_ctes
from lathe.session import checkpoint_dir, stage_table
from lathe.sources.tables import table

# -- regression --------------------------------------------------------------

_RAW = ["o_orderkey", "split", "y", "o_orderdate", "o_orderpriority", "o_orderstatus", "customer", "c_mktsegment",
        "n_name", "balance", "n_lines", "total_qty", "mean_discount"]
_NUMBERS = ["priority", "month", "day_of_week", "balance", "has_balance", "n_lines", "total_qty", "mean_discount",
            "qty_per_line", "priority_lines"]
_CATEGORIES = ["o_orderstatus", "c_mktsegment", "n_name", "customer"]
_PRIORITY = " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITY_ORDER))


def regression_rows(spark, sf):
    """Cleaned and split orders with what their customer and lines tell; a
    negative balance counts as unknown, an order without lines has none."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("total_qty"),
        F.avg("l_discount").alias("mean_discount"))
    people = table(spark, sf, "customer").join(
        table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left")
    rows = (split_orders(spark, sf)
            .join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .withColumn("customer", F.col("o_custkey").cast("string"))
            .withColumn("balance", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))))
    return stage_table(rows.select(*_RAW), "regression-rows")


def regression_features(rows):
    before = SQLTransformer(statement=f"""
        SELECT *, CASE o_orderpriority {_PRIORITY} ELSE -1 END AS priority, month(o_orderdate) AS month,
               weekday(o_orderdate) + 1 AS day_of_week FROM __THIS__""")
    after = SQLTransformer(statement="""
        SELECT *, total_qty / n_lines AS qty_per_line, priority * n_lines AS priority_lines FROM __THIS__""")
    return flows.fit_features(rows.where(F.col("split") == "train"), [before],
                              ["balance", "n_lines", "total_qty", "mean_discount"], {"balance": "has_balance"},
                              [after], _CATEGORIES, _NUMBERS)


_N_REGRESSION = len(_NUMBERS) + 2 + 11 + 1  # two ordinals, ten nations and the others, the customer's frequency
_REG_X = [f"x{i:02d}" for i in range(_N_REGRESSION)]


def _scaled(name: str, columns: list[str], xs: list[str], keys: str) -> str:
    """CTEs that scale ``columns`` of table ``name`` by the train rows' moments."""
    moments = ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s{i}"
                        for i, c in enumerate(columns))
    return (f"moments AS (SELECT {moments} FROM {name} WHERE split = 'train'),\n"
            f"frame AS (SELECT {keys}, " + ", ".join(f"({c} - m{i}) / s{i} AS {x}" for i, (c, x) in enumerate(zip(columns, xs)))
            + f" FROM {name}, moments)")


def _ordinal_sql(column: str) -> str:
    return (f"{column}_codes AS (SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column} NULLS FIRST) - 1 AS code "
            f"FROM raw WHERE split = 'train' GROUP BY {column})")


_REG_FRAME_SQL = _SQL_BASE.replace("WITH", "WITH RECURSIVE", 1) + f"""
, lines AS (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS total_qty, avg(l_discount) AS mean_discount
            FROM lineitem GROUP BY l_orderkey),
raw AS (SELECT o_orderkey, split, y, o_orderdate, o_orderpriority, o_orderstatus, CAST(o_custkey AS VARCHAR) AS customer,
               c_mktsegment, n_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, n_lines, total_qty, mean_discount
        FROM splitted LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN lines ON o_orderkey = l_orderkey),
med AS (SELECT median(balance) AS m1, median(n_lines) AS m2, median(total_qty) AS m3, median(mean_discount) AS m4
        FROM raw WHERE split = 'train'),
filled AS (SELECT raw.* REPLACE (coalesce(balance, m1) AS balance, coalesce(n_lines, m2) AS n_lines,
             coalesce(total_qty, m3) AS total_qty, coalesce(mean_discount, m4) AS mean_discount),
             CASE WHEN balance IS NULL THEN 0 ELSE 1 END AS has_balance FROM raw, med),
{_ordinal_sql('o_orderstatus')},
{_ordinal_sql('c_mktsegment')},
{_ordinal_sql('n_name')},
freq AS (SELECT customer, count(*) AS f FROM raw WHERE split = 'train' GROUP BY customer),
wide AS (SELECT filled.*, CASE o_orderpriority {_PRIORITY} ELSE -1 END AS priority, month(o_orderdate) AS month,
           isodow(o_orderdate) AS day_of_week, total_qty / n_lines AS qty_per_line,
           CASE o_orderpriority {_PRIORITY} ELSE -1 END * n_lines AS priority_lines,
           coalesce(a.code, -1) AS status_code, coalesce(b.code, -1) AS segment_code, coalesce(c.code, 99) AS nation_code,
           coalesce(f, 0) AS customer_freq
         FROM filled LEFT JOIN o_orderstatus_codes a USING (o_orderstatus) LEFT JOIN c_mktsegment_codes b USING (c_mktsegment)
         LEFT JOIN n_name_codes c USING (n_name) LEFT JOIN freq USING (customer)),
""" + _scaled("wide", [*_NUMBERS, "status_code", "segment_code", *[f"(nation_code = {i})::INT" for i in range(10)],
                       "(nation_code > 9)::INT", "customer_freq"], _REG_X, "o_orderkey, split, y")


@query("m36_regression_frame", _REG_FRAME_SQL + "\nSELECT o_orderkey, split, round(y, 6) AS y, "
       + ", ".join(f"round({x}, 6) AS {x}" for x in _REG_X) + " FROM frame")
def regression_frame(spark, sf):
    """The table that enters the regression fits."""
    rows = regression_rows(spark, sf)
    features, _ = regression_features(rows)
    x = vector_to_array("features")
    return features.transform(rows).select("o_orderkey", "split", F.round("y", 6).alias("y"),
                                           *[F.round(x[i], 6).alias(n) for i, n in enumerate(_REG_X)])


def _model_dir(spark, name):
    return f"{checkpoint_dir(spark)}/lathe-models/{name}-{uuid.uuid4().hex}"


def _regression_metrics(scored, name):
    m = evaluate.regression_metrics(scored.withColumnRenamed("prediction", "yhat"), "y", "yhat", by=["split"])
    return m.select(F.lit(name).alias("model"), *m.columns)


def regression_flow(spark, sf, predictors, folds: bool = False):
    """Fits, saves, reloads and scores; returns the metrics and the models."""
    rows = regression_rows(spark, sf)
    features, _ = regression_features(rows)
    train = features.transform(rows.where(F.col("split") == "train"))
    keep = ["y"]
    if folds:
        train, keep = split.assign_folds(train.select("o_orderkey", "y", "features"), "o_orderkey", k=5), ["y", "fold"]
    path = _model_dir(spark, "regression")
    fitted = flows.fit_and_save(features, flows.fit_rows(train, keep), predictors, path)
    return flows.score_all(fitted, rows, _regression_metrics, path), fitted


def regression_predictors():
    """The three models with the settings of the reference; its stacking
    leaves its boosted trees at their own defaults (rate 0.3, depth 6)."""
    trees = dict(labelCol="y", featuresCol="features", maxIter=100, maxDepth=6, seed=42, maxMemoryInMB=1024)
    return {"ridge": stages.RidgeRegression("y", alpha=1.0), "boosted": BoostedRegressor(stepSize=0.1, **trees),
            "stacking": stages.StackingRegressor([stages.RidgeRegression("y", alpha=1.0), BoostedRegressor(stepSize=0.3, **trees)],
                                                 stages.RidgeRegression("y", alpha=0.1), "fold", labelCol="y", parallelism=6)}


_RIDGE_PIPELINE_SQL = (_REG_FRAME_SQL + ",\ntr AS (SELECT 0 AS g, * FROM frame WHERE split = 'train'),"
                       + ridge_ctes("tr", _REG_X, "y") + f""",
pred AS (SELECT split, y, {predicted(_REG_X)} AS yhat FROM frame, fit)
SELECT 'ridge' AS model, split, count(*) AS n, round(sqrt(avg(power(yhat - y, 2))), 6) AS rmse_log,
       round(avg(abs(yhat - y)), 6) AS mae_log, round(1 - sum(power(yhat - y, 2)) / (count(*) * var_pop(y)), 6) AS r2_log,
       round(sqrt(avg(power((exp(yhat) - 1) - (exp(y) - 1), 2))), 4) AS rmse,
       round(avg(abs((exp(yhat) - 1) - (exp(y) - 1))), 4) AS mae,
       round(1 - sum(power((exp(yhat) - 1) - (exp(y) - 1), 2)) / (count(*) * var_pop(exp(y) - 1)), 6) AS r2
FROM pred GROUP BY split""")


@query("m36_regression_ridge_pipeline", _RIDGE_PIPELINE_SQL)
def regression_ridge(spark, sf):
    """Raw tables -> saved and reloaded ridge pipeline -> metrics of every split."""
    return regression_flow(spark, sf, {"ridge": stages.RidgeRegression("y", alpha=1.0)})[0]


@query("m36_regression_models")
def regression_models(spark, sf):
    """Raw tables -> ridge, boosted trees and stacking, saved and reloaded ->
    metrics of every model and split."""
    return regression_flow(spark, sf, regression_predictors(), folds=True)[0]


# -- classification ----------------------------------------------------------

_PANEL_NUMBERS = ["value", "has_value", "k", "props_chars", "month", "day_of_week", "days_since_first", "value_per_k"]
_PANEL_CATEGORIES = ["weekday_text", "hour_text", "user"]
_N_PANEL = len(_PANEL_NUMBERS) + 1 + 11 + 1
_CLS_X = [f"x{i:02d}" for i in range(_N_PANEL)]


def panel_rows(spark, sf):
    """The panel with values carried forward within a user, split by user."""
    e = panel_split(spark, sf).select("event_id", "ts", "user_id", "value", "props", "is_purchase", "split")
    filled = windows.forward_fill(e, "user_id", "ts", ["value"], tiebreak="event_id")
    first = e.groupBy(F.col("user_id").alias("_user")).agg(F.min("ts").alias("_first"))
    rows = filled.join(first, F.col("user_id") == F.col("_user"), "left")
    return stage_table(rows.select(
        "event_id", "split", F.col("is_purchase").alias("y"), "value", "ts", "props", F.datediff("ts", "_first").alias("days_since_first"),
        F.col("user_id").cast("string").alias("user"), iso_weekday("ts").cast("string").alias("weekday_text"),
        F.hour("ts").cast("string").alias("hour_text")), "panel-rows")


def panel_features(rows):
    before = SQLTransformer(statement=r"""
        SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k, coalesce(length(props), 0) AS props_chars, month(ts) AS month,
               weekday(ts) + 1 AS day_of_week FROM __THIS__""")
    after = SQLTransformer(statement="SELECT *, value / (k + 1) AS value_per_k FROM __THIS__")
    return flows.fit_features(rows.where(F.col("split") == "train"), [before], ["value", "k"], {"value": "has_value"},
                              [after], _PANEL_CATEGORIES, _PANEL_NUMBERS)


_CLS_FRAME_SQL = f"""
WITH g AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase FROM events),
last AS (SELECT user_id, arg_max(is_purchase, struct_pack(t := ts, e := event_id)) AS lbl FROM g GROUP BY user_id),
r AS (SELECT *, row_number() OVER (PARTITION BY lbl ORDER BY md5(concat_ws('|', CAST(user_id AS VARCHAR), '42')), user_id) AS rk,
             count(*) OVER (PARTITION BY lbl) AS n FROM last),
ids AS (SELECT user_id, CASE WHEN rk <= floor((n * 70 + 50) / 100) THEN 'train'
                             WHEN rk <= floor((n * 85 + 50) / 100) THEN 'val' ELSE 'test' END AS split FROM r),
raw AS (SELECT event_id, split, is_purchase AS y, ts, props, CAST(user_id AS VARCHAR) AS user,
          last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value,
          date_diff('day', min(ts) OVER (PARTITION BY user_id), ts) AS days_since_first,
          CAST(isodow(ts) AS VARCHAR) AS weekday_text, CAST(hour(ts) AS VARCHAR) AS hour_text
        FROM g JOIN ids USING (user_id)),
parsed AS (SELECT *, TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM raw),
med AS (SELECT median(value) AS m1, median(k) AS m2 FROM parsed WHERE split = 'train'),
filled AS (SELECT parsed.* REPLACE (coalesce(value, m1) AS value, coalesce(k, m2) AS k),
                  CASE WHEN value IS NULL THEN 0 ELSE 1 END AS has_value FROM parsed, med),
{_ordinal_sql('weekday_text')},
{_ordinal_sql('hour_text')},
freq AS (SELECT "user", count(*) AS f FROM raw WHERE split = 'train' GROUP BY "user"),
wide AS (SELECT filled.*, coalesce(length(props), 0) AS props_chars, month(ts) AS month, isodow(ts) AS day_of_week, value / (k + 1) AS value_per_k,
           coalesce(a.code, -1) AS weekday_code, coalesce(b.code, 99) AS hour_code, coalesce(f, 0) AS user_freq
         FROM filled LEFT JOIN weekday_text_codes a USING (weekday_text) LEFT JOIN hour_text_codes b USING (hour_text)
         LEFT JOIN freq USING ("user")),
""" + _scaled("wide", [*_PANEL_NUMBERS, "weekday_code", *[f"(hour_code = {i})::INT" for i in range(10)],
                       "(hour_code > 9)::INT", "user_freq"], _CLS_X, "event_id, split, y")


@query("m36_classification_frame", _CLS_FRAME_SQL + "\nSELECT event_id, split, y, "
       + ", ".join(f"round({x}, 6) AS {x}" for x in _CLS_X) + " FROM frame")
def classification_frame(spark, sf):
    """The table from which the classification fits draw their balanced rows."""
    rows = panel_rows(spark, sf)
    features, _ = panel_features(rows)
    x = vector_to_array("features")
    return features.transform(rows).select("event_id", "split", "y", *[F.round(x[i], 6).alias(n) for i, n in enumerate(_CLS_X)])


def _classification_metrics(scored, name):
    p = scored.withColumn("p1", vector_to_array("probability")[1]).withColumn("yhat", F.col("prediction").cast("int"))
    m = evaluate.classification_metrics(p.select("split", "y", "yhat", "p1"), "y", "yhat", "p1", by=["split"])
    return m.select(F.lit(name).alias("model"), *m.columns)


def classification_predictors():
    return {"logistic": stages.BalancedLogistic("y"), "forest": stages.BalancedForest("y"),
            "boosted": BoostedClassifier(labelCol="y", featuresCol="features", maxIter=100, maxDepth=6, stepSize=0.1, seed=42,
                                         maxMemoryInMB=1024)}


@query("m36_classification_models")
def classification_models(spark, sf):
    """Raw events -> logistic, forest and boosted trees on balanced rows, saved
    and reloaded -> metrics of every model and split."""
    rows = panel_rows(spark, sf)
    features, _ = panel_features(rows)
    train = features.transform(rows.where(F.col("split") == "train"))
    vectors = stage_table(train.select("event_id", vector_to_array("features").alias("vec"), "y"), "panel-vectors")
    balanced = balance.rebalance(vectors, "event_id", "vec", "y", 1)
    path = _model_dir(spark, "classification")
    fitted = flows.fit_and_save(features, flows.fit_rows(balanced.withColumn("features", array_to_vector("vec")), ["y"]),
                                classification_predictors(), path)
    return flows.score_all(fitted, rows, _classification_metrics, path)
