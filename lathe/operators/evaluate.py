"""Evaluation aggregates (M07, M11, M16-M25, M35).  Every metric is a
single grouped aggregate over a predictions table, so it runs where the
predictions are and is checkable in SQL; AUC and ROC use exact prefix sums
over distinct scores (no one-task window)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lathe.operators.ordering import bucketed_cumsum
from lathe.operators.quantiles import exact_quantiles
from lathe.functions.rules import tier_label
from lathe.session import stage_table


def _r(c, d=6):
    return F.round(c, d)


def regression_metrics(df: DataFrame, y: str, yhat: str, by: list[str] | None = None,
                       log_target: bool = True, digits: int = 6) -> DataFrame:
    """RMSE, MAE, R² (``1 - SSE / (n·var_pop(y))``) on the model scale and,
    for a log1p target, on the original scale."""
    by = list(by or [])
    e = F.col(yhat) - F.col(y)
    aggs = [F.count(F.lit(1)).alias("n"),
            _r(F.sqrt(F.avg(e * e)), digits).alias("rmse_log" if log_target else "rmse"),
            _r(F.avg(F.abs(e)), digits).alias("mae_log" if log_target else "mae"),
            _r(1 - F.sum(e * e) / (F.count(F.lit(1)) * F.var_pop(y)), digits).alias("r2_log" if log_target else "r2")]
    if log_target:
        yo, po = F.expm1(F.col(y)), F.expm1(F.col(yhat))
        eo = po - yo
        aggs += [_r(F.sqrt(F.avg(eo * eo)), 4).alias("rmse"), _r(F.avg(F.abs(eo)), 4).alias("mae"),
                 _r(1 - F.sum(eo * eo) / (F.count(F.lit(1)) * F.var_pop(yo)), digits).alias("r2")]
    return df.groupBy(*by).agg(*aggs)


def confusion_cells(y: str, yhat: str):
    t, p = F.col(y).cast("int"), F.col(yhat).cast("int")
    return {"tp": F.count_if((t == 1) & (p == 1)), "fp": F.count_if((t == 0) & (p == 1)),
            "fn": F.count_if((t == 1) & (p == 0)), "tn": F.count_if((t == 0) & (p == 0))}


def confusion_matrix(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """All four cells, absent ones 0: ``(by..., actual, predicted, count)``."""
    by = list(by or [])
    cells = confusion_cells(y, yhat)
    one = df.groupBy(*by).agg(*[v.alias(k) for k, v in cells.items()])
    return one.selectExpr(*by, "stack(4, 1, 1, tp, 0, 1, fp, 1, 0, fn, 0, 0, tn) as (actual, predicted, count)") \
        .select(*by, F.col("actual").cast("int"), F.col("predicted").cast("int"), F.col("count").cast("long"))


def auc(df: DataFrame, y: str, p: str, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Tie-correct ROC AUC: group rows by score, then
    ``Σ(pos·neg_below + ½·pos·neg) / (P·N)`` with exact prefix sums of the
    negatives in ascending score order."""
    by = list(by or [])
    t = F.col(y).cast("int")
    g = df.groupBy(*by, F.col(p).alias("_s")).agg(F.sum(t).alias("_pos"), F.sum(1 - t).alias("_neg"))
    c = bucketed_cumsum(g, "_s", {"_cneg": "_neg"}, group_cols=by)
    part = (F.col("_pos") * (F.col("_cneg") - F.col("_neg")) + 0.5 * F.col("_pos") * F.col("_neg"))
    agg = c.groupBy(*by).agg(F.sum(part).alias("_a"), F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    return agg.select(*by, _r(F.col("_a") / (F.col("_P") * F.col("_N")), digits).alias("auc"))


def roc_curve(df: DataFrame, y: str, p: str, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, high to low."""
    by = list(by or [])
    t = F.col(y).cast("int")
    g = df.groupBy(*by, F.col(p).alias("threshold")).agg(F.sum(t).alias("_pos"), F.sum(1 - t).alias("_neg"))
    c = bucketed_cumsum(g, "threshold", {"_cp": "_pos", "_cn": "_neg"}, group_cols=by, descending=True)
    tot = c.groupBy(*by).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    if by:
        j = c.join(tot, by)
    else:
        P, N = [tot.first()[k] for k in ("_P", "_N")]
        j = c.withColumn("_P", F.lit(P)).withColumn("_N", F.lit(N))
    return j.select(*by, "threshold", _r(F.col("_cn") / F.col("_N"), digits).alias("fpr"),
                    _r(F.col("_cp") / F.col("_P"), digits).alias("tpr"))


def classification_metrics(df: DataFrame, y: str, yhat: str, p: str | None = None,
                           by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """accuracy, precision, recall, F1 (0 on empty denominators), balanced
    accuracy and, with scores, ROC AUC."""
    by = list(by or [])
    cells = confusion_cells(y, yhat)
    one = df.groupBy(*by).agg(*[v.alias(k) for k, v in cells.items()])
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))
    z = F.lit(0.0)
    prec = F.coalesce(tp / F.nullif(tp + fp, z), z)
    rec = F.coalesce(tp / F.nullif(tp + fn, z), z)
    spec = F.coalesce(tn / F.nullif(tn + fp, z), z)
    f1 = F.coalesce(2 * prec * rec / F.nullif(prec + rec, z), z)
    out = one.select(*by, (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).cast("long").alias("n"),
                     _r((tp + tn) / (tp + tn + fp + fn), digits).alias("accuracy"),
                     _r(prec, digits).alias("precision"), _r(rec, digits).alias("recall"),
                     _r(f1, digits).alias("f1"), _r((rec + spec) / 2, digits).alias("balanced_accuracy"))
    if p:
        a = auc(df, y, p, by, digits)
        out = out.join(a, by) if by else out.withColumn("auc", F.lit(a.first()["auc"]))
    return out


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``n / (classes · n_c)`` per row.  One staged count per class gives all
    three numbers; rows without a label keep a NULL weight and count nowhere."""
    counts = stage_table(df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_class"))
                         .agg(F.count(F.lit(1)).alias("_nc")), "class-counts")
    n, k = counts.agg(F.sum("_nc"), F.count(F.lit(1))).first()
    return (df.join(counts, F.col(label) == F.col("_class"), "left")
            .withColumn(out, F.lit(float(n or 0)) / (F.lit(k) * F.col("_nc"))).drop("_class", "_nc"))


def constant_baseline(df: DataFrame, y: str, majority: int, score: float = 0.5) -> DataFrame:
    return df.withColumn("prediction", F.lit(majority)).withColumn("score", F.lit(score))


def residual_stats(df: DataFrame, y: str, yhat: str, by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """mean, pop std, 1.96·std, min, max of residuals (actual - predicted)
    and MAE as % of the median actual."""
    by = list(by or [])
    res = F.col(y) - F.col(yhat)
    g = df.groupBy(*by).agg(F.avg(res).alias("mean"), F.stddev_pop(res).alias("std"),
                            F.min(res).alias("min"), F.max(res).alias("max"),
                            F.avg(F.abs(res)).alias("_mae"))
    med = exact_quantiles(df, y, [0.5], group_cols=by, names=["_med"])
    j = g.join(med, by) if by else g.withColumn("_med", F.lit(med.first()["_med"]))
    return j.select(*by, _r(F.col("mean"), digits).alias("mean"), _r(F.col("std"), digits).alias("std"),
                    _r(1.96 * F.col("std"), digits).alias("ci95"), _r(F.col("min"), digits).alias("min"),
                    _r(F.col("max"), digits).alias("max"),
                    _r(F.col("_mae") * 100 / F.col("_med"), digits).alias("mae_pct_of_median"))


def error_by_band(df: DataFrame, y: str, yhat: str, bands: list[tuple[str, float, float]],
                  digits: int = 4) -> DataFrame:
    """count, mean / median absolute error and RMSE per ``[lo, hi)`` band of
    the actual value."""
    d = df.select(tier_label(y, bands).alias("band"), (F.col(yhat) - F.col(y)).alias("_e")) \
        .where(F.col("band").isNotNull()).withColumn("_ae", F.abs("_e"))
    g = d.groupBy("band").agg(F.count(F.lit(1)).alias("count"), F.avg("_ae").alias("mean_error"),
                              F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"))
    med = exact_quantiles(d, "_ae", [0.5], group_cols=["band"], names=["median_error"])
    j = g.join(med, "band")
    return j.select("band", F.col("count").cast("long"), _r(F.col("mean_error"), digits).alias("mean_error"),
                    _r(F.col("median_error"), digits).alias("median_error"), _r(F.col("rmse"), digits).alias("rmse"))


def misclassification_report(df: DataFrame, y: str, yhat: str, p: str, digits: int = 6,
                             confident: float = 0.4) -> DataFrame:
    t, h = F.col(y).cast("int"), F.col(yhat).cast("int")
    wrong = t != h
    conf = F.abs(F.col(p) - 0.5)
    return df.agg(F.count_if(~wrong).alias("correct"), F.count_if(wrong).alias("wrong"),
                  F.count_if((h == 1) & (t == 0)).alias("false_positives"),
                  F.count_if((h == 0) & (t == 1)).alias("false_negatives"),
                  _r(F.avg(F.when(~wrong, conf)), digits).alias("mean_conf_correct"),
                  _r(F.avg(F.when(wrong, conf)), digits).alias("mean_conf_wrong"),
                  F.count_if(wrong & (conf > confident)).alias("confident_errors"))


def fairness_by_group(df: DataFrame, g: str, y: str, yhat: str, p: str, digits: int = 6):
    """Per group: predicted rate, actual rate, mean score, n, accuracy, TP,
    FP; plus one row of range / sample std of the rates over groups."""
    t, h = F.col(y).cast("int"), F.col(yhat).cast("int")
    per = df.groupBy(g).agg(_r(F.avg(h), digits).alias("pred_rate"), _r(F.avg(t), digits).alias("actual_rate"),
                            _r(F.avg(p), digits).alias("mean_score"), F.count(F.lit(1)).alias("n"),
                            _r(F.avg((t == h).cast("int")), digits).alias("accuracy"),
                            F.count_if((h == 1) & (t == 1)).alias("tp"), F.count_if((h == 1) & (t == 0)).alias("fp"))
    summary = per.agg(_r(F.max("pred_rate") - F.min("pred_rate"), digits).alias("pred_rate_range"),
                      _r(F.stddev_samp("pred_rate"), digits).alias("pred_rate_std"),
                      _r(F.max("actual_rate") - F.min("actual_rate"), digits).alias("actual_rate_range"),
                      _r(F.stddev_samp("actual_rate"), digits).alias("actual_rate_std"))
    return per, summary


def bias_by_group(df: DataFrame, g: str, y: str, yhat: str, digits: int = 4) -> DataFrame:
    """n, mean actual, mean predicted, MAE and mean signed error
    (predicted - actual) per group."""
    e = F.col(yhat) - F.col(y)
    return df.groupBy(g).agg(F.count(F.lit(1)).alias("n"), _r(F.avg(y), digits).alias("mean_actual"),
                             _r(F.avg(yhat), digits).alias("mean_predicted"), _r(F.avg(F.abs(e)), digits).alias("mae"),
                             _r(F.avg(e), digits).alias("mean_signed_error"))


def improvement_report(metrics: DataFrame, baseline: str, candidate: str, model_col: str = "model",
                       digits: int = 6) -> DataFrame:
    """Absolute and % change of every metric, candidate vs baseline
    (long metric table ``(model, metric, value)`` joined to itself)."""
    b = metrics.where(F.col(model_col) == baseline).select("metric", F.col("value").alias("baseline"))
    c = metrics.where(F.col(model_col) == candidate).select("metric", F.col("value").alias("candidate"))
    j = b.join(c, "metric")
    return j.select("metric", _r(F.col("baseline"), digits).alias("baseline"),
                    _r(F.col("candidate"), digits).alias("candidate"),
                    _r(F.col("candidate") - F.col("baseline"), digits).alias("abs_change"),
                    _r((F.col("candidate") - F.col("baseline")) * 100 / F.nullif(F.col("baseline"), F.lit(0.0)),
                       digits).alias("pct_change"))


def model_comparison(tables: list[DataFrame], sort_by: str, ascending: bool = True) -> DataFrame:
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return u.orderBy(F.col(sort_by).asc() if ascending else F.col(sort_by).desc())


def bias_gap(per_group: DataFrame, g: str, col: str = "mean_signed_error", digits: int = 4) -> DataFrame:
    """Gap between the groups with the largest and smallest mean signed
    error (one aggregate over the per-group table, ties by group name)."""
    return per_group.agg(
        F.max_by(F.col(g), F.struct(F.col(col), F.col(g))).alias("group_high"),
        F.min_by(F.col(g), F.struct(F.col(col), F.col(g))).alias("group_low"),
        F.round(F.max(col) - F.min(col), digits).alias("gap"))
