"""Regression track on ``orders`` (price plays the salary, status the
currency, priority the ordered label): clean -> log target -> bins ->
stratified split -> per-split statistics, plus the numeric filters,
quantiles, tiers, histograms and ordinal codes of that track."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions import dates, numeric, rules
from lathe.operators import encode, filters, profile, split
from lathe.operators.quantiles import exact_quantiles
from lathe.plans.registry import query
from lathe.sources.tables import table

PRICE_MIN, PRICE_MAX = 15_000, 500_000
# fixed values: ordered priority labels (the survey's ordered answer set)
PRIORITY_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def cleaned_orders(spark, sf):
    """F01 + P11: price in range, log1p target."""
    o = table(spark, sf, "orders")
    o = filters.filter_range(o, "o_totalprice", PRICE_MIN, PRICE_MAX)
    return o.withColumn("y", numeric.log1p_target("o_totalprice"))


def split_orders(spark, sf):
    """D01 + D02: 20-edge target bins, exact 70/15/15 split per bin (the
    hashed, bucket-numbered rows are staged once inside the split, so later
    fits and aggregates re-read them instead of recomputing)."""
    binned = split.target_bins(cleaned_orders(spark, sf), "y", 20, out="stratum")
    return split.stratified_split(binned, "o_orderkey", "stratum")


_SQL_BASE = """
WITH base AS (
  SELECT *, ln(1 + o_totalprice) AS y FROM orders
  WHERE o_totalprice >= 15000 AND o_totalprice <= 500000),
mm AS (SELECT min(y) AS lo, max(y) AS hi FROM base),
binned AS (
  SELECT base.*, CAST(least(greatest(floor((y - lo) / (hi - lo) * 19) + 1, 1), 19) AS INTEGER) AS stratum
  FROM base, mm),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) AS rk,
         count(*) OVER (PARTITION BY stratum) AS n
  FROM binned),
splitted AS (
  SELECT *, CASE WHEN rk <= floor((n * 70 + 50) / 100) THEN 'train'
                 WHEN rk <= floor((n * 85 + 50) / 100) THEN 'val' ELSE 'test' END AS split
  FROM ranked)
"""


@query("f01_filter_range", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice BETWEEN 15000 AND 500000 AND o_orderstatus = 'F'""")
def f01(spark, sf):
    o = table(spark, sf, "orders")
    return filters.filter_range(o, "o_totalprice", PRICE_MIN, PRICE_MAX,
                                equals={"o_orderstatus": "F"}).select("o_orderkey", "o_totalprice")


@query("p11_log1p_target", """
SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS y,
       round(exp(ln(1 + o_totalprice)) - 1, 2) AS price_back
FROM orders WHERE o_totalprice BETWEEN 15000 AND 500000""")
def p11(spark, sf):
    o = cleaned_orders(spark, sf)
    return o.select("o_orderkey", F.round("y", 6).alias("y"),
                    F.round(numeric.expm1_inverse("y"), 2).alias("price_back"))


@query("d01_target_bins", _SQL_BASE + """
SELECT stratum, count(*) AS n, round(min(y), 6) AS y_min, round(max(y), 6) AS y_max
FROM binned GROUP BY stratum""")
def d01(spark, sf):
    b = split.target_bins(cleaned_orders(spark, sf), "y", 20, out="stratum")
    return b.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("y"), 6).alias("y_min"),
                                    F.round(F.max("y"), 6).alias("y_max"))


@query("d02_stratified_split", _SQL_BASE + """
SELECT o_orderkey, stratum, split FROM splitted""")
def d02(spark, sf):
    return split_orders(spark, sf).select("o_orderkey", "stratum", "split")


@query("a09_mean_std_by_split", _SQL_BASE + """
SELECT split, count(y) AS n, round(avg(y), 4) AS mean, round(median(y), 4) AS median,
       round(stddev_samp(y), 4) AS std
FROM splitted GROUP BY split""")
def a09(spark, sf):
    return profile.mean_std_by_split(split_orders(spark, sf), "y", "split")


_MOMENTS = """
, mom AS (SELECT split, avg(y) AS m, stddev_pop(y) AS s FROM splitted GROUP BY split)
SELECT p.split, 'y' AS column, count(*) AS n,
       round(avg(power((y - m) / s, 3)), 6) AS skewness,
       round(avg(power((y - m) / s, 4)) - 3, 6) AS kurtosis
FROM splitted p JOIN mom USING (split) GROUP BY p.split"""


@query("a06_skew_kurtosis_by_split", _SQL_BASE + _MOMENTS)
def a06(spark, sf):
    return profile.skew_kurtosis(split_orders(spark, sf), ["y"], by=["split"])


@query("a21_split_shape_report", _SQL_BASE + """
SELECT split, count(*) AS rows, count(DISTINCT o_custkey) AS ids,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct
FROM splitted GROUP BY split""")
def a21(spark, sf):
    return profile.split_shape_report(split_orders(spark, sf), "split", "o_custkey")


def flagship(spark, sf):
    """The regression track end to end: per split n, mean, median, std,
    population skewness and excess kurtosis of the log target."""
    s = split_orders(spark, sf)
    stats = profile.mean_std_by_split(s, "y", "split")
    mom = profile.skew_kurtosis(s, ["y"], by=["split"]).drop("column", "n")
    return stats.join(mom, "split").orderBy("split")


@query("m36_regression_flow_summary", _SQL_BASE + """
, mom AS (SELECT split, avg(y) AS m, stddev_pop(y) AS s FROM splitted GROUP BY split)
SELECT p.split, count(y) AS n, round(avg(y), 4) AS mean, round(median(y), 4) AS median,
       round(stddev_samp(y), 4) AS std,
       round(avg(power((y - m) / s, 3)), 6) AS skewness,
       round(avg(power((y - m) / s, 4)) - 3, 6) AS kurtosis
FROM splitted p JOIN mom USING (split) GROUP BY p.split""")
def m36_reg(spark, sf):
    return flagship(spark, sf)


@query("f02_filter_match_ci_either", """
SELECT o_orderkey FROM orders
WHERE coalesce(upper(o_orderstatus) = 'F', false)
   OR coalesce(upper(substr(o_orderpriority, 3)) = 'HIGH', false)""")
def f02(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus",
                                          F.substring("o_orderpriority", 3, 100).alias("prio_text"))
    return o.filter(filters.match_ci_either("o_orderstatus", "prio_text", "f") |
                    filters.match_ci_either("prio_text", "prio_text", "high")).select("o_orderkey")


@query("f06_filter_zscore", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders)
SELECT o_orderkey FROM orders, s WHERE abs((o_totalprice - m) / sd) <= 1.5""")
def f06(spark, sf):
    return filters.filter_zscore(table(spark, sf, "orders"), "o_totalprice", 1.5).select("o_orderkey")


@query("f07_filter_upper_cap", """
SELECT o_orderkey FROM orders WHERE o_totalprice < 400000""")
def f07(spark, sf):
    return filters.filter_upper_cap(table(spark, sf, "orders"), "o_totalprice", 400000).select("o_orderkey")


@query("a07_quantiles", """
SELECT round(quantile_cont(o_totalprice, 0.10), 4) AS p10, round(quantile_cont(o_totalprice, 0.25), 4) AS p25,
       round(quantile_cont(o_totalprice, 0.50), 4) AS p50, round(quantile_cont(o_totalprice, 0.75), 4) AS p75,
       round(quantile_cont(o_totalprice, 0.90), 4) AS p90, round(quantile_cont(o_totalprice, 0.95), 4) AS p95,
       round(quantile_cont(o_totalprice, 0.99), 4) AS p99
FROM orders""")
def a07(spark, sf):
    return profile.quantiles(table(spark, sf, "orders"), "o_totalprice")


@query("a07_quantiles_nearest_by_status", """
WITH r AS (SELECT o_orderstatus, o_totalprice,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS rk,
                  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderstatus,
       round(max(CASE WHEN rk = floor((n - 1) * 0.25 + 0.5) + 1 THEN o_totalprice END), 4) AS p25,
       round(max(CASE WHEN rk = floor((n - 1) * 0.5 + 0.5) + 1 THEN o_totalprice END), 4) AS p50,
       round(max(CASE WHEN rk = floor((n - 1) * 0.75 + 0.5) + 1 THEN o_totalprice END), 4) AS p75
FROM r GROUP BY o_orderstatus""")
def a07n(spark, sf):
    return profile.quantiles(table(spark, sf, "orders"), "o_totalprice", qs=(0.25, 0.5, 0.75),
                             method="nearest", by=["o_orderstatus"])


@query("a08_median_by_priority", """
SELECT o_orderpriority, round(median(o_totalprice), 4) AS median FROM orders GROUP BY o_orderpriority""")
def a08(spark, sf):
    m = profile.median_by(table(spark, sf, "orders"), "o_totalprice", ["o_orderpriority"])
    return m.select("o_orderpriority", F.round("median", 4).alias("median"))


@query("p22_tier_label", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b,
                  quantile_cont(o_totalprice, 0.75) AS c FROM orders)
SELECT CASE WHEN o_totalprice < a THEN 'low' WHEN o_totalprice < b THEN 'lower_mid'
            WHEN o_totalprice < c THEN 'upper_mid' ELSE 'high' END AS tier,
       count(*) AS n
FROM orders, q GROUP BY tier""")
def p22(spark, sf):
    o = table(spark, sf, "orders")
    q = exact_quantiles(o, "o_totalprice", [0.25, 0.5, 0.75], names=["a", "b", "c"]).first()
    edges = [("low", None, q["a"]), ("lower_mid", q["a"], q["b"]),
             ("upper_mid", q["b"], q["c"]), ("high", q["c"], None)]
    return o.select(rules.tier_label("o_totalprice", edges).alias("tier")).groupBy("tier") \
        .agg(F.count(F.lit(1)).alias("n"))


@query("a19_histogram_by_status", """
WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT o_orderstatus, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)) + 1, 20) AS INTEGER) AS bin, lo, hi
      FROM orders, mm)
SELECT o_orderstatus, bin, round(min(lo) + (bin - 1) * ((min(hi) - min(lo)) / 20), 6) AS bin_lo, count(*) AS count,
       round(count(*) / (sum(count(*)) OVER (PARTITION BY o_orderstatus) * ((min(hi) - min(lo)) / 20)), 12) AS density
FROM b GROUP BY o_orderstatus, bin""")
def a19(spark, sf):
    return profile.histogram(table(spark, sf, "orders"), "o_totalprice", 20, by=["o_orderstatus"])


@query("a20_box_stats_by_priority", """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS med,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY o_orderpriority),
j AS (SELECT o.o_orderpriority, o_totalprice AS v, q1, med, q3, q3 - q1 AS iqr FROM orders o JOIN q USING (o_orderpriority))
SELECT o_orderpriority, count(*) AS n, round(min(q1), 4) AS q1, round(min(med), 4) AS median, round(min(q3), 4) AS q3,
       round(min(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END), 4) AS whisker_lo,
       round(max(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END), 4) AS whisker_hi,
       count(*) FILTER (WHERE NOT (v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr)) AS outliers
FROM j GROUP BY o_orderpriority""")
def a20(spark, sf):
    return profile.box_stats(table(spark, sf, "orders"), "o_totalprice", ["o_orderpriority"])


@query("e01_ordinal_encode_priority", """
SELECT o_orderkey, CAST(CASE trim(o_orderpriority) WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
       WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 3 WHEN '5-LOW' THEN 4 ELSE -1 END AS INTEGER) AS o_orderpriority_ordinal
FROM orders""")
def e01(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return encode.ordinal_encode(o, {"o_orderpriority": PRIORITY_ORDER}).select(
        "o_orderkey", "o_orderpriority_ordinal")


@query("p12_timestamp_parts", """
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week,
       CAST(hour(o_orderdate) AS INTEGER) AS hour FROM orders""")
def p12(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", *dates.timestamp_parts("o_orderdate"))


@query("j07_add_row_id_dense", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders""")
def j07(spark, sf):
    from lathe.operators.project import add_row_id
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return add_row_id(o, None, "row_id", dense_order=["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_id")
