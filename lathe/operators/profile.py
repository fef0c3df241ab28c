"""Profiling aggregates (A01-A21).  Wide statistics are computed in ONE
aggregate over all columns and then stacked, instead of one scan per column;
quantiles are exact and computed without a one-task window."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lathe.operators.gram import gram_blocks
from lathe.operators.quantiles import exact_quantiles, wide_quantiles


def unpivot(df: DataFrame, ids: list[str], cols: list[str], var: str = "column",
            value: str = "value") -> DataFrame:
    """Long form ``(ids..., column, value)`` with values cast to double."""
    casted = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(ids, cols, var, value)


def null_profile(df: DataFrame, cols=None, only_missing: bool = True) -> DataFrame:
    """Per column NULL count and percentage, sorted descending."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nc__{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    stacked = one.selectExpr(
        "_n", f"stack({len(cols)}, " + ", ".join(
            f"'{c}', `nc__{i}`" for i, c in enumerate(cols)) + ") as (column, null_count)")
    out = stacked.select("column", F.col("null_count").cast("long").alias("null_count"),
                         F.round(F.col("null_count") * 100.0 / F.col("_n"), 4).alias("null_pct"))
    if only_missing:
        out = out.where(F.col("null_count") > 0)
    return out.orderBy(F.desc("null_count"), "column")


def _by_column(df: DataFrame, cols: list[str], measures: dict, by: list[str] | None = None) -> DataFrame:
    """(by..., column, a column for each measure) from one aggregate over all
    columns; a measure is a function of a column."""
    by = list(by or [])
    one = df.groupBy(*by).agg(*[F.struct(*[m(F.col(c)).alias(k) for k, m in measures.items()]).alias(f"_m{i}")
                                for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("m"))
             for i, c in enumerate(cols)]
    return (one.select(*by, F.explode(F.array(*cells)).alias("_c"))
            .select(*by, "_c.column", *[F.col(f"_c.m.{k}").alias(k) for k in measures]))


def describe_table(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """count, null_count, mean, std (sample), min, 25/50/75 %, max per
    column: one aggregate over all columns, and exact quantiles of all."""
    number = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    out = _by_column(number, cols, {
        "count": F.count, "null_count": lambda c: F.count_if(c.isNull()), "mean": F.avg, "std": F.stddev_samp,
        "min": F.min, "max": F.max})
    q = wide_quantiles(number, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"], stage=False)
    out = out.join(q, "column", "left")
    r = lambda c: F.round(F.col(c), digits).alias(c)
    return out.select("column", F.col("count").cast("long").alias("count"),
                      F.col("null_count").cast("long").alias("null_count"),
                      r("mean"), r("std"), r("min"), r("p25"), r("p50"), r("p75"), r("max"))


def value_counts(df: DataFrame, col: str, n: int | None = None, pct: bool = False,
                 sort: bool = True) -> DataFrame:
    """Frequency per value, descending, ties broken by value."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if pct:
        t = df.count()
        out = out.withColumn("pct", F.round(F.col("count") * 100.0 / F.lit(t), 4))
    if sort or n:
        out = out.orderBy(F.desc("count"), F.asc_nulls_last(col))
    if n:
        out = out.limit(n)
    return out


def n_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct count per column, NULL counting as one value; one pass."""
    aggs = [(F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).cast("long")
            .alias(f"nu__{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    return one.selectExpr(f"stack({len(cols)}, " + ", ".join(
        f"'{c}', `nu__{i}`" for i, c in enumerate(cols)) + ") as (column, n_unique)")


def distinct_up_to(df: DataFrame, cols: list[str], limit: int) -> dict[str, int]:
    """Distinct values per column, NULL one of them, counted no further than
    ``limit``: tasks keep at most that many values a column, so nothing grows
    with a column's vocabulary."""
    def run(batches):
        seen = [set() for _ in cols]
        for batch in batches:
            for values, column in zip(seen, batch.columns):
                if len(values) < limit:
                    values.update(column.unique().slice(0, limit).to_pylist())
        rows = [(i, v) for i, values in enumerate(seen) for v in sorted(values, key=lambda v: (v is None, v))[:limit]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                          pa.array([r[1] for r in rows], pa.string())], names=["at", "value"])
    text = df.select(*[F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(cols)])
    counts = text.mapInArrow(run, "at int, value string").distinct().groupBy("at").count().collect()
    return {c: 0 for c in cols} | {cols[r["at"]]: min(r["count"], limit) for r in counts}


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(F.asc_nulls_first(col))


def skew_kurtosis(df: DataFrame, cols: list[str], by: list[str] | None = None,
                  digits: int = 6) -> DataFrame:
    """Population skewness (g1) and excess kurtosis per column (and group)."""
    by = list(by or [])
    number = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return _by_column(number, cols, {"n": F.count, "skewness": lambda c: F.round(F.skewness(c), digits),
                                     "kurtosis": lambda c: F.round(F.kurtosis(c), digits)}, by)


def quantiles(df: DataFrame, col: str, qs=(0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99),
              method: str = "linear", by: list[str] | None = None, digits: int = 4) -> DataFrame:
    names = [f"p{int(round(q * 100)):02d}" for q in qs]
    q = exact_quantiles(df, col, list(qs), group_cols=by, method=method, names=names)
    return q.select(*(by or []), *[F.round(n, digits).alias(n) for n in names])


def median_by(df: DataFrame, col: str, by: list[str] | None = None,
              bounded_groups: bool = False) -> DataFrame:
    return exact_quantiles(df, col, [0.5], group_cols=by, names=["median"])


def mean_std_by_split(df: DataFrame, col: str, split: str = "split", digits: int = 4) -> DataFrame:
    """n, mean, median, sample std of ``col`` per split."""
    base = df.groupBy(split).agg(F.count(col).alias("n"), F.avg(col).alias("mean"),
                                 F.stddev_samp(col).alias("std"))
    med = median_by(df, col, [split], bounded_groups=True)
    out = base.join(med, split, "left")
    return out.select(split, F.col("n").cast("long").alias("n"),
                      *[F.round(c, digits).alias(c) for c in ("mean", "median", "std")])


def class_balance(df: DataFrame, target: str, digits: int = 4) -> DataFrame:
    """Per class: count, percentage, and majority:minority ratio."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy()  # over a handful of class rows only
    return counts.select(
        target, F.col("count").cast("long").alias("count"),
        F.round(F.col("count") * 100.0 / F.sum("count").over(w), digits).alias("pct"),
        F.round(F.max("count").over(w) / F.min("count").over(w), digits).alias("imbalance_ratio"))


def rate_by_category(df: DataFrame, cats: list[str], target: Column, min_count: int = 1,
                     top: int | None = 5, digits: int = 4) -> DataFrame:
    """Positives, total and rate (%) per value of each category column, in
    one grouped pass over an unpivoted table; top ``top`` per column by rate
    (ties by value), keeping groups with more than ``min_count`` rows."""
    long = df.select(target.cast("int").alias("_y"),
                     *[F.col(c).cast("string").alias(c) for c in cats]) \
        .unpivot(["_y"], cats, "feature", "category")
    g = long.groupBy("feature", "category").agg(
        F.sum("_y").cast("long").alias("positives"), F.count(F.lit(1)).alias("total"))
    g = g.withColumn("rate_pct", F.round(F.col("positives") * 100.0 / F.col("total"), digits))
    if top:
        # a feature may have millions of categories: two-phase salted top-k
        from lathe.operators.windows import top_k_per_group
        g = top_k_per_group(g, ["feature"], [F.desc("rate_pct"), F.asc_nulls_first("category")], top,
                            tiebreak="category").drop("rank")
    return g.where(F.col("total") > min_count)


def mean_diff_by_class(df: DataFrame, feats: list[str], target: Column, digits: int = 4) -> DataFrame:
    """Per feature: class means, difference and % difference."""
    number = df.select(target.cast("int").alias("_y"), *[F.col(c).cast("double").alias(c) for c in feats])
    g = _by_column(number, feats, {"mean_pos": lambda c: F.avg(F.when(F.col("_y") == 1, c)),
                                   "mean_neg": lambda c: F.avg(F.when(F.col("_y") == 0, c))}) \
        .withColumnRenamed("column", "feature")
    return g.select("feature", F.round("mean_pos", digits).alias("mean_pos"),
                    F.round("mean_neg", digits).alias("mean_neg"),
                    F.round(F.col("mean_pos") - F.col("mean_neg"), digits).alias("diff"),
                    F.round((F.col("mean_pos") - F.col("mean_neg")) * 100.0 /
                            F.nullif(F.col("mean_neg"), F.lit(0.0)), digits).alias("diff_pct"))


def group_means(df: DataFrame, by: list[str], cols: list[str], digits: int = 4) -> DataFrame:
    return df.groupBy(*by).agg(*[F.round(F.avg(c), digits).alias(f"mean_{c}") for c in cols])


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair on complete rows, both ways round, from
    one Gram block (any number of columns in one pass); NULL where a column
    is constant."""
    complete = df.select(*cols).na.drop("any")
    block = gram_blocks(complete, cols[:-1], cols[-1]).total()
    n = block[0, 0]
    cov = block[1:, 1:] - np.outer(block[0, 1:], block[0, 1:]) / n if n else np.zeros((len(cols), len(cols)))
    spread = np.sqrt(np.maximum(np.diag(cov), 0))
    rows = [(a, b, float(np.clip(cov[i, j] / (spread[i] * spread[j]), -1, 1)) if spread[i] and spread[j] else None)
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double") \
        .withColumn("r", F.round("r", digits))


def target_correlation_topk(df: DataFrame, target: Column, feats: list[str], k: int,
                            digits: int = 6) -> DataFrame:
    t = df.select(target.cast("double").alias("_t"), *feats)
    one = t.agg(*[F.corr(f, "_t").alias(f"r__{i}") for i, f in enumerate(feats)])
    long = one.selectExpr(f"stack({len(feats)}, " + ", ".join(
        f"'{f}', `r__{i}`" for i, f in enumerate(feats)) + ") as (feature, r)")
    return (long.select("feature", F.round("r", digits).alias("r"),
                        F.round(F.abs("r"), digits).alias("abs_r"))
            .orderBy(F.desc("abs_r"), "feature").limit(k))


def last_by_group(df: DataFrame, id_col: str, order_col: str, col: str,
                  tiebreak: str | None = None, out: str | None = None) -> DataFrame:
    """Latest value per id: ``max_by`` on (order, tiebreak) — a partial
    aggregate, so a hot id is pre-reduced on every mapper."""
    key = F.struct(order_col, tiebreak) if tiebreak else F.col(order_col)
    return df.groupBy(id_col).agg(F.max_by(col, key).alias(out or col))


def duplicate_report(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Key combinations occurring more than once, with their count."""
    keys = keys or df.columns
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """All rows whose key combination (every column by default) occurs more
    than once; NULLs count as equal."""
    keys = keys or df.columns
    twice = duplicate_report(df, keys).select(*[F.col(k).alias(f"_d_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys]
    return df.join(twice, reduce(lambda a, b: a & b, same), "left_semi")


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(subset) if subset else df.distinct()


def histogram(df: DataFrame, col: str, bins: int, by: list[str] | None = None,
              lo: float | None = None, hi: float | None = None, digits: int = 6) -> DataFrame:
    """Equal-width bin counts over [lo, hi] (fitted from the data when not
    given), bin index 1..bins (max value in the last bin), density =
    count / (n · width) per group."""
    by = list(by or [])
    if lo is None or hi is None:
        r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        lo, hi = (r["lo"] if lo is None else lo), (r["hi"] if hi is None else hi)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins)).cast("int")
    g = df.where(F.col(col).isNotNull()).groupBy(*by, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    n = F.sum("count").over(Window.partitionBy(*by))  # over <= groups*bins rows
    return g.select(*by, "bin",
                    F.round(F.lit(lo) + (F.col("bin") - 1) * F.lit(width), digits).alias("bin_lo"),
                    F.col("count").cast("long").alias("count"),
                    F.round(F.col("count") / (n * F.lit(width)), 12).alias("density"))


def box_stats(df: DataFrame, col: str, by: list[str], digits: int = 4,
              bounded_groups: bool = False) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers (most extreme values inside the fences)
    and outlier count per group."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], group_cols=by, names=["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = df.select(*by, col).where(F.col(col).isNotNull()).join(
        q, by)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    inside = (F.col(col) >= lo_f) & (F.col(col) <= hi_f)
    g = j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"))
    return g.select(*by, F.col("n").cast("long").alias("n"),
                    *[F.round(c, digits).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    F.col("outliers").cast("long").alias("outliers"))


def split_shape_report(df: DataFrame, split: str = "split", id_col: str | None = None,
                       digits: int = 4) -> DataFrame:
    """Rows, distinct ids and row share per split."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if id_col:
        aggs.append(F.count_distinct(id_col).alias("ids"))
    g = df.groupBy(split).agg(*aggs)
    share = F.round(F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy()), digits)
    return g.select(split, F.col("rows").cast("long").alias("rows"),
                    *([F.col("ids").cast("long").alias("ids")] if id_col else []),
                    share.alias("share_pct"))


def leakage_check(df: DataFrame, target: Column, feats: list[str], threshold: float = 0.99,
                  digits: int = 6) -> DataFrame:
    """Target-leakage guard: Pearson r of every feature with the target in
    one aggregate; ``leak`` is true when |r| exceeds the threshold (e.g. the
    raw target left among the features of its own log transform)."""
    t = df.select(target.cast("double").alias("_t"), *feats)
    one = t.agg(*[F.corr(f, "_t").alias(f"r__{i}") for i, f in enumerate(feats)])
    long = one.selectExpr(f"stack({len(feats)}, " + ", ".join(
        f"'{f}', `r__{i}`" for i, f in enumerate(feats)) + ") as (feature, r)")
    return long.select("feature", F.round("r", digits).alias("r"),
                       (F.abs("r") > F.lit(threshold)).alias("leak"))
