"""Window functions and ordering (W01-W06), written so that no single key
or the whole table ends up in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lathe.functions.hashing import hash_int
from lathe.operators.ordering import global_row_number, stage_sorted


def forward_fill(df: DataFrame, id_col: str, order_col: str, cols: list[str],
                 tiebreak: str | None = None, partitions: int | None = None) -> DataFrame:
    """Carry the last non-NULL value forward inside each id, in
    ``(order_col, tiebreak)`` order (a leading NULL stays NULL).

    Rows are range-partitioned by id and order, which splits an id of any size,
    also one whose rows fall into a short time, over as many partitions as it
    fills.  Each part is filled by itself; the last non-NULL value of every
    (partition, id) is carried on in a table with one row for each part of an
    id, and joined back.
    """
    order = [F.col(order_col)] + ([F.col(tiebreak)] if tiebreak else [])
    parts = stage_sorted(df, [id_col], order, partitions, "forward-fill")
    upto = Window.partitionBy("_pid", id_col).orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    local = parts.select(*[F.col(c) for c in df.columns if c not in cols], "_pid",
                         *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in cols])
    last = parts.groupBy("_pid", id_col).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_idx"))).alias(f"_last_{c}") for c in cols])
    before = Window.partitionBy(id_col).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(F.col("_pid").alias("_cpid"), F.col(id_col).alias("_cid"),
                        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_prev_{c}") for c in cols])
    j = local.join(carry, F.col(id_col).eqNullSafe(F.col("_cid")) & (F.col("_pid") == F.col("_cpid")), "left")
    return j.select(*[F.coalesce(F.col(c), F.col(f"_prev_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def top_k_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first(col)).limit(k))


def frequency_rank(df: DataFrame, col: str, ascending: bool = False, out: str = "code") -> DataFrame:
    """0-based code per value by frequency (most frequent = 0 unless
    ``ascending``), ties broken by value; exact without a one-task window."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    cnt = F.col("count").asc() if ascending else F.col("count").desc()
    ranked = global_row_number(counts, [cnt, F.col(col).asc_nulls_first()], col="_rn")
    return ranked.select(col, F.col("count").cast("long").alias("count"),
                         (F.col("_rn") - 1).cast("int").alias(out))


def sort_table(df: DataFrame, by, ascending: bool = True) -> DataFrame:
    return df.orderBy(*[F.col(b).asc() if ascending else F.col(b).desc() for b in by])


def top_n(df: DataFrame, by, n: int) -> DataFrame:
    return df.orderBy(*[F.col(b).desc() if isinstance(b, str) else b for b in by]).limit(n)


def bottom_n(df: DataFrame, by, n: int) -> DataFrame:
    return df.orderBy(*[F.col(b).asc() if isinstance(b, str) else b for b in by]).limit(n)


def arg_best(df: DataFrame, metric: str, cols: list[str], how: str = "min",
             tiebreak: str | None = None) -> DataFrame:
    """The row with the min / max metric, as one aggregate (``min_by``)."""
    key = F.struct(F.col(metric), F.col(tiebreak)) if tiebreak else F.col(metric)
    pick = F.min_by if how == "min" else F.max_by
    r = df.agg(pick(F.struct(*cols), key).alias("_b"))
    return r.select("_b.*")


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    tiebreak: str | None = None, salts: int = 16) -> DataFrame:
    """k first rows per group in ``order``.  Two phases so a hot group is not
    sorted in one task: top-k inside (group, salt) buckets, then top-k over
    the at most ``salts·k`` survivors of each group."""
    order = list(order) + ([F.col(tiebreak).asc_nulls_first()] if tiebreak else [])
    if salts > 1 and tiebreak:
        salted = df.withColumn("_salt", hash_int(tiebreak, modulus=salts, seed="salt"))
        w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k) \
            .drop("_r1", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
