"""Projection and schema operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from lathe.functions.hashing import hash_order
from lathe.operators.ordering import global_row_number


def only_existing(df: DataFrame, cols) -> list[str]:
    """The subset of ``cols`` present in ``df`` (schema-tolerant steps)."""
    present = set(df.columns)
    return [c for c in cols if c in present]


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_mapped(df: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Keep only mapped columns (renamed); also return the dropped names."""
    kept = [F.col(k).alias(v) for k, v in mapping.items() if k in df.columns]
    dropped = [c for c in df.columns if c not in mapping]
    return df.select(*kept), dropped


def drop_existing(df: DataFrame, cols) -> DataFrame:
    return df.drop(*only_existing(df, cols))


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def infer_feature_roles(df: DataFrame, target: str | None = None, abs_card: int = 100,
                        rel_card: float = 0.1) -> DataFrame:
    """numeric / categorical / text per column in ONE aggregate pass:
    integer and float columns are numeric; a string column is categorical
    when it has fewer than ``abs_card`` distinct values or a distinct ratio
    below ``rel_card``, else text; any other type is categorical."""
    spark = df.sparkSession
    cols = [f for f in df.schema.fields if f.name != target]
    str_cols = [f.name for f in cols if isinstance(f.dataType, T.StringType)]
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [(F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).alias(f"_nu_{i}")
             for i, c in enumerate(str_cols)]
    stats = df.agg(*aggs)
    rows = []
    for f in cols:
        kind = ("numeric" if isinstance(f.dataType, _NUMERIC)
                else "string" if isinstance(f.dataType, T.StringType) else "other")
        rows.append((f.name, f.dataType.simpleString(), kind,
                     str_cols.index(f.name) if kind == "string" else -1))
    meta = spark.createDataFrame(rows, "column string, dtype string, kind string, pos int")
    # stack the one-row stats into (pos, n_unique) and attach
    if str_cols:
        stack = "stack({n}, {pairs}) as (pos, n_unique)".format(
            n=len(str_cols), pairs=", ".join(f"{i}, `_nu_{i}`" for i in range(len(str_cols))))
        long = stats.selectExpr("_total", stack)
    else:
        long = stats.selectExpr("_total", "cast(-2 as int) as pos", "cast(null as bigint) as n_unique")
    j = meta.join(F.broadcast(long), "pos", "left")
    role = (F.when(F.col("kind") == "numeric", "numeric")
            .when((F.col("kind") == "string") &
                  ((F.col("n_unique") < abs_card) |
                   (F.col("n_unique") / F.col("_total") < rel_card)), "categorical")
            .when(F.col("kind") == "string", "text")
            .otherwise("categorical"))
    return j.select("column", "dtype", F.col("n_unique").cast("long").alias("n_unique"),
                    role.alias("role"))


def horizontal_concat(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Glue two column sets of the same rows by key, never by position."""
    return left.join(right, key, "inner")


def add_row_id(df: DataFrame, keys, col: str = "row_id", dense_order=None) -> DataFrame:
    """A stable row key: md5 of the key columns, or with ``dense_order`` a
    dense 1-based number in that order (exact, computed without a one-task
    window)."""
    if dense_order is not None:
        return global_row_number(df, dense_order, col=col)
    return df.withColumn(col, hash_order(*keys, seed="row"))
