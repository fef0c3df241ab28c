"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4,
         T.FloatType: 5, T.DoubleType: 6}


def _widen(types: list[T.DataType]) -> T.DataType:
    ranks = [_RANK.get(type(t)) for t in types]
    if all(r is not None for r in ranks):
        return types[ranks.index(max(ranks))]
    if len({t.simpleString() for t in types}) == 1:
        return types[0]
    return T.StringType()


def union_all_by_name(dfs: list[DataFrame]) -> DataFrame:
    """Vertical union by name; a column missing on one side is NULL there and
    numeric types are widened first (the ``diagonal_relaxed`` concat)."""
    types: dict[str, list] = {}
    for d in dfs:
        for f in d.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    target = {c: _widen(ts) for c, ts in types.items()}
    cast = [d.select(*[F.col(c).cast(target[c]).alias(c) for c in d.columns]) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def overlap_check(df: DataFrame, split_col: str, id_col: str) -> DataFrame:
    """Ids shared by each pair of splits (all zero for a leakage-safe
    split)."""
    placed = df.select(F.col(id_col).alias("_id"), F.col(split_col).alias("_s")).distinct()
    names = placed.select(F.col("_s").alias("split_a")).distinct()
    pairs = names.join(names.withColumnRenamed("split_a", "split_b"), F.col("split_a") < F.col("split_b"))
    met = (placed.alias("l").join(placed.alias("r"), F.col("l._id").eqNullSafe(F.col("r._id"))
                                  & (F.col("l._s") < F.col("r._s")))
           .groupBy(F.col("l._s").alias("split_a"), F.col("r._s").alias("split_b"))
           .agg(F.count(F.lit(1)).alias("n")))
    return (pairs.join(met, ["split_a", "split_b"], "left")
            .select("split_a", "split_b", F.coalesce("n", F.lit(0)).cast("long").alias("shared_ids")))


def set_difference(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys of ``left`` absent from ``right`` (left-anti join)."""
    keys = [key] if isinstance(key, str) else list(key)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")
