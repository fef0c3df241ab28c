"""Leakage-safe splits, folds and samples.

Randomness comes only from ``hash_order`` (md5 of key and seed), and ranks
are exact per stratum: splits, sizes and undersampling locate their cut
points by counts per md5 prefix (``cut_by_hash``), so only the rows of the
cut buckets are ever ranked; folds, which need every rank, go through
``hash_rank_within``.  The uniform prefix cuts a stratum holding a third of
the rows into many balanced buckets either way."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from lathe.functions.hashing import DEFAULT_SEED, hash_order
from lathe.operators.ordering import cut_by_hash, hash_rank_within
from lathe.operators.profile import last_by_group
from lathe.session import stage_table


def fit_range(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def target_bins(df: DataFrame, y: str, n_edges: int = 20, out: str = "stratum",
                lo: float | None = None, hi: float | None = None) -> DataFrame:
    """``n_edges`` equally spaced edges from min to max, digitize, and clip
    to ``1 .. n_edges-1`` (the maximum joins the last bin)."""
    if lo is None or hi is None:
        lo, hi = fit_range(df, y)
    k = n_edges - 1
    span = (hi - lo) if hi > lo else 1.0
    b = F.floor((F.col(y) - F.lit(lo)) / F.lit(span) * F.lit(k)) + 1
    return df.withColumn(out, F.least(F.greatest(b, F.lit(1)), F.lit(k)).cast("int"))


def _cuts(fractions) -> list[Fraction]:
    """Running sums of the fractions, exactly as written in decimals."""
    acc, out = Fraction(0), []
    for f in fractions[:-1]:
        acc += Fraction(str(f))
        out.append(acc)
    return out


def stratified_split(df: DataFrame, key: str, strata: str | None = None,
                     fractions=(0.70, 0.15, 0.15), names=("train", "val", "test"),
                     seed=DEFAULT_SEED, out: str = "split") -> DataFrame:
    """Exact proportions per stratum: rows ordered by ``md5(key|seed)`` inside
    their stratum; the first ``round(n·f1)`` are ``train``, up to
    ``round(n·(f1+f2))`` ``val``, the rest ``test``.  Disjoint, exhaustive,
    deterministic in the seed and independent of partitioning; rows of one
    key (and stratum) never part.  Wide rows are not shuffled."""
    def target(part: Fraction):
        return lambda n: F.floor((n * (2 * part.numerator) + part.denominator) / (2 * part.denominator))
    cut = cut_by_hash(df, [strata] if strata else [], key, [target(p) for p in _cuts(fractions)], seed=seed)
    expr = F.element_at(F.array(*[F.lit(nm) for nm in names[:len(fractions)]]), F.col("_part") + 1)
    return cut.withColumn(out, expr).drop("_part")


def group_stratified_split(df: DataFrame, id_col: str, order_col: str, label_col: str,
                           tiebreak: str | None = None, fractions=(0.70, 0.15, 0.15),
                           seed=DEFAULT_SEED, out: str = "split") -> DataFrame:
    """Split ids, stratified by their last known label; every row of an id
    lands in the id's split.  The per-id table has one row per id, so the
    join back is a plain (AQE, skew-join capable) equi-join."""
    last = stage_table(last_by_group(df, id_col, order_col, label_col, tiebreak=tiebreak, out="_last_label")
                       .select(id_col, "_last_label"), "last-labels")
    ids = stratified_split(last, id_col, "_last_label", fractions=fractions, seed=seed, out=out)
    return df.join(ids.select(id_col, out), id_col, "inner")


def assign_folds(df: DataFrame, key: str, k: int = 5, strata: str | None = None,
                 seed=DEFAULT_SEED, out: str = "fold") -> DataFrame:
    """k folds: ``(rank - 1) mod k`` in hash order, inside each stratum when
    one is given (stratified k-fold), else over the whole table."""
    groups = [strata] if strata else []
    ranked = hash_rank_within(df, groups, key, seed=seed, rank_col="_rank", count_col=None,
                              bounded_groups=True)
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def learning_sizes(df: DataFrame, key: str, n_sizes: int = 8, lo: float = 0.25, hi: float = 1.0,
                   seed=DEFAULT_SEED, out: str = "size_index") -> DataFrame:
    """Nested training subsets: fractions ``linspace(lo, hi, n_sizes)``; a row
    belongs to every size from ``size_index`` on (hash-ordered prefixes)."""
    fr = [lo + (hi - lo) * i / (n_sizes - 1) for i in range(n_sizes)] if n_sizes > 1 else [hi]
    def target(f: float):
        return lambda n: F.floor(n * F.lit(f) + F.lit(0.5))
    # the number of cuts before a row is the smallest size that holds it
    cut = cut_by_hash(df, [], key, [target(f) for f in fr], seed=seed)
    return cut.withColumn(out, F.when(F.col("_part") < len(fr), F.col("_part"))).drop("_part")


def sample_rows(df: DataFrame, key: str, n: int, seed=DEFAULT_SEED) -> DataFrame:
    """n rows without replacement: the n smallest hashes (a bounded top-n
    per partition, then a merge — never a full sort)."""
    return df.withColumn("_h", hash_order(key, seed=seed)).orderBy("_h", key).limit(n).drop("_h")


def sample_per_group(df: DataFrame, key: str, group: Column | str, n: int = 1,
                     seed=DEFAULT_SEED) -> DataFrame:
    """n hash-chosen rows per group (e.g. one TP/FP/FN/TN example each)."""
    from lathe.operators.windows import top_k_per_group
    g = F.col(group) if isinstance(group, str) else group
    d = df.withColumn("_g", g).withColumn("_h", hash_order(key, seed=seed))
    return top_k_per_group(d, ["_g"], [F.col("_h").asc()], n, tiebreak=key) \
        .drop("_h", "rank").withColumnRenamed("_g", "group")
