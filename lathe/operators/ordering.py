"""Exact ranks, running sums and quantiles without a one-task window.

A window without ``partitionBy`` (or one whose partition key holds a third
of the table) moves all those rows into one task.  These helpers instead

1. range-partition on ``(group..., order...)`` — Spark samples the keys, so
   a hot group is split over many tasks — and sort inside each partition;
2. record the partition id and the in-partition position
   (``monotonically_increasing_id`` after the sort), and stage the result
   as parquet in the shared checkpoint folder so later reads agree;
3. aggregate a small table of per-(partition, group) counts/sums (at most
   ``partitions + groups`` rows), prefix-sum it, and join it back.

The result is exact, deterministic and independent of partition counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lathe.session import num_partitions, stage_table


def _sort_cols(order_by) -> list[Column]:
    out = []
    for o in order_by:
        out.append(F.col(o).asc() if isinstance(o, str) else o)
    return out


def _null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    conds = [left[c].eqNullSafe(right[c]) for c in cols]
    return reduce(lambda a, b: a & b, conds)


def stage_sorted(df: DataFrame, group_cols: list[str], order_by, partitions: int | None,
                  name: str) -> DataFrame:
    spark = df.sparkSession
    p = partitions or num_partitions(spark)
    order = _sort_cols(list(group_cols) + list(order_by))
    keyed = (df.repartitionByRange(p, *order)
               .sortWithinPartitions(*order)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_idx", F.monotonically_increasing_id()))
    return stage_table(keyed, name)


def rank_within(df: DataFrame, group_cols: list[str], order_by, *,
                rank_col: str = "_rank", count_col: str | None = "_n",
                partitions: int | None = None, sums: dict | None = None,
                bounded_groups: bool = False) -> DataFrame:
    """Add the exact 1-based ``row_number`` of each row inside its group
    (ordered by ``order_by``; give a total order for determinism), the group
    size and, optionally, inclusive running sums ``{out_col: value_col}``.

    The join with the offset table is left to AQE, which broadcasts it only
    after measuring it; ``bounded_groups`` is kept for callers and changes nothing.
    """
    group_cols = list(group_cols)
    staged = stage_sorted(df, group_cols, order_by, partitions, "rank")
    sums = sums or {}
    keys = ["_pid"] + group_cols
    aggs = [F.min("_idx").alias("_first"), F.count(F.lit(1)).alias("_cnt")]
    aggs += [F.sum(v).alias(f"_s_{o}") for o, v in sums.items()]
    stats = staged.groupBy(*keys).agg(*aggs)
    w_prev = (Window.partitionBy(*group_cols).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    cols = [F.coalesce(F.sum("_cnt").over(w_prev), F.lit(0)).alias("_offset")]
    cols += [F.coalesce(F.sum(f"_s_{o}").over(w_prev), F.lit(0)).alias(f"_so_{o}")
             for o in sums]
    if count_col:
        cols.append(F.sum("_cnt").over(Window.partitionBy(*group_cols)).alias(count_col))
    stats = stats.select(*keys, "_first", *cols)
    s = stats.alias("_st")
    joined = staged.alias("_d").join(
        s, _null_safe_on(staged.alias("_d"), s, keys), "inner")
    out_cols = [F.col(f"_d.{c}") for c in staged.columns if c not in ("_pid", "_idx")]
    rank = (F.col("_d._idx") - F.col("_st._first") + F.col("_st._offset") + 1).cast("long")
    extra = [rank.alias(rank_col)]
    if count_col:
        extra.append(F.col(f"_st.{count_col}").cast("long").alias(count_col))
    if sums:
        # running sums need the in-partition prefix: a window on (pid, group)
        # ordered by position — each window partition is one range slice.
        base = joined.select(*out_cols, *extra, F.col("_d._pid").alias("_pid"),
                             F.col("_d._idx").alias("_idx"),
                             *[F.col(f"_st._so_{o}").alias(f"_so_{o}") for o in sums])
        w_loc = (Window.partitionBy("_pid", *group_cols).orderBy("_idx")
                 .rowsBetween(Window.unboundedPreceding, 0))
        base = base.select(
            "*", *[(F.sum(v).over(w_loc) + F.col(f"_so_{o}")).alias(o) for o, v in sums.items()])
        return base.drop("_pid", "_idx", *[f"_so_{o}" for o in sums])
    return joined.select(*out_cols, *extra)


def global_row_number(df: DataFrame, order_by, col: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """Dense 1-based numbering over the whole table in ``order_by`` order."""
    return rank_within(df, [], order_by, rank_col=col, count_col=None,
                       partitions=partitions, bounded_groups=True)


def global_cumsum(df: DataFrame, order_by, sums: dict, group_cols: list[str] | None = None,
                  partitions: int | None = None, bounded_groups: bool = True) -> DataFrame:
    """Inclusive running sums ``{out: value_col}`` in ``order_by`` order."""
    return rank_within(df, group_cols or [], order_by, rank_col="_rank", count_col="_n",
                       partitions=partitions, sums=sums, bounded_groups=bounded_groups)


# --------------------------------------------------------------------------
# Fast exact paths that need no staging.
#
# * hash order: md5 is uniform, so its leading hex digits cut every group
#   (however hot) into up to 16^digits balanced buckets; rows are numbered
#   inside (group, bucket) and the bucket counts are prefix-summed.
# * value order (single numeric key): approximate cut points (a bounded list
#   of scalars) define range buckets in which every cut value has a
#   singleton bucket of its own, so a hot value never has to be sorted;
#   bucket counts give exact offsets.
# --------------------------------------------------------------------------

def hash_rank_within(df: DataFrame, group_cols: list[str], key: str, *, seed=42,
                     rank_col: str = "_rank", count_col: str | None = "_n", digits: int = 4,
                     bounded_groups: bool = False, keep_hash: str | None = None,
                     stage: bool = True) -> DataFrame:
    """Exact 1-based rank of each row inside its group in ``(md5(key|seed),
    key)`` order, plus the group size.  One pass computes md5 and numbers the
    rows inside their (group, bucket); that table is staged once, and the
    bucket counts (at most ``groups · 16^digits`` rows) are read back from it
    and prefix-summed — so md5 and the shuffle happen once."""
    from lathe.functions.hashing import hash_order
    group_cols = list(group_cols)
    d = (df.withColumn("_h", hash_order(key, seed=seed))
           .withColumn("_hb", F.conv(F.substring("_h", 1, digits), 16, 10).cast("int")))
    wl = Window.partitionBy(*group_cols, "_hb").orderBy("_h", key)
    local = d.withColumn("_lr", F.row_number().over(wl))
    if not keep_hash:
        local = local.drop("_h")  # the ordering is already captured by (_hb, _lr)
    if stage:
        local = stage_table(local, "hash-rank")
    counts = local.groupBy(*group_cols, "_hb").agg(F.max("_lr").alias("_c"))
    w_prev = Window.partitionBy(*group_cols).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum("_c").over(w_prev), F.lit(0)).alias("_off")]
    if count_col:
        cols.append(F.sum("_c").over(Window.partitionBy(*group_cols)).cast("long").alias(count_col))
    offs = counts.select(*[F.col(g).alias(f"_g_{g}") for g in group_cols], F.col("_hb").alias("_ob"), *cols)
    cond = F.col("_hb") == F.col("_ob")
    for g in group_cols:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    j = local.join(offs, cond, "inner")
    out = j.withColumn(rank_col, (F.col("_off") + F.col("_lr")).cast("long"))
    drop = ["_hb", "_ob", "_lr", "_off", *[f"_g_{g}" for g in group_cols]]
    if keep_hash:
        out = out.withColumnRenamed("_h", keep_hash)
    return out.drop(*drop)


def cut_by_hash(df: DataFrame, group_cols: list[str], key: str, targets, *, seed=42, out: str = "_part",
                digits: int = 3) -> DataFrame:
    """Add ``out``: how many of the cuts each row lies beyond, in ``(md5(key|seed), key)`` order inside its
    group.  ``targets`` are functions from the group size to the (ascending) ranks of the last row before
    each cut.

    No wide row moves.  Counts per (group, bucket of the leading ``digits`` of the md5) are partial
    aggregates and locate the bucket of each cut; only the rows of those buckets are cut again by the next
    ``digits`` and ranked there, so a task ranks about one row in ``16**(2 * digits)`` of a group.  All rows
    are then labelled by comparison with their group's cut points.  With groups these (one row per group)
    are staged, so Spark knows their size: broadcast below its threshold, joined by AQE beyond it.  Without
    groups there is one per target.  Rows with equal keys lie on the same side of every cut."""
    from lathe.functions.hashing import hash_order
    gs = [f"_g{i}" for i in range(len(group_cols))]
    names = [f"_cut{i}" for i in range(len(targets))]
    h = hash_order(key, seed=seed)
    narrow = df.select(*[F.col(g).alias(a) for g, a in zip(group_cols, gs)], h.alias("_h"), F.col(key).alias("_key"),
                       F.substring(h, 1, digits).alias("_b"), F.substring(h, digits + 1, digits).alias("_sub"))

    def before(*by, order):
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_c").over(w), F.lit(0))

    n = F.sum("_c").over(Window.partitionBy(*gs))
    at = F.array(*[F.struct(F.lit(i).alias("_i"), F.least(t(F.col("_n")), F.col("_n")).cast("long").alias("_t"))
                   for i, t in enumerate(targets)])
    need = (narrow.groupBy(*gs, "_b").agg(F.count(F.lit(1)).alias("_c"))
            .select(*gs, "_b", "_c", before(*gs, order="_b").alias("_off"), n.alias("_n"))
            .select(*gs, "_b", "_c", "_off", F.inline(at)).where("_t > _off and _t <= _off + _c")
            .select(*[F.col(g).alias(f"_n{g}") for g in gs], F.col("_b").alias("_nb"), "_i",
                    (F.col("_t") - F.col("_off")).alias("_local")))
    if gs:
        need = stage_table(need, "hash-need")
    else:  # a row per target
        need = F.broadcast(df.sparkSession.createDataFrame(need.collect(), need.schema))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_n{g}")) for g in gs],
                  F.col("_b") == F.col("_nb"))
    rows = narrow.join(need, same).select(*gs, "_i", "_sub", "_local", "_h", "_key")
    spots = (rows.groupBy(*gs, "_i", "_sub").agg(F.count(F.lit(1)).alias("_c"), F.max("_local").alias("_t"))
             .select(*gs, "_i", "_sub", "_c", "_t", before(*gs, "_i", order="_sub").alias("_off"))
             .where("_t > _off and _t <= _off + _c")
             .select(*[F.col(g).alias(f"_s{g}") for g in gs], F.col("_i").alias("_si"), F.col("_sub").alias("_ss"),
                     (F.col("_t") - F.col("_off")).alias("_rest")))
    spot = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_s{g}")) for g in gs],
                  (F.col("_i") == F.col("_si")) & (F.col("_sub") == F.col("_ss")))
    w = Window.partitionBy(*gs, "_i", "_sub").orderBy("_h", "_key")
    found = rows.withColumn("_lr", F.row_number().over(w)).join(spots, spot).where("_lr = _rest")
    if gs:
        cuts = stage_table(found.groupBy(*gs).agg(
            *[F.max(F.when(F.col("_i") == i, F.struct("_h", "_key"))).alias(c) for i, c in enumerate(names)]),
            "hash-cuts")
        on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(a)) for g, a in zip(group_cols, gs)])
        df, points = df.join(cuts, on, "left"), [F.col(c) for c in names]
    else:
        key_type = df.schema[key].dataType
        row = {r["_i"]: r for r in found.select("_i", "_h", "_key").collect()}
        points = [F.struct(F.lit(row[i]["_h"]).alias("_h"), F.lit(row[i]["_key"]).cast(key_type).alias("_key"))
                  if i in row else None for i in range(len(targets))]
    own = F.struct(h.alias("_h"), F.col(key).alias("_key"))
    beyond = reduce(lambda a, b: a + b, [F.lit(1) if c is None else F.coalesce((own > c).cast("int"), F.lit(1))
                                         for c in points])
    return df.withColumn(out, beyond).drop(*gs, *names)


def _splits(cuts) -> list[float]:
    """Bucketizer splits from cut points: every cut ``c`` is followed by
    ``nextafter(c)``, so ``[c, nextafter(c))`` holds exactly the value ``c``."""
    import math
    pts = set()
    for c in cuts or []:
        if c is None or math.isnan(c) or math.isinf(c):
            continue
        pts.add(float(c))
        pts.add(math.nextafter(float(c), math.inf))
    return [-math.inf, *sorted(pts), math.inf]


def _bucket_by_cuts(df: DataFrame, col: str, group_cols: list[str], buckets: int,
                    bounded_groups: bool, out: str = "_vb", accuracy: int = 10000) -> DataFrame:
    """Add a range-bucket index of ``col``, monotone in ``col`` inside each
    group.  Cut points are approximate quantiles PER GROUP (one grouped
    aggregate, at most ``buckets-1`` per group) so groups on very different
    scales are cut evenly, and every cut value has a singleton bucket, so a
    value holding a third of the rows never needs sorting.  Without groups
    the lookup is Spark ML's ``Bucketizer`` (a JVM binary search); with groups
    the cut arrays are joined to the rows and searched there."""
    from pyspark.ml.feature import Bucketizer
    probs = [i / buckets for i in range(1, buckets)]
    pa = F.percentile_approx(F.col(col).cast("double"), probs, accuracy)
    per_bucket = 64  # sample rows per bucket: cut points only steer balance, never exactness
    if not group_cols:
        n = df.count()
        frac = min(1.0, per_bucket * buckets / max(n, 1))
        smp = df if frac >= 1.0 else df.where(F.rand(17) < F.lit(frac))
        cuts = smp.agg(pa.alias("c")).first()["c"]
        b = Bucketizer(splits=_splits(cuts), inputCol="_bin", outputCol="_bout", handleInvalid="keep")
        return b.transform(df.withColumn("_bin", F.col(col).cast("double"))) \
            .withColumn(out, F.col("_bout").cast("int")).drop("_bin", "_bout")
    return _bucket_by_search(df, col, group_cols, buckets, out, accuracy)


def _bucket_by_search(df: DataFrame, col: str, group_cols: list[str], buckets: int, out: str = "_vb", accuracy: int = 10000) -> DataFrame:
    """The per-group cut arrays are joined to the
    rows and searched with a ``log2(buckets)``-step binary search; index
    ``2·#(cuts <= v) − [v is a cut]`` keeps cut values in singleton buckets.
    Cuts are staged, so that the join knows that they are its small side (built
    of the rows, it searched them in one task a group), and so are the results:
    the search costs more than reading them back."""
    import math
    probs = [i / buckets for i in range(1, buckets)]
    pa = F.array_sort(F.array_distinct(F.percentile_approx(F.col(col), probs, accuracy)))
    cuts = stage_table(df.groupBy(*group_cols).agg(pa.alias("_cuts")), "cumsum-cuts")
    ren = cuts.select(*[F.col(g).alias(f"_cg_{g}") for g in group_cols], "_cuts")
    cond = None
    for g in group_cols:
        c = F.col(g).eqNullSafe(F.col(f"_cg_{g}"))
        cond = c if cond is None else cond & c
    d = df.join(ren, cond, "inner") \
        .drop(*[f"_cg_{g}" for g in group_cols])
    steps = max(1, int(math.ceil(math.log2(buckets + 1))) + 1)
    v = F.col(col).cast("double")
    init = F.struct(F.lit(0).alias("lo"), F.size("_cuts").alias("hi"))

    def step(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        le = F.try_element_at(F.col("_cuts"), mid + 1) <= v
        return F.when(acc["lo"] >= acc["hi"], acc).when(
            le, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(
            F.struct(acc["lo"].alias("lo"), mid.alias("hi")))

    le = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)["lo"]
    found = F.col("_le")
    on_cut = F.when((found > 0) & (F.try_element_at(F.col("_cuts"), F.greatest(found, F.lit(1))) == v), 1).otherwise(0)
    return stage_table(d.withColumn("_le", le).withColumn(out, (2 * found - on_cut).cast("int")).drop("_cuts", "_le"), "cumsum-buckets")


def bucketed_cumsum(df: DataFrame, order_col: str, sums: dict, group_cols: list[str] | None = None,
                    descending: bool = False, buckets: int = 1024, bounded_groups: bool = True) -> DataFrame:
    """Inclusive running sums over a single numeric key that is DISTINCT
    within each group (e.g. after grouping by score): rows are bucketed on
    cut points of the key, summed inside (group, bucket) windows and offset
    by the sums of the preceding buckets."""
    group_cols = list(group_cols or [])
    df = stage_table(df, "cumsum-input")  # several passes follow
    key = F.col(order_col).cast("double")
    d = df.withColumn("_k", -key if descending else key)
    bk = _bucket_by_cuts(d, "_k", group_cols, buckets, bounded_groups)
    tot = bk.groupBy(*group_cols, "_vb").agg(*[F.sum(v).alias(f"_t_{o}") for o, v in sums.items()])
    w_prev = Window.partitionBy(*group_cols).orderBy("_vb").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*[F.col(g).alias(f"_g_{g}") for g in group_cols], F.col("_vb").alias("_ob"),
                      *[F.coalesce(F.sum(f"_t_{o}").over(w_prev), F.lit(0)).alias(f"_o_{o}") for o in sums])
    cond = F.col("_vb") == F.col("_ob")
    for g in group_cols:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    w = Window.partitionBy(*group_cols, "_vb").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    local = bk.select("*", *[F.sum(v).over(w).alias(f"_l_{o}") for o, v in sums.items()])
    j = local.join(offs, cond, "inner")
    out = j.select(*df.columns, *[(F.col(f"_l_{o}") + F.col(f"_o_{o}")).alias(o) for o in sums])
    return out
