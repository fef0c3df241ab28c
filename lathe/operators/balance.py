"""Class rebalancing.

k-NN is exact, blocked and pruned.  Rows are ordered by their nearest pivot (of
a bounded sample) and their distance to it, and cut into blocks of
``block_rows``.  A search in each block and the two beside it gives every row a
first k-th distance.
By the triangle inequality two rows are at least as far apart as their
distances to any pivot differ, so a block pair whose pivot intervals lie
further apart than both blocks' largest k-th distance is skipped; in the pairs
that are left, rows whose own k-th distance rules the other block out are
skipped too.  No task holds more than three blocks, and a final top-k over the
survivors gives the exact neighbours (ties by neighbour id).
Synthetic draws (base row, neighbour, gap) are hash-derived, hence
reproducible and checkable in SQL.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lathe.functions.hashing import DEFAULT_SEED, hash_int, hash_unit
from lathe.operators.ordering import cut_by_hash, global_row_number, hash_rank_within
from lathe.session import stage_table

_KNN_SCHEMA = "q_id long, nn_id long, dist2 double"


CHUNK_CELLS = 4_000_000  # doubles in a block of coordinate differences (32 MB)
SCREEN_CELLS = 1_000_000  # distances that one matrix product gives (8 MB)


def _distances(qx: np.ndarray, cx: np.ndarray) -> np.ndarray:
    """Squared distances, by as many rows at a time as the chunk bound allows."""
    d = np.empty((len(qx), len(cx)))
    step = max(1, CHUNK_CELLS // max(1, cx.size))
    for lo in range(0, len(qx), step):
        diff = qx[lo:lo + step, None, :] - cx[None, :, :]
        d[lo:lo + step] = np.square(diff, out=diff).sum(axis=2)
    return d


PIVOTS = 32           # pivots of the k-NN, from a sample of 1,024 rows
BLOCKS = 32           # blocks a table is cut into, if they have more than the rows asked for
BLOCK_ROWS = 16_384   # rows of such a block at most
_CHUNK = 256          # blocks whose pivot intervals are compared in one task


def _pivots(base: DataFrame) -> np.ndarray:
    """Rows far from each other among the 1,024 of smallest hash: they only
    steer which pairs can be skipped."""
    drawn = base.orderBy(hash_int("_id", modulus=2**31, seed="pivot"), "_id").limit(1024).select("_v").collect()
    x = np.array([r["_v"] for r in drawn], np.float64)
    chosen = [0]
    away = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(x)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    chain, left = [chosen.pop(0)], chosen  # near pivots get near numbers, and blocks follow these
    while left:
        chain.append(min(left, key=lambda i: ((x[i] - x[chain[-1]]) ** 2).sum()))
        left.remove(chain[-1])
    return x[chain]


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(_distances(x, pivots))


def _matrix(part: pd.DataFrame, column: str) -> np.ndarray:
    return np.stack(part[column].to_numpy()).astype(np.float64)


def _nearest(q: pd.DataFrame, c: pd.DataFrame, k: int, penalty: float, tau: np.ndarray | None = None):
    """Per row of ``q`` the k best (distance, id) among the rows of ``c``, of which
    those beyond ``tau`` may be left out: ids, neighbours' ids, distances.  A matrix
    product gives every distance up to its rounding; coordinates are subtracted
    only for the pairs that this leaves among the k best."""
    qx, cx, qid, cid = _matrix(q, "_v"), _matrix(c, "_v"), q["_id"].to_numpy(), c["_id"].to_numpy()
    qc, cc = (np.stack(x["_cat"].to_numpy()) if "_cat" in x.columns else np.empty((len(x), 0)) for x in (q, c))
    kk, cats, dims = min(k, len(c)), range(qc.shape[1]), qx.shape[1]
    limit = np.full(len(q), np.inf) if tau is None else tau
    rounding = 1e-15 * (dims + len(cats) + 8)
    out = []
    step, some = max(1, SCREEN_CELLS // len(c)), max(1, CHUNK_CELLS // max(1, dims))
    with np.errstate(over="ignore", invalid="ignore"):
        q2, c2 = np.square(qx).sum(axis=1), np.square(cx).sum(axis=1)
        for lo in range(0, len(q), step):
            part = slice(lo, lo + step)
            slack = q2[part, None] + c2[None, :]
            d = slack - 2 * (qx[part] @ cx.T)
            for x in cats:
                d += penalty * (qc[part, None, x] != cc[None, :, x])
            slack = rounding * (slack + abs(penalty) * len(cats))
            own = qid[part, None] == cid[None, :]  # never your own neighbour
            kth = np.partition(np.where(own, np.inf, d + slack), kk - 1, axis=1)[:, kk - 1]
            # a distance that is not a number here may still be one when subtracted
            i, j = np.nonzero(~(d - slack > np.minimum(limit[part], kth)[:, None]) & ~own)
            i += lo
            exact = np.empty(len(i))
            for at in range(0, len(i), some):
                a, b = i[at:at + some], j[at:at + some]
                diff = qx[a] - cx[b]
                exact[at:at + some] = np.square(diff, out=diff).sum(axis=1)
                for x in cats:
                    exact[at:at + some] += penalty * (qc[a, x] != cc[b, x])
            order = np.lexsort((cid[j], exact, i))
            order = order[np.isfinite(exact[order])]
            i, j, exact = i[order], j[order], exact[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < kk
            out.append((qid[i[best]].astype("int64"), cid[j[best]].astype("int64"), exact[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _found(parts) -> pd.DataFrame:
    q, c, d = (np.concatenate(x) for x in zip(*parts)) if parts else ([], [], [])
    return pd.DataFrame({"q_id": np.asarray(q, "int64"), "nn_id": np.asarray(c, "int64"), "dist2": np.asarray(d, "float64")})


def _own_block(k: int, penalty: float):
    """The k best among its own block and the two beside it for each row of a block."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        mine = rows[rows["_b"] == rows["_home"]]
        if not len(mine):
            return _found([])
        return _found([_nearest(mine, rows, k, penalty)])
    return run


def _two_blocks(k: int, penalty: float):
    """The k best candidates across a block pair for the rows that can have any:
    those whose k-th distance so far reaches the other block."""
    def reach(mine: pd.DataFrame, other: pd.DataFrame) -> np.ndarray:
        a, b = _matrix(mine, "_pd"), _matrix(other, "_pd")
        gap = np.maximum(a - b.max(axis=0), b.min(axis=0) - a).max(axis=1)
        bound = np.maximum(gap - 1e-9 * (a.max() + b.max()), 0) ** 2
        return bound <= mine["_tau"].to_numpy()

    def run(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return _found([])
        parts = []
        for mine, other in ((q, c), (c, q)):
            mine = mine[reach(mine, other)]
            if len(mine):
                parts.append(_nearest(mine, other, k, penalty, mine["_tau"].to_numpy()))
        return _found(parts)
    return run


def _close_pairs(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """The block pairs of two chunks whose intervals do not rule each other out."""
    none = pd.DataFrame({"a": np.zeros(0, "int64"), "b": np.zeros(0, "int64")})
    if a.empty or b.empty:
        return none
    alo, ahi, blo, bhi = _matrix(a, "lo"), _matrix(a, "hi"), _matrix(b, "lo"), _matrix(b, "hi")
    out = []
    for i in range(len(a)):
        gap = np.maximum(alo[i] - bhi, blo - ahi[i]).max(axis=1)
        bound = np.maximum(gap - 1e-9 * (ahi[i].max() + bhi.max(axis=1)), 0) ** 2
        near = (bound <= np.maximum(a["tau"].iloc[i], b["tau"].to_numpy())) & (a["_b"].iloc[i] + 1 < b["_b"].to_numpy())
        out.append(pd.DataFrame({"a": np.full(near.sum(), a["_b"].iloc[i], "int64"), "b": b["_b"].to_numpy()[near].astype("int64")}))
    return pd.concat(out) if out else none


def knn(df: DataFrame, id_col: str, vec_col: str, k: int = 5, cat_col: str | None = None,
        penalty: float = 0.0, block_rows: int = 2048, report: dict | None = None) -> DataFrame:
    """Exact k nearest neighbours (squared Euclidean, plus ``penalty`` per
    categorical mismatch) of every row among the other rows of ``df``: (id,
    nn_rank, nn_id, dist2).  A block has ``block_rows`` rows, of a large table
    more: the block pairs, and the copies of a row for them, grow with the square
    of the blocks.  ``report`` receives "pairs" and "compared", the numbers of
    block pairs and of those that were not skipped."""
    cols = [F.col(id_col).cast("long").alias("_id"), F.col(vec_col).cast("array<double>").alias("_v")]
    if cat_col:
        cols.append(F.col(cat_col).alias("_cat"))
    base = stage_table(df.select(*cols), "knn-rows")
    n = base.count()
    block_rows = max(block_rows, min(BLOCK_ROWS, n // BLOCKS))
    blocks = max(1, math.ceil(n / block_rows))
    if blocks == 1:
        one = base.select("*", *[F.lit(0).cast("long").alias(c) for c in ("_b", "_home")])
        found = one.groupBy("_home").applyInPandas(_own_block(k, penalty), _KNN_SCHEMA)
    else:
        found = _pruned(base, k, penalty, block_rows, blocks, report)
    w = Window.partitionBy("q_id").orderBy("dist2", "nn_id")  # at most k rows of each block compared
    best = found.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    return best.select(F.col("q_id").alias(id_col), F.col("nn_rank").cast("int"),
                       "nn_id", "dist2")


def _pruned(base: DataFrame, k: int, penalty: float, block_rows: int, blocks: int, report: dict | None) -> DataFrame:
    pivots = _pivots(base)
    p = len(pivots)

    @F.pandas_udf("array<double>")
    def to_pivots(v: pd.Series) -> pd.Series:
        return pd.Series(list(_to_pivots(np.stack(v.to_numpy()).astype(np.float64), pivots)))
    placed = base.withColumn("_pd", to_pivots("_v")).withColumn("_near", F.array_min("_pd"))
    placed = placed.withColumn("_cell", F.array_position("_pd", F.col("_near")))
    ranked = global_row_number(placed, ["_cell", "_near", "_id"], col="_rn")
    rows = stage_table(ranked.withColumn("_b", F.expr(f"(_rn - 1) div {block_rows}")).drop("_rn", "_near", "_cell"), "knn-blocks")
    beside = rows.withColumn("_home", F.explode(F.sequence(F.greatest(F.col("_b") - 1, F.lit(0)),
                                                           F.least(F.col("_b") + 1, F.lit(blocks - 1)))))
    own = stage_table(beside.groupBy("_home").applyInPandas(_own_block(k, penalty), _KNN_SCHEMA), "knn-own")
    # the k-th distance so far; fewer candidates rule nothing out
    tau = own.groupBy(F.col("q_id").alias("_id")).agg(F.array_sort(F.collect_list("dist2")).alias("_d")).select(
        "_id", F.coalesce(F.try_element_at("_d", F.lit(k)), F.lit(float("inf"))).alias("_tau"))
    reached = stage_table(rows.join(tau, "_id", "left").withColumn("_tau", F.coalesce("_tau", F.lit(float("inf")))), "knn-reach")
    stats = reached.groupBy("_b").agg(
        F.array(*[F.min(F.col("_pd")[i]) for i in range(p)]).alias("lo"),
        F.array(*[F.max(F.col("_pd")[i]) for i in range(p)]).alias("hi"), F.max("_tau").alias("tau"))
    stats = stage_table(stats.withColumn("_chunk", F.expr(f"_b div {_CHUNK}")), "knn-intervals")
    chunks = -(-blocks // _CHUNK)
    left = stats.withColumn("_other", F.explode(F.sequence(F.col("_chunk"), F.lit(chunks - 1)))) \
        .select(F.col("_chunk").alias("_ca"), F.col("_other").alias("_cb"), "_b", "lo", "hi", "tau")
    right = stats.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunk")))) \
        .select(F.col("_other").alias("_ca"), F.col("_chunk").alias("_cb"), *[F.col(c).alias(c) for c in ("_b", "lo", "hi", "tau")])
    pairs = stage_table(left.groupBy("_ca", "_cb").cogroup(right.groupBy("_ca", "_cb"))
                        .applyInPandas(_close_pairs, "a long, b long"), "knn-pairs")
    if report is not None:
        report.update(pairs=blocks * (blocks - 1) // 2, compared=pairs.count() + blocks - 1)
    data = [c for c in reached.columns if c != "_b"]
    q = reached.join(pairs, F.col("_b") == F.col("a")).select("a", "b", *data)
    c = reached.join(pairs, F.col("_b") == F.col("b")).select(*[F.col(x).alias(x) for x in ("a", "b", *data)])
    across = (q.groupBy("a", "b").cogroup(c.groupBy("a", "b")).applyInPandas(_two_blocks(k, penalty), _KNN_SCHEMA))
    return own.unionByName(across)


def class_counts(df: DataFrame, is_minority) -> tuple[int, int]:
    r = df.agg(F.count_if(is_minority).alias("mn"),
               F.count_if(~is_minority).alias("mj")).first()
    return int(r["mn"]), int(r["mj"])


def random_undersample(df: DataFrame, key: str, is_minority, ratio: float = 0.75,
                       seed=DEFAULT_SEED) -> DataFrame:
    """Keep every minority row; keep ``floor(n_min / ratio)`` majority rows,
    the smallest ``md5(key|seed)`` first (exact count)."""
    n_min, n_maj = class_counts(df, is_minority)
    n_keep = min(n_maj, int(n_min / ratio))
    d = df.withColumn("_maj", (~is_minority).cast("int"))
    cut = cut_by_hash(d, ["_maj"], key, [lambda n: F.least(n, F.lit(n_keep))], seed=seed)
    return cut.where((F.col("_maj") == 0) | (F.col("_part") == 0)).drop("_maj", "_part")


def smote(df: DataFrame, id_col: str, vec_col: str, is_minority, ratio: float = 0.5, k: int = 5,
          seed=DEFAULT_SEED, neighbours: DataFrame | None = None, cat_col: str | None = None,
          penalty: float = 0.0) -> DataFrame:
    """Synthetic minority rows until minority = ``ratio``·majority:
    ``x + u·(neighbour − x)``.  Sample ``i`` (0-based) uses the base row of
    hash-rank ``i mod n_min``, its ``(h(i,'nn') mod k)+1``-th neighbour and
    gap ``u = h(i,'gap')`` in [0,1).  Each base row expands to its own
    samples (no driver-side range).  With ``cat_col`` the synthetic
    categories are the mode over the base row's k neighbours (ties: the
    smallest value).  Returns ``(synth_id, base_id, nn_id, gap, vec[, cat])``."""
    n_min, n_maj = class_counts(df, is_minority)
    n_synth = max(int(ratio * n_maj) - n_min, 0)
    spark = df.sparkSession
    schema = f"synth_id long, base_id long, nn_id long, gap double, {vec_col} array<double>"
    if cat_col:
        schema += f", {cat_col} {df.schema[cat_col].dataType.simpleString()}"
    if n_synth == 0 or n_min < 2:
        return spark.createDataFrame([], schema)
    kk = min(k, n_min - 1)
    mino = df.where(is_minority)
    nn = neighbours if neighbours is not None else knn(
        mino, id_col, vec_col, k=kk, cat_col=cat_col, penalty=penalty)
    base = mino.select(F.col(id_col).cast("long").alias("base_id"),
                       F.col(vec_col).alias("_x"), *([F.col(cat_col).alias("_xc")] if cat_col else []))
    ranked = hash_rank_within(base, [], "base_id", seed=seed, rank_col="_r", count_col=None,
                              bounded_groups=True)
    per, extra = divmod(n_synth, n_min)
    cnt = F.lit(per) + (F.col("_r") <= extra).cast("int")
    ex = ranked.where(cnt > 0).select("*", F.explode(F.sequence(F.lit(1), cnt)).alias("_j"))
    ex = ex.withColumn("synth_id", ((F.col("_j") - 1) * n_min + F.col("_r") - 1).cast("long"))
    ex = ex.withColumn("nn_rank", (hash_int("synth_id", modulus=kk, seed=seed, salt="nn") + 1).cast("int")) \
           .withColumn("gap", hash_unit("synth_id", seed=seed, salt="gap"))
    nbr = nn.select(F.col(id_col).alias("base_id"), "nn_rank", "nn_id")
    feats = mino.select(F.col(id_col).cast("long").alias("nn_id"), F.col(vec_col).alias("_nb"))
    j = ex.join(nbr, ["base_id", "nn_rank"]).join(feats, "nn_id")
    vec = F.zip_with("_x", "_nb", lambda a, b: a.cast("double") + F.col("gap") * (b.cast("double") - a.cast("double")))
    out = j.select("synth_id", "base_id", "nn_id", "gap", vec.alias(vec_col),
                   *(["_xc"] if cat_col else []))
    if cat_col:
        # per base row, the categorical mode over its k neighbours
        cats = nn.select(F.col(id_col).alias("base_id"), "nn_id").join(
            mino.select(F.col(id_col).cast("long").alias("nn_id"), F.col(cat_col).alias("_c")), "nn_id")
        pos = cats.select("base_id", F.posexplode("_c").alias("_p", "_v"))
        # deterministic tie rule: the smallest value among the most frequent
        w = Window.partitionBy("base_id", "_p").orderBy(F.desc("_n"), F.asc("_v"))
        mode = (pos.groupBy("base_id", "_p", "_v").agg(F.count(F.lit(1)).alias("_n"))
                .withColumn("_o", F.row_number().over(w)).where("_o = 1")
                .groupBy("base_id").agg(F.array_sort(F.collect_list(F.struct("_p", "_v"))).alias("_s")))
        out = out.join(mode.select("base_id", F.transform("_s", lambda s: s["_v"]).alias(cat_col)),
                       "base_id").drop("_xc")
    return out


def rebalance(df: DataFrame, id_col: str, vec_col: str, label_col: str, minority_value,
              smote_ratio: float = 0.5, under_ratio: float = 0.75, k: int = 5,
              seed=DEFAULT_SEED, cat_col: str | None = None, penalty: float = 0.0) -> DataFrame:
    """SMOTE (SMOTENC with ``cat_col``) up to ``smote_ratio``, then undersample
    the majority to ``under_ratio``; synthetic rows get negative ids
    ``-(synth_id+1)`` and NULL in any other column of ``df``."""
    is_min = F.col(label_col) == F.lit(minority_value)
    syn = smote(df, id_col, vec_col, is_min, ratio=smote_ratio, k=k, seed=seed, cat_col=cat_col, penalty=penalty)
    own = [vec_col, *([cat_col] if cat_col else [])]
    made = stage_table(syn.select(
        (-(F.col("synth_id") + 1)).cast(df.schema[id_col].dataType).alias(id_col),
        *[F.col(c).cast(df.schema[c].dataType).alias(c) for c in own],
        F.lit(minority_value).cast(df.schema[label_col].dataType).alias(label_col)), "synthetic-rows")
    grown = df.unionByName(made, allowMissingColumns=True)
    return random_undersample(grown, id_col, F.col(label_col) == F.lit(minority_value),
                              ratio=under_ratio, seed=seed)
