"""Operator 7: approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced
parts: median splits along principal directions give equal parts, and rounds of
moves towards the part that holds most of a vector's neighbours, within a size
limit, reduce the cut.  A small network learns to tell a vector's part.  Every
row is indexed in its most probable part; a query visits the most probable
parts that together reach ``MASS`` of its probability (``LEAST_PROBES`` at
least) and is ranked there exactly.  Parts are searched in blocks of rows
against blocks of queries, so a part of any size is shared among tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.llm.common import stage_table, table

TOP = 20
SAMPLE_ROWS = 6_000   # vectors that the partition and the classifier are fitted on, at most
ROWS_PER_PART = 64    # of the sample, at least: bounds the number of parts
NEIGHBOURS = 10
MASS = 0.995
LEAST_PROBES = 6
BLOCK = 4096          # rows of a part searched at once
QUERIES = 512         # queries searched at once


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k nearest others by inner product, blockwise."""
    out = np.zeros((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        score = x[a:a + 1024] @ x.T
        score[np.arange(len(score)), np.arange(a, a + len(score))] = -np.inf
        out[a:a + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Part of each row: a balanced partition of the neighbour graph."""
    groups = [np.arange(len(x))]
    while len(groups) < parts:  # split the largest at the median of its main direction
        groups.sort(key=len)
        own = groups.pop()
        centred = x[own] - x[own].mean(axis=0)
        _, vectors = np.linalg.eigh(centred.T @ centred)
        order = own[np.argsort(centred @ vectors[:, -1], kind="stable")]
        groups += [order[:len(order) // 2], order[len(order) // 2:]]
    part = np.zeros(len(x), np.int64)
    for p, own in enumerate(groups):
        part[own] = p
    limit = math.ceil(slack * len(x) / parts)
    for _ in range(rounds):
        near = np.zeros((len(x), parts), np.int32)
        np.add.at(near, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(near, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = near.argmax(axis=1)
        gain = near[np.arange(len(x)), best] - near[np.arange(len(x)), part]
        size = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < limit:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A network of one hidden layer that gives each part's probability."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 96, epochs: int = 40, seed: int = 9):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.scale = 1.0 / max(1e-12, float(np.sqrt((x * x).mean())))
        d, p = x.shape[1], target.shape[1]
        self.w = [rng.normal(0, d ** -0.5, (d, hidden)), np.zeros(hidden),
                  rng.normal(0, hidden ** -0.5, (hidden, p)), np.zeros(p)]
        first, second = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        step = 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
                step += 1
                for k, g in enumerate(self._gradient(x[at], target[at])):
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    rate = 0.003 * 0.5 * (1 + math.cos(math.pi * epoch / epochs))
                    self.w[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                                  / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8))

    def _forward(self, x):
        hidden = np.maximum(x * self.scale @ self.w[0] + self.w[1], 0)
        logits = hidden @ self.w[2] + self.w[3]
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        return hidden, e / e.sum(axis=1, keepdims=True)

    def _gradient(self, x, target):
        hidden, p = self._forward(x)
        d = (p - target) / len(x)
        back = (d @ self.w[2].T) * (hidden > 0)
        return (x * self.scale).T @ back, back.sum(axis=0), hidden.T @ d, d.sum(axis=0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]


def fit_router(vectors: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS, seed: int = 8) -> Router | None:
    """Fit on the ``sample_rows`` vectors first in a seeded hash order."""
    rows = (vectors.select("id", "v").orderBy(F.xxhash64(F.lit(seed), "id", "v"), "id").limit(sample_rows).collect())
    if not rows:
        return None
    x = np.array([r["v"] for r in rows], np.float64)
    parts = max(1, min(len(x) // ROWS_PER_PART, math.ceil(math.sqrt(n) / 8)))
    if parts == 1:
        return Router(x, np.ones((len(x), 1)), epochs=0)
    graph = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1))
    part = balanced_parts(x, graph, parts)
    target = 0.5 * np.eye(parts)[part]
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    return Router(x, target)


def _matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _route(router: Router, mass: float, probes: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order_p = router.probabilities(_matrix(batch.column(1)))
            order = np.argsort(-order_p, axis=1, kind="stable")
            ranked = np.take_along_axis(order_p, order, axis=1)
            visit = (np.cumsum(ranked, axis=1) - ranked < mass) | (np.arange(order.shape[1]) < probes)
            lists = [order[i, visit[i]].tolist() for i in range(len(order))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(order[:, 0], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                names=["id", "v", "part", "visits"])
    return run


def _best(q_id, q, v_id, v, top):
    """(query row, id, score) of each query's nearest rows of one block; equal
    vectors are scored once and stand for their smallest ids."""
    order = np.lexsort((v_id,))
    v_id, v = v_id[order], v[order]
    distinct, group = np.unique(v, axis=0, return_inverse=True)
    group = group.ravel()
    by = np.argsort(group, kind="stable")
    begin = np.searchsorted(group[by], np.arange(len(distinct)))
    nth = np.arange(len(by)) - begin[group[by]]
    members = by[nth <= top]  # one more than asked for: the query itself may be among them
    m_begin = np.searchsorted(group[members], np.arange(len(distinct) + 1))
    rough = q @ distinct.T
    out_q, out_id, out_s = [], [], []
    for i in range(len(q)):
        # equal vectors count once here, so take enough groups for the query's own
        k = min(top + 1, len(distinct))
        least = np.partition(rough[i], len(distinct) - k)[len(distinct) - k]
        near = np.flatnonzero(rough[i] >= least - 1e-9 * (1 + abs(least)))
        score = np.cumsum(distinct[near] * q[i], axis=1)[:, -1]
        at = np.concatenate([members[m_begin[g]:m_begin[g + 1]] for g in near])
        s = np.repeat(score, m_begin[near + 1] - m_begin[near])
        ids = v_id[at]
        mask = ids != q_id[i]
        ids, s = ids[mask], s[mask]
        best = np.lexsort((ids, -s))[:top]
        out_q.append(np.full(len(best), i))
        out_id.append(ids[best])
        out_s.append(s[best])
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_s)


def _search(top: int):
    def run(batches):
        key, parts = None, ([], [], [], [])

        def settle():
            q_id, q, v_id, v = parts
            if not q_id or not v_id:
                return None
            ids = np.concatenate(q_id)
            rows, found, score = _best(ids, np.concatenate(q), np.concatenate(v_id), np.concatenate(v), top)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])
        for batch in batches:
            if not batch.num_rows:
                continue
            part, vb, qb, is_q = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            ids, x = batch.column(4).to_numpy(), _matrix(batch.column(5))
            edge = np.flatnonzero((np.diff(part) != 0) | (np.diff(vb) != 0) | (np.diff(qb) != 0)) + 1
            for a, b in zip(np.concatenate([[0], edge]), np.concatenate([edge, [len(ids)]])):
                here = (part[a], vb[a], qb[a])
                if here != key:
                    got = settle()
                    if got is not None:
                        yield got
                    key, parts = here, ([], [], [], [])
                own = is_q[a:b].astype(bool)
                parts[0].append(ids[a:b][own])
                parts[1].append(x[a:b][own])
                parts[2].append(ids[a:b][~own])
                parts[3].append(x[a:b][~own])
        got = settle()
        if got is not None:
            yield got
    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part."""
    unfit = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~unfit)
            .where(F.exists("v", lambda x: x != 0)))


def nearest(vectors: DataFrame, query_of, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP,
            mass: float = MASS, probes: int = LEAST_PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for every row
    that ``query_of(id column)`` selects, by inner product in double precision.

    Vectors null, zero, or holding null or non-finite components, and rows with
    a null id, take no part; nor do vectors whose length isn't the commonest.
    Rows repeated whole count once; ties go to the smaller id; an id is never
    its own neighbour; a query with fewer candidates gets them all; an empty
    table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col).distinct()
    lengths = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "size").first()
    out = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], out)
    rows = stage_table(rows.where(F.size("v") == common["size"]), "ann-rows")
    router = fit_router(rows, common["n"])
    item = rows.schema["v"].dataType.simpleString()
    indexed = stage_table(rows.mapInArrow(_route(router, mass, probes),
                                          f"id long, v {item}, part long, visits array<long>"), "ann-index")
    is_query = query_of(F.col("id"))
    # one row per part: bounded by the sample
    visited = indexed.where(is_query).select(F.explode("visits").alias("part")).groupBy("part").agg(F.count("*").alias("q"))
    held = indexed.groupBy("part").agg(F.count("*").alias("n"))
    blocks = F.broadcast(held.join(visited, "part").select(
        "part", F.ceil(F.col("n") / BLOCK).cast("int").alias("vbs"), F.ceil(F.col("q") / QUERIES).cast("int").alias("qbs")))
    salt = F.xxhash64(F.lit(1), "id")
    stored = (indexed.join(blocks, "part").withColumn("vb", F.pmod(salt, F.col("vbs")).cast("int"))
              .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1))))
    asked = (indexed.where(is_query).select("id", "v", F.explode("visits").alias("part")).join(blocks, "part")
             .withColumn("qb", F.pmod(salt, F.col("qbs")).cast("int"))
             .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("vbs") - 1))))
    pick = lambda df, q: df.select("part", "vb", "qb", F.lit(q).alias("is_q"), "id", "v")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    met = (pick(stored, 0).unionByName(pick(asked, 1)).repartition(tasks, "part", "vb", "qb")
           .sortWithinPartitions("part", "vb", "qb")
           .mapInArrow(_search(top), "query_id long, vec_id long, score double"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)
