"""Operator 4: documents whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more, with Bayesian pruning of candidates.

1. Documents with equal shingle sets form one class; only classes go on.
2. MinHash values in bands propose neighbours: ``BANDS`` bands of ``ROWS``
   values miss a pair at similarity 0.8 with probability (1 - 0.8**6)**50,
   about 2.5e-7, and less above.  Classes linked by buckets (each member to its
   bucket's least id, never all pairs) form clusters, so every candidate pair
   lies in one cluster and meets once.
3. A cluster is dealt into blocks of ``BLOCK`` classes, and block pairs are
   compared in tasks: MinHash values step by step over the pairs of two blocks;
   a pair goes when, with a uniform prior, the posterior probability that its
   similarity reaches the threshold falls below ``TOLERANCE``; the pairs that
   are left are verified exactly on their shingles.  A task returns link counts
   per class and a spanning forest, so no list of pairs is ever written.
4. Components of the forests are the groups.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import buffers, components, gram_hashes, mix64, signed, stage_table, table, word_hashes

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 50, 6
TOLERANCE = 1e-9
STEP = 20            # MinHash values compared between two prunings
BLOCK = 256          # classes per block
SLICE = 256          # rows of a batch worked on at once
VOCABULARY = 16_384  # shingles verified at once, which bounds a task's matrices


@lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(44))
    n = BANDS * ROWS
    return (rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 2**32, n, dtype=np.uint32))


def shingles(buf: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle fingerprints of a text; a text of fewer words
    than a shingle is one shingle of its own."""
    _, _, w = word_hashes(buf)
    if 0 < len(w) < words:
        return gram_hashes(w, len(w)) ^ np.uint64(len(w))
    return np.unique(gram_hashes(w, words))


def minhashes(sh: np.ndarray) -> np.ndarray:
    a, b = _multipliers()
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    folded = (mix64(sh) >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(folded), 512):
        part = folded[k:k + 512]
        np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=out)
    return out


def least_matches(threshold: float, tolerance: float, step: int, total: int) -> dict[int, int]:
    """For n compared values, the least number of matches with which the
    posterior probability (uniform prior) of reaching the threshold is at least
    the tolerance: P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    out = {}
    for n in range(step, total + 1, step):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def _small(batches):
    """The rows of the batches, few at a time: what a task holds beside its own
    input does not grow with Spark's batch size."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


def _signatures(batches):
    for batch in _small(batches):
        k1, k2, size, bands = [], [], [], []
        for buf in buffers(batch.column(2)):
            sh = shingles(buf)
            digest = hashlib.blake2b(sh.tobytes(), digest_size=16).digest()
            k1.append(int.from_bytes(digest[:8], "little", signed=True))
            k2.append(int.from_bytes(digest[8:], "little", signed=True))
            size.append(len(sh))
            if len(sh):
                values = minhashes(sh).reshape(BANDS, ROWS).astype(np.uint64)
                key = np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + values[:, r])
                bands.append(signed(key))
            else:
                bands.append(np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
             pa.array(size, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
            names=["id", "th", "k1", "k2", "size", "bands"])


def _sets(batches):
    for batch in _small(batches):
        sh = [shingles(buf) for buf in buffers(batch.column("t"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("uid", "cluster", "n")]
            + [pa.array([s.tobytes() for s in sh], pa.binary()),
               pa.array([minhashes(s).tobytes() for s in sh], pa.binary())],
            names=["uid", "cluster", "n", "sh", "sig"])


def _similar(a: list, b: list, sig_a: np.ndarray, sig_b: np.ndarray, needed: dict[int, int]) -> np.ndarray:
    """Boolean matrix of the pairs whose exact similarity reaches the threshold."""
    alive = np.ones((len(a), len(b)), bool)
    matches = np.zeros((len(a), len(b)), np.int16)
    done = 0
    for n, least in needed.items():
        if alive.size <= 4096:
            matches += (sig_a[:, None, done:n] == sig_b[None, :, done:n]).sum(axis=2, dtype=np.int16)
        elif alive.mean() > 0.05:
            for k in range(done, n):
                matches += sig_a[:, k, None] == sig_b[None, :, k]
        else:  # few pairs are left: compare these alone
            i, j = np.nonzero(alive)
            if not len(i):
                return alive
            matches[i, j] += (sig_a[i, done:n] == sig_b[j, done:n]).sum(axis=1, dtype=np.int16)
        alive &= matches >= least
        done = n
    size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    if not len(rows):
        return alive
    shared = np.zeros((len(a), len(b)), np.int64)
    if len(rows) * len(cols) > 64 and alive.sum() > 0.05 * len(rows) * len(cols):
        vocabulary, code = np.unique(np.concatenate([a[i] for i in rows] + [b[j] for j in cols]), return_inverse=True)
        split = np.cumsum([size_a[i] for i in rows] + [size_b[j] for j in cols])[:-1]
        code = np.split(code, split)
        for lo in range(0, len(vocabulary), VOCABULARY):
            hi = min(lo + VOCABULARY, len(vocabulary))
            left = np.zeros((len(rows), hi - lo), np.float32)
            right = np.zeros((len(cols), hi - lo), np.float32)
            for matrix, codes in ((left, code[:len(rows)]), (right, code[len(rows):])):
                for k, c in enumerate(codes):
                    c = c[np.searchsorted(c, lo):np.searchsorted(c, hi)]
                    matrix[k, c - lo] = 1
            shared[np.ix_(rows, cols)] += (left @ right.T).astype(np.int64)
    else:
        for i, j in zip(*np.nonzero(alive)):
            shared[i, j] = len(np.intersect1d(a[i], b[j], assume_unique=True))
    union = size_a[:, None] + size_b[None, :] - shared
    return alive & (shared * 100 >= round(THRESHOLD * 100) * union)


def _forest(pairs, n: int) -> list[tuple[int, int]]:
    """Edges that keep the components of the given pairs."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    out = []
    for i, j in pairs:
        ri, rj = root(i), root(j)
        if ri != rj:
            parent[max(ri, rj)] = min(ri, rj)
            out.append((i, j))
    return out


def _spanning(found: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a bipartite match matrix: from each row to its
    first match, and from each column to the first row that has it."""
    n, m = found.shape
    reps: dict[bytes, int] = {}
    pairs = []
    for i in range(n):
        row = found[i]
        if not row.any():
            continue
        key = row.tobytes()
        cols = [int(np.argmax(row))] if key in reps else [int(c) for c in np.flatnonzero(row)]
        reps.setdefault(key, i)
        pairs += [(i, n + c) for c in cols]
    return _forest(pairs, n + m)


def _compare(batches):
    needed = least_matches(THRESHOLD, TOLERANCE, STEP, BANDS * ROWS)
    key, held = None, []

    def settle():
        p, q = key[1], key[2]
        rows = list({r[0]: r for r in held}.values())  # rows repeated whole are one class
        if len(rows) < 2:
            return []
        uid = np.array([r[0] for r in rows])
        mine = np.array([r[1] for r in rows])
        weight = np.array([r[2] for r in rows])
        sh = [np.frombuffer(r[3], np.uint64) for r in rows]
        sig = np.stack([np.frombuffer(r[4], np.uint32) for r in rows])
        a = np.flatnonzero(mine == p)
        b = a if p == q else np.flatnonzero(mine == q)
        if not len(a) or not len(b):
            return []
        found = _similar([sh[i] for i in a], [sh[i] for i in b], sig[a], sig[b], needed)
        if p == q:
            np.fill_diagonal(found, False)
        links = np.zeros(len(rows), np.int64)
        links[a] = found @ weight[b]
        if p != q:
            links[b] = found.T @ weight[a]
        order = np.concatenate([a, b])
        edges = [(order[i], order[j]) for i, j in _spanning(found)]
        found = [(int(uid[i]), None, int(links[i])) for i in np.flatnonzero(links)]
        return found + [(int(uid[i]), int(uid[j]), 0) for i, j in edges]

    out = []
    for batch in _small(batches):
        columns = [batch.column(c).to_pylist() for c in ("cluster", "p", "q", "uid", "mine", "n", "sh", "sig")]
        for cluster, p, q, *row in zip(*columns):
            if (cluster, p, q) != key:
                if held:
                    out += settle()
                key, held = (cluster, p, q), []
                if len(out) > 50_000:
                    yield _link_rows(out)
                    out = []
            held.append(row)
    if held:
        out += settle()
    if out:
        yield _link_rows(out)


def _link_rows(out):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in out], pa.int64()) for k in range(3)], names=["u", "v", "links"])


def similarity_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, th (a hash of the text), class_id (the least
    id in its group of linked documents), n_links (other rows whose similarity
    is at least the threshold, copies included) and ``kept`` (one row of each
    group: the least id, then the least text hash).

    A text of fewer than five words is one shingle; a null or empty text, or
    one without words, is linked to nothing and is a group of its own, of
    class_id its own id; null ids are a group's class_id only if all its ids
    are null; rows that share id and text are linked, and each is marked kept
    if one is; long texts are read whole; an empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("th"),
                       F.col(f"`{text_col}`").cast("binary").alias("t"))
    sigs = stage_table(base.mapInArrow(
        _signatures, f"id {id_type}, th long, k1 long, k2 long, size long, bands array<long>"), "join-signatures")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "th")
    sets = stage_table(
        sigs.where("size > 0").groupBy("k1", "k2")
        .agg(F.min(place).alias("rep"), F.count("*").alias("n"), F.first("bands").alias("bands"))
        .withColumn("uid", F.monotonically_increasing_id()), "join-classes")

    hits = sets.select("uid", F.explode("bands").alias("band"))
    buckets = (hits.groupBy("band").agg(F.min("uid").alias("least"), F.count("*").alias("n"))
               .where("n > 1").select("band", "least"))
    # a class meets the least class of each of its buckets (at most BANDS of them); it hangs on the least of these,
    # and only the links between least classes go into the search for components
    met = stage_table(hits.join(buckets, "band").groupBy("uid").agg(F.collect_set("least").alias("near"))
                      .select("uid", F.array_min("near").alias("hub"), "near"), "join-hubs")
    edges = met.select(F.col("hub").alias("u"), F.explode("near").alias("v")).where("u <> v").distinct()
    hubs = components(edges)
    clusters = (met.join(hubs, met.hub == hubs.id, "left")
                .select(F.col("uid").alias("id"), F.coalesce("label", "hub").alias("label")))

    chosen = (sets.join(clusters, sets.uid == clusters.id)
              .select("uid", F.col("label").alias("cluster"), "n", "rep.id", F.col("rep.th").alias("th")))
    one_text = (base.join(chosen.select(F.col("id").alias("c_id"), F.col("th").alias("c_th"), "uid", "cluster", "n"),
                          F.col("id").eqNullSafe(F.col("c_id")) & (F.col("th") == F.col("c_th")))
                .select("uid", "cluster", "n", "t"))
    cand = stage_table(one_text.mapInArrow(_sets, "uid long, cluster long, n long, sh binary, sig binary"),
                       "join-candidates")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    sizes = cand.groupBy("cluster").agg(F.count("*").alias("members")).select("cluster", blocks.alias("blocks"))
    dealt = (cand.join(sizes, "cluster")
             .withColumn("mine", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cluster", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"),
                     "uid", "mine", "n", "sh", "sig"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    found = stage_table(
        dealt.repartition(tasks, "cluster", "p", "q").sortWithinPartitions("cluster", "p", "q")
        .mapInArrow(_compare, "u long, v long, links long"), "join-links")
    links = found.groupBy("u").agg(F.sum("links").alias("links"))
    groups = components(found.where("v is not null").select("u", "v"))
    grouped = (sets.join(groups, sets.uid == groups.id, "left").join(links, sets.uid == links.u, "left")
               .select("k1", "k2", "n", "rep", F.coalesce("label", "uid").alias("group"),
                       F.coalesce("links", F.lit(0)).alias("links")))
    first = grouped.groupBy("group").agg(F.min("rep").alias("first"))
    per_set = grouped.join(first, "group").select("k1", "k2", (F.col("links") + F.col("n") - 1).alias("links"), "first")
    own = F.struct(F.col("id").isNull().alias("last"), "id", "th")
    # sets of no shingles stay alone
    return (sigs.select("id", "th", F.when(F.col("size") > 0, F.col("k1")).alias("k1"), "k2")
            .join(per_set, ["k1", "k2"], "left")
            .select(F.col("id").alias(id_col), "th",
                    F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce(own.eqNullSafe(F.col("first")), F.lit(False)).alias("is_first"),
                    F.col("first").isNull().alias("alone"))
            .select(id_col, "th", "class_id", "n_links", (F.col("is_first") | F.col("alone")).alias("kept")))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose group keeps another one; all
    columns stay; rows that share id and text stay or go
    together; nulls as above."""
    found = similarity_groups(docs, id_col, text_col).where("not kept")
    gone = found.select(F.col(id_col).alias("_g_id"), F.col("th").alias("_g_th")).distinct()
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col(f"`{id_col}`").alias("_id"), F.xxhash64(f"`{text_col}`").alias("_th"))
    return (boxed.join(gone, F.col("_id").eqNullSafe(F.col("_g_id")) & (F.col("_th") == F.col("_g_th")), "left_anti")
            .select("_row.*"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_groups(table(spark, sf_dir, "documents")).drop("th", "kept")
