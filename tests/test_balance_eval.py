"""k-NN vs brute force, SMOTE invariants, undersampling ratio, AUC vs
pairwise definition, ridge vs closed form."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lathe.functions import hashing
from lathe.operators import balance, evaluate, models


def _vecs(spark, n=60, d=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    pdf = pd.DataFrame({"id": np.arange(n), "v": list(x), "y": (np.arange(n) % 4 == 0).astype(int)})
    return spark.createDataFrame(pdf, "id long, v array<double>, y int"), x


def test_knn_matches_brute_force_with_small_blocks(spark):
    df, x = _vecs(spark)
    got = balance.knn(df, "id", "v", k=3, block_rows=16).collect()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    for r in got:
        order = np.lexsort((np.arange(len(x)), d[r.id]))[:3]
        assert order[r.nn_rank - 1] == r.nn_id


def test_smote_counts_and_segments(spark):
    df, x = _vecs(spark)
    is_min = F.col("y") == 1
    syn = balance.smote(df, "id", "v", is_min, ratio=0.5, k=3).collect()
    n_min, n_maj = 15, 45
    assert len(syn) == int(0.5 * n_maj) - n_min
    for r in syn:
        a, b = x[r.base_id], x[r.nn_id]
        assert 0 <= r.gap < 1 and np.allclose(np.array(r.v), a + r.gap * (b - a))


def test_undersample_ratio(spark):
    df, _ = _vecs(spark)
    out = balance.random_undersample(df, "id", F.col("y") == 1, ratio=0.75)
    c = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert c[1] == 15 and c[0] == int(15 / 0.75)


def test_auc_matches_pairwise_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.3), (0, 0.7), (1, 0.3), (1, 0.95), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, p double")
    got = evaluate.auc(df, "y", "p").first().auc
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    exp = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(got - exp) < 1e-9
    cm = {(r.actual, r.predicted): r["count"] for r in
          evaluate.confusion_matrix(df.withColumn("h", (F.col("p") > 0.5).cast("int")), "y", "h").collect()}
    assert cm == {(1, 1): 3, (0, 1): 2, (1, 0): 1, (0, 0): 2}


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(scale=0.1, size=200)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y)
    m = models.fit_ridge(spark.createDataFrame(pdf), ["a", "b", "c"], "y", alpha=1.0)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-6)


def test_hash_unit_range(spark):
    df = spark.range(1000).select(hashing.hash_unit("id").alias("u"))
    r = df.agg(F.min("u"), F.max("u")).first()
    assert 0 <= r[0] and r[1] < 1


def test_knn_mixed_penalty_multi_block(spark):
    rng = np.random.default_rng(5)
    n = 70
    x = rng.normal(size=(n, 3))
    cats = rng.choice(["a", "b", "c"], size=(n, 2))
    pdf = pd.DataFrame({"id": np.arange(n), "v": list(x), "c": [list(r) for r in cats]})
    df = spark.createDataFrame(pdf, "id long, v array<double>, c array<string>")
    pen = 0.7
    got = balance.knn(df, "id", "v", k=4, cat_col="c", penalty=pen, block_rows=9).collect()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2) + pen * (cats[:, None, :] != cats[None, :, :]).sum(2)
    np.fill_diagonal(d, np.inf)
    assert len(got) == n * 4
    for r in got:
        order = np.lexsort((np.arange(n), d[r.id]))[:4]
        assert order[r.nn_rank - 1] == r.nn_id


def test_knn_blocks_grow_with_the_table(spark):
    """Block pairs do not grow with the square of the rows, and the neighbours stay
    exact: ties by id, distances to the last bit, far from the origin too."""
    rng = np.random.default_rng(11)
    n, pen = 600, 0.3
    x = rng.normal(size=(n, 7)) + 1e4
    x[200:260] = x[3]
    cats = rng.choice(["a", "b"], size=(n, 1))
    pdf = pd.DataFrame({"id": np.arange(n), "v": list(x), "c": [list(r) for r in cats]})
    df = spark.createDataFrame(pdf, "id long, v array<double>, c array<string>")
    report = {}
    got = balance.knn(df, "id", "v", k=4, cat_col="c", penalty=pen, block_rows=2, report=report).collect()
    d = np.square(x[:, None, :] - x[None, :, :]).sum(axis=2) + pen * (cats[:, None, 0] != cats[None, :, 0])
    np.fill_diagonal(d, np.inf)
    assert len(got) == 4 * n
    for r in got:
        order = np.lexsort((np.arange(n), d[r.id]))[:4]
        assert (order[r.nn_rank - 1], d[r.id][r.nn_id]) == (r.nn_id, r.dist2)
    assert report["pairs"] <= 1000
