"""Gram-block fits, bracket quantiles, keyed permutations, pruned k-NN, tree
attributions and saved pipelines against plain versions."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lathe.functions.hashing import keyed_permutation
from lathe.operators import balance, encode, explain, gram, models, profile, quantiles, stages, tree_explain


def regression_frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 10, 0.1] + [1e4, -5, 0]
    y = x @ [0.5, -2.0, 30.0] + rng.normal(size=n)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, fold=np.arange(n) % 5, id=np.arange(n),
                                                       size=pd.array(np.where(np.arange(n) % 7 == 0, None, np.arange(n) % 3), "Int64"))
    return spark.createDataFrame(pdf.astype({"fold": "int32"})).repartition(4), pdf


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - w @ x.mean(0)


def test_gram_cross_validation_equals_the_loop(spark):
    df, pdf = regression_frame(spark)
    feats = ["a", "b", "c"]
    got = {(r.fold, r.part, r.metric): r.value for r in gram.cross_validate_ridge(df, feats, "y", "fold").collect()}
    assert {k[0] for k in got} == set(range(5)) and len(got) == 5 * 2 * 3
    for fold in range(5):
        tr, va = pdf[pdf.fold != fold], pdf[pdf.fold == fold]
        w, b = ridge(tr[feats].to_numpy(), tr.y.to_numpy(), 1.0)
        for part, rows in (("train", tr), ("validation", va)):
            e = rows.y - rows[feats] @ w - b
            want = {"rmse": math.sqrt((e**2).mean()), "mae": e.abs().mean(), "r2": 1 - (e**2).sum() / ((rows.y - rows.y.mean())**2).sum()}
            for metric, v in want.items():
                assert abs(got[(fold, part, metric)] - v) < 1e-6
    loop = models.cross_validate(lambda d: models.fit_ridge(d, feats, "y"),
                                 lambda m, d: models.regression_scores(m, d, feats, "y"), df, "fold")
    for r in loop.collect():
        assert abs(got[(r.fold, r.part, r.metric)] - r.value) < 1e-4


def test_gram_learning_curve_covers_all_sizes_and_folds(spark):
    df, pdf = regression_frame(spark)
    feats = ["a", "b", "c"]
    got = {(r.size_index, r.part): (r.mean, r.std) for r in gram.learning_curve_ridge(df, feats, "y", "size", "fold").collect()}
    assert set(got) == set(itertools.product(range(3), ("train", "validation")))
    for size in range(3):
        scores = []
        for fold in range(5):
            tr = pdf[(pdf.fold != fold) & (pdf["size"].fillna(99) <= size)]
            va = pdf[pdf.fold == fold]  # rows without a size are validated too
            w, b = ridge(tr[feats].to_numpy(), tr.y.to_numpy(), 1.0)
            scores.append(1 - ((va.y - va[feats] @ w - b)**2).sum() / ((va.y - va.y.mean())**2).sum())
        assert abs(got[(size, "validation")][0] - np.mean(scores)) < 2e-6
        assert abs(got[(size, "validation")][1] - np.std(scores)) < 2e-6


def test_gram_refuses_nulls_and_takes_no_rows(spark):
    df, _ = regression_frame(spark, 20)
    assert gram.gram_blocks(df.limit(0), ["a"], "y").blocks == {}
    with pytest.raises(Exception, match="null"):
        gram.gram_blocks(df.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), ["a"], "y")


def test_correlation_of_many_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 60)) + 1e5
    x[:, 7] = 3.0
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(60)])
    got = {(r.col_a, r.col_b): r.r for r in profile.correlation_matrix(spark.createDataFrame(pdf), list(pdf.columns)).collect()}
    want = pdf.corr()
    assert len(got) == 3600 and got[("c7", "c1")] is None
    assert all(abs(got[(a, b)] - want.loc[a, b]) < 2e-6 for a in pdf for b in pdf if "c7" not in (a, b))


@pytest.mark.parametrize("most", [200_000, 40])
def test_wide_quantiles(spark, monkeypatch, most):
    """All columns and groups at once; hot values, few rows, no rows, and brackets
    that have to be cut again."""
    monkeypatch.setattr(quantiles, "MOST", most)
    monkeypatch.setattr(quantiles, "SKETCH", 64 if most < 100 else 4_000)
    monkeypatch.setattr(quantiles, "SLACK", 0.08 if most < 100 else 0.003)
    rng = np.random.default_rng(8)
    n = 6000
    pdf = pd.DataFrame({"g": np.where(np.arange(n) < 2000, "hot", rng.choice(["a", "b", None], n)), "u": rng.normal(size=n),
                        "v": np.where(np.arange(n) % 3 == 0, 7.0, rng.lognormal(5, 3, n)), "w": rng.integers(0, 5, n).astype(float)})
    pdf.loc[::11, "u"] = np.nan
    pdf.loc[pdf.g == "b", "w"] = np.nan
    rows = [tuple(None if isinstance(x, float) and math.isnan(x) else x for x in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "g string, u double, v double, w double").repartition(3)
    qs = [0.0, 0.1, 0.5, 0.77, 1.0]
    names = [f"q{i}" for i in range(5)]
    for groups in ([], ["g"]):
        got = quantiles.wide_quantiles(df, ["u", "v", "w"], qs, names, groups).collect()
        assert len(got) == 3 * (4 if groups else 1)
        for r in got:
            rows_ = pdf if not groups else pdf[pdf.g.isna()] if r.g is None else pdf[pdf.g == r.g]
            vals = rows_[r.column].dropna().to_numpy()
            for q, name in zip(qs, names):
                want = np.percentile(vals, q * 100) if len(vals) else None
                assert r[name] is None if want is None else abs(r[name] - want) <= 1e-9 * max(1, abs(want))
    assert quantiles.wide_quantiles(df.limit(0), ["u"], [0.5], ["m"]).first()["m"] is None


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1013])
def test_keyed_permutation(spark, n):
    rows = spark.range(n).select("id", keyed_permutation(F.col("id"), n, "k").alias("p"), keyed_permutation(F.col("id"), n, "m").alias("q"))
    got = rows.collect()
    assert sorted(r.p for r in got) == list(range(n)) == sorted(r.q for r in got)
    if n > 50:
        assert sum(r.p == r.id for r in got) < n / 10 and sum(r.p == r.q for r in got) < n / 10


def test_permuted_values_keep_each_column(spark):
    df, pdf = regression_frame(spark, 90)
    got = explain.permuted_values(df, "id", ["a", "b"]).toPandas()
    assert sorted(got["_p0"]) == sorted(pdf.a) and sorted(got["_p1"]) == sorted(pdf.b)
    assert (got.sort_values("id")["_p0"].to_numpy() != pdf.sort_values("id").a.to_numpy()).sum() > 70


def test_pruned_knn_skips_far_blocks(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(120, 6)) * 0.1 + 10 * rng.normal(size=6) for _ in range(5)])
    x[100:110] = x[0]  # copies: ties by id
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "v": list(x)}), "id long, v array<double>")
    report = {}
    got = balance.knn(df, "id", "v", k=4, block_rows=40, report=report).collect()
    d = ((x[:, None, :] - x[None, :, :])**2).sum(2)
    np.fill_diagonal(d, np.inf)
    assert len(got) == 4 * len(x)
    for r in got:
        assert np.lexsort((np.arange(len(x)), d[r.id]))[:4][r.nn_rank - 1] == r.nn_id
    assert report["compared"] < 0.5 * report["pairs"]


def brute_shapley(leaves, x):
    """Over all subsets of the features, the mean of the leaves whose path a subset
    leaves open, weighted by the training shares."""
    d = len(x)

    def expected(known):
        return sum(v * math.prod((float(lo < x[f] <= hi) if f in known else z) for f, lo, hi, z in path)
                   for v, path in zip(leaves.values, leaves.paths))
    out = np.zeros(d)
    for i in range(d):
        for size in range(d):
            for s in itertools.combinations([j for j in range(d) if j != i], size):
                weight = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
                out[i] += weight * (expected({*s, i}) - expected(set(s)))
    return out


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_tree_attribution(spark, kind):
    df, pdf = regression_frame(spark, 300)
    feats = ["a", "b", "c"]
    m = (models.fit_gbt_regressor(df, feats, "y", 6, 3) if kind == "gbt" else models.fit_rf_regressor(df, feats, "y", 5))
    leaves = tree_explain.leaf_table(m)
    x = pdf[feats].to_numpy()
    values = tree_explain.shapley_values(leaves, x)
    for i in range(0, 300, 37):
        assert np.allclose(values[i], brute_shapley(leaves, x[i]), atol=1e-8)
    scored = {r.id: r.prediction for r in m.transform(models.assemble(df, feats)).collect()}
    sums = {r.id: r.s for r in tree_explain.tree_attribution(df, "id", feats, leaves).groupBy("id").agg(F.sum("attr").alias("s")).collect()}
    assert all(abs(sums[i] + leaves.base - scored[i]) < 1e-8 for i in scored)


def test_sparse_indicators(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (None, ["z", "c"])], "id long, t array<string>")
    index = encode.fit_token_index(df.where("id <> 2 or id is null"), F.col("t"))
    rows = encode.as_vectors(encode.sparse_indicators(df, "id", F.col("t"), index))
    got = {r.id: (r.features.size, list(r.features.indices)) for r in rows.collect()}
    assert got == {1: (4, [0, 1]), 2: (4, []), 3: (4, []), None: (4, [2, 3])}


def test_saved_pipeline_scores_as_before(spark, tmp_path):
    """Imputer, encoder, scaler and each predictor, saved, read again, with unseen
    and null categories at scoring."""
    from pyspark.ml.regression import GBTRegressor
    from lathe.operators import flows
    rng = np.random.default_rng(5)
    rows = [(i, [None, "x", "y"][i % 3], f"t{i % 20}", f"many{i % 60}", None if i % 9 == 0 else float(i % 50), float(rng.normal()),
             i % 3) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, low string, mid string, high string, num double, y double, fold int")
    features, names = flows.fit_features(df, [], ["num"], {"num": "has_num"}, [], ["low", "mid", "high"], ["num", "has_num"])
    assert names[:4] == ["num", "has_num", "low_ordinal", "mid_t0"] and names[-2:] == ["mid_other", "high_freq"]
    train = flows.fit_rows(features.transform(df), ["y", "fold"])
    predictors = {"ridge": stages.RidgeRegression("y"), "stacking": stages.StackingRegressor(
        [stages.RidgeRegression("y"), GBTRegressor(labelCol="y", maxIter=3, maxDepth=2, seed=1)], stages.RidgeRegression("y", alpha=0.1),
        "fold", labelCol="y")}
    back = flows.fit_and_save(features, train, predictors, str(tmp_path))
    new = spark.createDataFrame([(1, "unseen", None, "many7", None), (2, None, "t3", None, 4.0), (3, "x", "t0", "new", 1.0)],
                                "id long, low string, mid string, high string, num double")
    for model in back.values():
        assert all(math.isfinite(r.prediction) for r in model.transform(new).collect())
    x = {r.id: dict(zip(names, r.features.toArray())) for r in features.transform(new).collect()}
    raw = features.stages[-2].getOrDefault("moments")
    plain = {i: {n: round(v * raw[n][1] + raw[n][0], 6) for n, v in f.items()} for i, f in x.items()}
    assert plain[1]["low_ordinal"] == -1 and plain[1]["mid_other"] == 1 and plain[1]["high_freq"] == 4 and plain[1]["has_num"] == 0
    assert plain[2]["low_ordinal"] == 0 and plain[2]["high_freq"] == 0 and plain[3]["mid_t0"] == 1
    st = back["stacking"].stages[-1]
    assert len(st.bases) == 2 and st.getOrDefault("passthrough") and st.meta.numFeatures == len(names) + 2
