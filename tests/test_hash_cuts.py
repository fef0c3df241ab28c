"""Cut points in hash order against a full ranking, class weights with rows
that have no label, and rebalancing of mixed rows."""

import hashlib

import pandas as pd
from pyspark.sql import functions as F

from lathe.operators import balance, split
from lathe.operators.evaluate import balanced_weights
from lathe.operators.ordering import cut_by_hash


def _h(k):
    return hashlib.md5(f"{k}|42".encode()).hexdigest()


def test_cuts_match_full_ranking_with_hot_and_null_groups(spark):
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"g{i % 40}")) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, g string")
    targets = [lambda n: F.lit(0), lambda n: F.floor(n / 3), lambda n: n - 1, lambda n: n + 5]
    got = {r.k: r._part for r in cut_by_hash(df, ["g"], "k", targets).collect()}
    by = {}
    for k, g in rows:
        by.setdefault(g, []).append(k)
    for ks in by.values():
        n = len(ks)
        for rank, k in enumerate(sorted(ks, key=_h), 1):
            # every row lies beyond a cut at 0, none beyond a cut past the last row
            expect = 1 + (rank > n // 3) + (rank > n - 1)
            assert got[k] == expect
    assert len(got) == 3000


def test_cuts_few_digits_rank_inside_buckets(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    got = cut_by_hash(df, [], "k", [lambda n: F.floor(n * 0.37)], digits=1).where("_part = 0").collect()
    assert sorted(r.k for r in got) == sorted(sorted(range(500), key=_h)[:185])


def test_split_edges(spark):
    empty = spark.createDataFrame([], "k long, s string")
    assert split.stratified_split(empty, "k", "s").collect() == []
    assert split.stratified_split(empty, "k").collect() == []
    assert split.learning_sizes(empty, "k").collect() == []
    one = spark.createDataFrame([(7, "a")], "k long, s string")
    assert [r.split for r in split.stratified_split(one, "k", "s").collect()] == ["train"]
    same = spark.createDataFrame([(1, None), (1, None), (None, "x"), (2, "x")], "k long, s string")
    parts = split.stratified_split(same, "k").collect()
    assert len(parts) == 4 and len({r.split for r in parts if r.k == 1}) == 1


def test_weights_of_rows_without_label(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,), (None,)], "y int")
    got = sorted((r.y is None, r.y or 0, r.weight) for r in balanced_weights(df, "y").collect())
    assert got == [(False, 0, 2.0), (False, 1, 4 / 6), (False, 1, 4 / 6), (False, 1, 4 / 6), (True, 0, None)]


def test_rebalance_with_categories(spark):
    rows = [(i, [float(i), float(i % 5)], ["a" if i % 2 else "b"], int(i >= 10), "x") for i in range(110)]
    df = spark.createDataFrame(rows, "id long, v array<double>, c array<string>, y int, note string")
    out = balance.rebalance(df, "id", "v", "y", 0, k=3, cat_col="c", penalty=4.0).toPandas()
    assert (out.y == 0).sum() == 50 and (out.y == 1).sum() == 66
    made = out[out.id < 0]
    assert len(made) == 40 and set(made.c.map(tuple)) <= {("a",), ("b",)} and made.note.isna().all()
    none = balance.smote(df.where("y = 1"), "id", "v", F.col("y") == 0, cat_col="c")
    some = balance.smote(df, "id", "v", F.col("y") == 0, cat_col="c")
    assert dict(none.dtypes) == dict(some.dtypes)


def test_knn_over_several_blocks_matches_brute_force(spark):
    pdf = pd.DataFrame({"id": range(300)})
    pdf["v"] = [[float((i * 37) % 101), float((i * 11) % 17)] for i in pdf.id]
    got = balance.knn(spark.createDataFrame(pdf), "id", "v", k=4, block_rows=64).collect()
    for q in (0, 7, 299):
        d = sorted((sum((a - b) ** 2 for a, b in zip(pdf.v[q], pdf.v[c])), c) for c in pdf.id if c != q)[:4]
        assert [(r.dist2, r.nn_id) for r in sorted((r for r in got if r.id == q), key=lambda r: r.nn_rank)] == d
