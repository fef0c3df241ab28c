"""Balancing, folds and samples on ``embeddings`` (label 0 is the
minority class), ``orders`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions.text import word_count
from lathe.operators import balance, split
from lathe.plans.registry import query
from lathe.sources.tables import table

K = 5

_KNN_SQL = """
WITH m AS (SELECT vec_id, embedding FROM embeddings WHERE label = 0),
e AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM m),
d AS (SELECT a.vec_id AS q, b.vec_id AS c, sum(power(CAST(a.v AS DOUBLE) - CAST(b.v AS DOUBLE), 2)) AS d2
      FROM e a JOIN e b ON a.i = b.i AND a.vec_id <> b.vec_id GROUP BY 1, 2),
knn AS (SELECT q AS vec_id, CAST(row_number() OVER (PARTITION BY q ORDER BY d2, c) AS INTEGER) AS nn_rank, c AS nn_id, d2
        FROM d QUALIFY nn_rank <= 5)
"""


def minority(spark, sf):
    return table(spark, sf, "embeddings").where(F.col("label") == 0)


@query("k04_knn_self_join", _KNN_SQL + """
SELECT vec_id, nn_rank, nn_id, round(d2, 4) AS dist2 FROM knn""")
def k04(spark, sf):
    nn = balance.knn(minority(spark, sf), "vec_id", "embedding", k=K, block_rows=16)
    return nn.select("vec_id", "nn_rank", "nn_id", F.round("dist2", 4).alias("dist2"))


@query("d05_random_undersample", """
WITH c AS (SELECT count(*) FILTER (WHERE label = 0) AS n_min FROM embeddings),
r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label = 0 ORDER BY md5(concat_ws('|', CAST(vec_id AS VARCHAR), '42')), vec_id) AS rk
      FROM embeddings)
SELECT vec_id, label FROM r, c WHERE label = 0 OR rk <= floor(n_min / 0.75)""")
def d05(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label")
    return balance.random_undersample(e, "vec_id", F.col("label") == 0, ratio=0.75)


_SMOTE_SQL = _KNN_SQL + """
, cnt AS (SELECT count(*) FILTER (WHERE label = 0) AS n_min, count(*) FILTER (WHERE label <> 0) AS n_maj FROM embeddings),
par AS (SELECT n_min, greatest(CAST(floor(0.5 * n_maj) AS BIGINT) - n_min, 0) AS n_syn FROM cnt),
base AS (SELECT vec_id AS base_id, embedding AS x,
                row_number() OVER (ORDER BY md5(concat_ws('|', CAST(vec_id AS VARCHAR), '42')), vec_id) AS r FROM m),
ex AS (SELECT base_id, x, r, n_min,
              unnest(range(1, CAST(n_syn // n_min + CASE WHEN r <= n_syn % n_min THEN 1 ELSE 0 END AS BIGINT) + 1)) AS j
       FROM base, par),
s AS (SELECT *, (j - 1) * n_min + r - 1 AS synth_id FROM ex),
s2 AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', CAST(synth_id AS VARCHAR), 'nn', '42')), 1, 8))::BIGINT % 5 + 1 AS INTEGER) AS nn_rank,
              ('0x' || substr(md5(concat_ws('|', CAST(synth_id AS VARCHAR), 'gap', '42')), 1, 8))::BIGINT / 4294967296.0 AS gap FROM s),
syn AS (SELECT s2.synth_id, s2.base_id, knn.nn_id, s2.gap,
               list_transform(range(1, len(s2.x) + 1), lambda i: CAST(s2.x[i] AS DOUBLE) + s2.gap * (CAST(nb.embedding[i] AS DOUBLE) - CAST(s2.x[i] AS DOUBLE))) AS v
        FROM s2 JOIN knn ON knn.vec_id = s2.base_id AND knn.nn_rank = s2.nn_rank
        JOIN m nb ON nb.vec_id = knn.nn_id)
"""


@query("d06_smote", _SMOTE_SQL + """
SELECT synth_id, base_id, nn_id, round(gap, 6) AS gap, round(v[1], 4) AS e0, round(v[2], 4) AS e1,
       round(v[3], 4) AS e2, round(v[4], 4) AS e3, round(sqrt(list_sum(list_transform(v, lambda t: t * t))), 4) AS norm
FROM syn""")
def d06(spark, sf):
    e = table(spark, sf, "embeddings")
    syn = balance.smote(e, "vec_id", "embedding", F.col("label") == 0, ratio=0.5, k=K)
    v = F.col("embedding")
    return syn.select("synth_id", "base_id", "nn_id", F.round("gap", 6).alias("gap"),
                      *[F.round(v[i], 4).alias(f"e{i}") for i in range(4)],
                      F.round(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), 4).alias("norm"))


@query("d08_rebalance_counts", """
WITH c AS (SELECT count(*) FILTER (WHERE label = 0) AS n_min, count(*) FILTER (WHERE label <> 0) AS n_maj FROM embeddings),
g AS (SELECT n_min + greatest(CAST(floor(0.5 * n_maj) AS BIGINT) - n_min, 0) AS grown_min, n_maj FROM c)
SELECT true AS is_minority, grown_min AS rows FROM g
UNION ALL SELECT false, CAST(least(n_maj, floor(grown_min / 0.75)) AS BIGINT) FROM g""")
def d08(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding", F.when(F.col("label") == 0, 0).otherwise(1).alias("y"))
    out = balance.rebalance(e, "vec_id", "embedding", "y", 0, smote_ratio=0.5, under_ratio=0.75, k=K)
    return out.groupBy((F.col("y") == 0).alias("is_minority")).agg(F.count(F.lit(1)).alias("rows"))


_NC_SQL = """
WITH w AS (SELECT doc_id, quality, CAST(n_chars AS DOUBLE) AS a, CAST(len(string_split(text, ' ')) AS DOUBLE) AS b, lang, source
           FROM documents JOIN labels USING (doc_id)),
m AS (SELECT * FROM w WHERE quality = 0),
sd AS (SELECT (stddev_pop(a) + stddev_pop(b)) / 2 AS med FROM m),
d AS (SELECT x.doc_id AS q, y.doc_id AS c,
             power(x.a - y.a, 2) + power(x.b - y.b, 2)
             + med * med * (CAST(x.lang <> y.lang AS INTEGER) + CAST(x.source <> y.source AS INTEGER)) AS d2
      FROM m x JOIN m y ON x.doc_id <> y.doc_id, sd),
knn AS (SELECT q AS base_id, CAST(row_number() OVER (PARTITION BY q ORDER BY d2, c) AS INTEGER) AS nn_rank, c AS nn_id
        FROM d QUALIFY nn_rank <= 5),
par AS (SELECT count(*) FILTER (WHERE quality = 0) AS n_min,
               greatest(CAST(floor(0.5 * count(*) FILTER (WHERE quality <> 0)) AS BIGINT) - count(*) FILTER (WHERE quality = 0), 0) AS n_syn FROM w),
base AS (SELECT doc_id AS base_id, a, b, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42')), doc_id) AS r FROM m),
s AS (SELECT base_id, a, b, (j - 1) * n_min + r - 1 AS synth_id FROM (
  SELECT *, unnest(range(1, CAST(n_syn // n_min + CASE WHEN r <= n_syn % n_min THEN 1 ELSE 0 END AS BIGINT) + 1)) AS j FROM base, par)),
s2 AS (SELECT *, CAST(('0x' || substr(md5(concat_ws('|', CAST(synth_id AS VARCHAR), 'nn', '42')), 1, 8))::BIGINT % 5 + 1 AS INTEGER) AS nn_rank,
              ('0x' || substr(md5(concat_ws('|', CAST(synth_id AS VARCHAR), 'gap', '42')), 1, 8))::BIGINT / 4294967296.0 AS gap FROM s),
modes AS (SELECT base_id, max(v) FILTER (WHERE p = 0) AS lang, max(v) FILTER (WHERE p = 1) AS source FROM (
  SELECT base_id, p, v, row_number() OVER (PARTITION BY base_id, p ORDER BY count(*) DESC, v) AS o FROM (
    SELECT base_id, 0 AS p, lang AS v FROM knn JOIN m ON nn_id = doc_id UNION ALL
    SELECT base_id, 1, source FROM knn JOIN m ON nn_id = doc_id) GROUP BY base_id, p, v) WHERE o = 1 GROUP BY base_id)
SELECT synth_id, s2.base_id, knn.nn_id, round(gap, 6) AS gap, round(s2.a + gap * (n.a - s2.a), 4) AS num0,
       round(s2.b + gap * (n.b - s2.b), 4) AS num1, modes.lang AS cat0, modes.source AS cat1
FROM s2 JOIN knn USING (base_id, nn_rank) JOIN m n ON n.doc_id = knn.nn_id JOIN modes ON modes.base_id = s2.base_id"""


@query("d07_smotenc", _NC_SQL)
def d07(spark, sf):
    """SMOTENC on documents: numeric (length, words) + categorical (lang,
    source); minority = quality 0.  Mismatch penalty = (median of the
    minority numeric pop stds)^2 per differing category."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "quality", F.array(F.col("n_chars").cast("double"), word_count("text").cast("double")).alias("num"),
        F.array("lang", "source").alias("cat"))
    stds = d.where("quality = 0").agg(F.stddev_pop(F.col("num")[0]).alias("a"),
                                      F.stddev_pop(F.col("num")[1]).alias("b")).first()
    med = sorted([stds["a"] or 0.0, stds["b"] or 0.0])
    med = (med[0] + med[1]) / 2
    syn = balance.smote(d, "doc_id", "num", F.col("quality") == 0, ratio=0.5, k=K, cat_col="cat",
                        penalty=med * med)
    return syn.select("synth_id", "base_id", "nn_id", F.round("gap", 6).alias("gap"),
                      *[F.round(F.col("num")[i], 4).alias(f"num{i}") for i in range(2)],
                      *[F.col("cat")[i].alias(f"cat{i}") for i in range(2)])


@query("d04_assign_folds", """
SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders""")
def d04(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.assign_folds(o, "o_orderkey", k=5, strata="o_orderstatus").select("o_orderkey", "fold")


_FR = [0.25 + 0.75 * i / 7 for i in range(8)]


@query("d09_learning_sizes", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) AS rk,
                  count(*) OVER () AS n FROM orders)
SELECT size_index, count(*) AS rows FROM (
  SELECT CAST(CASE """ + " ".join(f"WHEN rk <= floor(n * {f!r} + 0.5) THEN {i}" for i, f in enumerate(_FR))
    + """ END AS INTEGER) AS size_index FROM r) GROUP BY size_index""")
def d09(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    s = split.learning_sizes(o, "o_orderkey", n_sizes=8, lo=0.25, hi=1.0)
    return s.groupBy("size_index").agg(F.count(F.lit(1)).alias("rows"))


@query("d10_sample_rows", """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey LIMIT 20""")
def d10(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.sample_rows(o, "o_orderkey", 20)


@query("d10_sample_per_group", """
SELECT o_orderstatus AS "group", o_orderkey FROM (
  SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus
         ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) AS rk FROM orders) WHERE rk <= 1""")
def d10g(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.sample_per_group(o, "o_orderkey", "o_orderstatus", 1).select("group", "o_orderkey")


def _docs_mixed(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").where(F.col("quality") == 0)
    return d.select("doc_id", F.array(F.col("n_chars").cast("double"), word_count("text").cast("double")).alias("num"),
                    F.array("lang", "source").alias("cat"))


@query("d07_smotenc_neighbours", """
WITH m AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS a, CAST(len(string_split(text, ' ')) AS DOUBLE) AS b, lang, source
           FROM documents JOIN labels USING (doc_id) WHERE quality = 0),
sd AS (SELECT (stddev_pop(a) + stddev_pop(b)) / 2 AS med FROM m),
d AS (SELECT x.doc_id AS q, y.doc_id AS c,
             power(x.a - y.a, 2) + power(x.b - y.b, 2)
             + med * med * (CAST(x.lang <> y.lang AS INTEGER) + CAST(x.source <> y.source AS INTEGER)) AS d2
      FROM m x JOIN m y ON x.doc_id <> y.doc_id, sd)
SELECT q AS doc_id, CAST(row_number() OVER (PARTITION BY q ORDER BY d2, c) AS INTEGER) AS nn_rank, c AS nn_id
FROM d QUALIFY nn_rank <= 5""")
def d07n(spark, sf):
    """SMOTENC's neighbour table: numeric squared distance plus (median of
    the minority numeric population stds)^2 per categorical mismatch."""
    m = _docs_mixed(spark, sf)
    st = m.agg(F.stddev_pop(F.col("num")[0]).alias("a"), F.stddev_pop(F.col("num")[1]).alias("b")).first()
    med = ((st["a"] or 0.0) + (st["b"] or 0.0)) / 2
    nn = balance.knn(m, "doc_id", "num", k=K, cat_col="cat", penalty=med * med)
    return nn.select("doc_id", "nn_rank", "nn_id")
