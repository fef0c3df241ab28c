"""Distributed model fitting, validation and tuning on Spark ML
(M01-M06, M08-M10, M12-M15).

Mappings to the reference's estimators:
* ridge ``min ||y - Xw - b||² + α||w||²`` = ``LinearRegression`` with
  ``regParam = α·std_pop(y)/n``, no standardisation, normal solver
  (Spark scales the label by its std inside the objective);
* balanced logistic (C = 1) = ``LogisticRegression`` with class weights
  ``n / (2·n_c)`` and ``regParam = 1/n``;
* boosted trees map to ``GBT*``: subsample -> ``subsamplingRate``,
  column sample -> ``featureSubsetStrategy`` (per node), min child weight
  -> ``minInstancesPerNode``, gamma -> ``minInfoGain``; L1/L2 leaf penalties
  have no counterpart.
Fits run on a persisted (memory and disk) vector table, released after,
large forests on a staged one."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from lathe.operators.evaluate import balanced_weights
from lathe.operators.trees import SMALL, BoostedClassifier, BoostedRegressor, ForestClassifier, ForestRegressor, fold_errors
from lathe.session import stage_table


def assemble(df: DataFrame, feats: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=feats, outputCol=out, handleInvalid="error").transform(df)


def _persisted(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _vectors(df: DataFrame, feats: list[str], *keep: str) -> DataFrame:
    """The vectors of a fit and the columns ``keep``: a persisted table holds every
    column it is given, read or not."""
    return assemble(df, feats).select("features", *keep)


def _rows(df: DataFrame, feats: list[str], *keep: str) -> tuple[DataFrame, DataFrame]:
    """The persisted vector table of an iterative fit, and how the fit reads it."""
    held = _persisted(_vectors(df, feats, *keep))
    return held, few_tasks(held)


#: rows of a fit that one task reads at most; a forest holds about half a kB of each
TASK_ROWS = 500_000


def spread_rows(df: DataFrame, rows_per_task: int = 5_000) -> DataFrame:
    """A small table dealt over the cores that are there: growing many deep trees
    is work for every row, unlike boosting, which mostly waits for its jobs.  A
    large one is dealt over more tasks, so that none reads over ``TASK_ROWS`` rows."""
    now, rows = df.rdd.getNumPartitions(), df.count()
    wanted = max(min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task)), -(-rows // TASK_ROWS))
    return df.repartition(wanted) if wanted > now else df


def _forest_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a forest fit holds, and how it reads it.  Beyond ``TASK_ROWS`` rows they
    are staged, not persisted: one task reads a persisted partition whole, but
    only a split of a staged file."""
    held = stage_table(df, "forest-rows") if df.count() > TASK_ROWS else _persisted(df)
    return held, spread_rows(held)


def _grown(est, rows: DataFrame):
    """A boosted fit: from binned rows where it can be (``trees``), else by Spark ML."""
    held = _persisted(rows)
    m = est.grown(held) or est.on_spark(few_tasks(held))
    held.unpersist()
    return m


def fit_linear(df: DataFrame, feats: list[str], label: str):
    d = _persisted(_vectors(df, feats, label))
    m = LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, solver="normal").fit(d)
    d.unpersist()
    return m


def fit_ridge(df: DataFrame, feats: list[str], label: str, alpha: float = 1.0):
    d = _persisted(_vectors(df, feats, label))
    st = d.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    reg = alpha * (st["s"] or 0.0) / st["n"]
    m = LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0,
                         standardization=False, solver="normal").fit(d)
    d.unpersist()
    return m


def fit_gbt_regressor(df, feats, label, n_trees: int = 100, depth: int = 6, lr: float = 0.1,
                      subsample: float = 1.0, colsample: str = "all", seed: int = 42):
    return _grown(BoostedRegressor(featuresCol="features", labelCol=label, maxIter=n_trees, maxDepth=depth, stepSize=lr,
                                   subsamplingRate=subsample, featureSubsetStrategy=colsample, seed=seed),
                  _vectors(df, feats, label))


def fit_rf_regressor(df, feats, label, n_trees: int = 100, feature_frac: str = "0.7", seed: int = 42):
    held, d = _forest_rows(_vectors(df, feats, label))
    est = ForestRegressor(featuresCol="features", labelCol=label, numTrees=n_trees,
                          featureSubsetStrategy=feature_frac, seed=seed)
    m = est.grown(held) or est.on_spark(d)
    held.unpersist()
    return m


@dataclass
class StackingModel:
    bases: list
    meta: object
    feats: list[str]
    passthrough: bool = True
    names: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        d = assemble(df, self.feats)
        for name, b in zip(self.names, self.bases):
            d = b.transform(d).withColumnRenamed("prediction", name)
        cols = self.names + (self.feats if self.passthrough else [])
        d = d.drop("features")
        return self.meta.transform(assemble(d, cols, "features"))


def fit_stacking(df: DataFrame, feats: list[str], label: str, fold_col: str, k: int = 5,
                 base_factories=None, meta_alpha: float = 0.1, passthrough: bool = True, parallelism: int = 6) -> StackingModel:
    """Out-of-fold base predictions (+ features) -> ridge meta-model; bases
    refit on all rows.  ``base_factories``: ``{name: fn(df, feats, label)}``."""
    base_factories = base_factories or {"ridge": lambda d, f, y: fit_ridge(d, f, y, 1.0),
                                        "gbt": lambda d, f, y: fit_gbt_regressor(d, f, y, 20, 4)}
    names = list(base_factories)
    df = stage_table(df, "stacking-rows")
    df = few_tasks(df) if df.count() <= SMALL else df
    # the fits of all folds, and of all rows (fold None), do not depend on each other
    jobs = [(name, fold) for fold in [*range(k), None] for name in names]
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        fitted = dict(zip(jobs, pool.map(inheritable_thread_target(df.sparkSession)(
            lambda job: base_factories[job[0]](df if job[1] is None else df.where(F.col(fold_col) != job[1]), feats, label)), jobs)))
    oof = None
    for fold in range(k):
        part = assemble(df.where(F.col(fold_col) == fold), feats)
        for name in names:
            part = fitted[(name, fold)].transform(part).withColumnRenamed("prediction", name)
        part = part.drop("features")
        oof = part if oof is None else oof.unionByName(part)
    meta = fit_ridge(oof, names + (feats if passthrough else []), label, meta_alpha)
    bases = [fitted[(name, None)] for name in names]
    return StackingModel(bases, meta, feats, passthrough, names)


def fit_logistic(df: DataFrame, feats: list[str], label: str, balanced: bool = True, max_iter: int = 1000):
    d = balanced_weights(df, label) if balanced else df.withColumn("weight", F.lit(1.0))
    held, d = _rows(d, feats, label, "weight")
    n = d.count()
    m = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", regParam=1.0 / n,
                           elasticNetParam=0.0, standardization=False, maxIter=max_iter).fit(d)
    held.unpersist()
    return m


def logistic_gradient(model, df: DataFrame, feats: list[str], label: str, balanced: bool = True) -> DataFrame:
    """(term, gradient, scale) of the penalised log-loss that ``fit_logistic``
    minimises, at the model's weights, from one aggregate: the mean of
    weight * (p - y) * x plus penalty * w (no penalty for the intercept), and the
    mean of weight * |x| to judge it by.  At the optimum every gradient is 0."""
    d = balanced_weights(df, label) if balanced else df.withColumn("weight", F.lit(1.0))
    w = [float(v) for v in model.coefficients.toArray()]
    margin = sum((F.col(f).cast("double") * v for f, v in zip(feats, w)), F.lit(float(model.intercept)))
    d = d.withColumn("_e", F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col(label)))
    terms = [("intercept", F.lit(1.0), 0.0)] + [(f, F.col(f).cast("double"), v) for f, v in zip(feats, w)]
    one = d.agg(F.sum("weight").alias("_w"), F.count(F.lit(1)).alias("_n"), *[x for i, (_, c, _) in enumerate(terms) for x in (
        F.sum(F.col("_e") * c).alias(f"g{i}"), F.sum(F.col("weight") * F.abs(c)).alias(f"s{i}"))]).first()
    rows = [(name, one[f"g{i}"] / one["_w"] + v / one["_n"], one[f"s{i}"] / one["_w"]) for i, (name, _, v) in enumerate(terms)]
    return df.sparkSession.createDataFrame(rows, "term string, gradient double, scale double")


def fit_rf_classifier(df, feats, label, n_trees: int = 200, depth: int = 15, min_leaf: int = 5,
                      balanced: bool = True, seed: int = 42):
    d = balanced_weights(df, label) if balanced else df.withColumn("weight", F.lit(1.0))
    held, d = _forest_rows(_vectors(d, feats, label, "weight"))
    est = ForestClassifier(featuresCol="features", labelCol=label, weightCol="weight", numTrees=n_trees,
                           maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt",
                           seed=seed, maxMemoryInMB=1024)
    m = est.grown(held) or est.on_spark(d)
    held.unpersist()
    return m


def fit_gbt_classifier(df, feats, label, n_trees: int = 100, depth: int = 6, lr: float = 0.1,
                       subsample: float = 1.0, seed: int = 42):
    return _grown(BoostedClassifier(featuresCol="features", labelCol=label, maxIter=n_trees, maxDepth=depth, stepSize=lr,
                                    subsamplingRate=subsample, seed=seed), _vectors(df, feats, label))


def fit_mlp_classifier(df, feats, label, hidden=(127, 64, 32), max_iter: int = 100, seed: int = 42):
    held, d = _rows(df, feats, label)
    layers = [len(feats), *hidden, 2]
    m = MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=layers,
                                       maxIter=max_iter, seed=seed).fit(d)
    held.unpersist()
    return m


def _values(df: DataFrame, col: str) -> list[int]:
    """The values of a fold or size column, in order."""
    return sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def cross_validate(fit_fn, score_fn, df: DataFrame, fold_col: str):
    """Train and validation scores (``score_fn(pred_df) -> dict``) of every
    fold of the frame as a long table ``(fold, part, metric, value)``;
    aggregate it with ``summarize_folds``."""
    spark = df.sparkSession
    rows = []
    for fold in _values(df, fold_col):
        tr, va = df.where(F.col(fold_col) != fold), df.where(F.col(fold_col) == fold)
        m = fit_fn(tr)
        for part, d in (("train", tr), ("validation", va)):
            for metric, v in score_fn(m, d).items():
                rows.append((fold, part, metric, float(v)))
    return spark.createDataFrame(rows, "fold int, part string, metric string, value double")


def summarize_folds(folds: DataFrame, digits: int = 6) -> DataFrame:
    """mean, population std (numpy's default), min, max per part and metric."""
    return folds.groupBy("part", "metric").agg(
        F.round(F.avg("value"), digits).alias("mean"), F.round(F.stddev_pop("value"), digits).alias("std"),
        F.round(F.min("value"), digits).alias("min"), F.round(F.max("value"), digits).alias("max"))


def draw_param_maps(estimator, space: dict, n: int, seed: int = 42) -> list[dict]:
    """n seeded draws: each parameter is a list (uniform choice) or a
    ``(lo, hi)`` float range; draws come from the md5 rule like every other
    random choice here."""
    import hashlib
    maps = []
    for i in range(n):
        pm = {}
        for name, dom in space.items():
            h = int(hashlib.md5(f"{i}|{name}|{seed}".encode()).hexdigest()[:8], 16) / 4294967296.0
            param = estimator.getParam(name)
            if isinstance(dom, tuple):
                pm[param] = dom[0] + (dom[1] - dom[0]) * h
            else:
                pm[param] = dom[int(h * len(dom))]
        maps.append(pm)
    return maps


def tune(estimator, param_maps: list, evaluator, df: DataFrame, fold_col: str, parallelism: int = 4):
    """``CrossValidator`` with a precomputed fold column; returns the fitted
    CV model and a table of (draw, params, mean metric)."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=param_maps, evaluator=evaluator,
                        foldCol=fold_col, numFolds=_values(df, fold_col)[-1] + 1, parallelism=parallelism)
    model = cv.fit(df)
    spark = df.sparkSession
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)), float(m))
            for i, (pm, m) in enumerate(zip(param_maps, model.avgMetrics))]
    table = spark.createDataFrame(rows, "draw int, params string, metric double")
    return model, table


def few_tasks(df: DataFrame, rows_per_task: int = 50_000) -> DataFrame:
    """A table read by no more tasks than its rows need: boosting reads it a
    thousand times, and each read costs every task its start.  Beyond
    ``rows_per_task`` the rows are dealt evenly over the cores that are there, and
    over more tasks only when one would read over ``TASK_ROWS`` rows."""
    rows = df.count()
    wanted = max(1, -(-rows // rows_per_task))
    if wanted == 1:
        return df.coalesce(1)
    return df.repartition(max(min(df.sparkSession.sparkContext.defaultParallelism, wanted), -(-rows // TASK_ROWS)))


def tune_boosted(estimator, param_maps: list, df: DataFrame, fold_col: str, parallelism: int = 8):
    """Mean validation RMSE over the folds of every parameter map of a boosted
    regressor.  Maps that differ in ``maxIter`` alone share one fit per fold:
    the first trees of a longer fit are the shorter one, so its error after
    every number of trees is all that is needed.  Fits do not depend on each
    other, and ``parallelism`` of them run at once.  Returns the table (draw,
    params, metric) and the best map as ``{name: value}``."""
    rounds = estimator.getParam("maxIter")
    shared: dict[tuple, int] = {}
    keys = []
    for pm in param_maps:
        key = tuple(sorted(((p.name, v) for p, v in pm.items() if p != rounds)))
        keys.append(key)
        shared[key] = max(shared.get(key, 0), pm.get(rounds, estimator.getMaxIter()))
    folds = _values(df, fold_col)
    parts = {f: (df.where(F.col(fold_col) != f), df.where(F.col(fold_col) == f)) for f in folds}
    grown = {f: fold_errors(estimator, *parts[f]) for f in folds}
    if not all(grown.values()):
        df = few_tasks(df)
        parts = {f: (_persisted(df.where(F.col(fold_col) != f)), _persisted(df.where(F.col(fold_col) == f))) for f in folds}

    def errors(job):
        key, fold = job
        one = estimator.copy({**{estimator.getParam(n): v for n, v in key}, rounds: shared[key]})
        if grown[fold]:
            return grown[fold](one)
        train, held = parts[fold]
        return [e ** 0.5 for e in one.fit(train).evaluateEachIteration(held, "squared")]
    jobs = sorted(((k, f) for k in shared for f in folds), key=lambda job: -shared[job[0]])  # the longest first
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        found = dict(zip(jobs, pool.map(inheritable_thread_target(df.sparkSession)(errors), jobs)))
    for pair in parts.values():
        for part in pair:
            part.unpersist()
    rows = []
    for i, (pm, key) in enumerate(zip(param_maps, keys)):
        n = pm.get(rounds, estimator.getMaxIter())
        rows.append((i, ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name)),
                     sum(found[(key, f)][n - 1] for f in folds) / len(folds)))
    best = param_maps[min(rows, key=lambda r: r[2])[0]]
    return (df.sparkSession.createDataFrame(rows, "draw int, params string, metric double"),
            {p.name: v for p, v in best.items()})


def random_search(estimator, space: dict, n: int, evaluator, df, fold_col, seed: int = 42, parallelism: int = 4):
    return tune(estimator, draw_param_maps(estimator, space, n, seed), evaluator, df, fold_col, parallelism)


def best_params(model, evaluator) -> dict:
    """``{name: value}`` of the best draw of a fitted search."""
    pick = max if evaluator.isLargerBetter() else min
    at = model.avgMetrics.index(pick(model.avgMetrics))
    return {p.name: v for p, v in model.getEstimatorParamMaps()[at].items()}


def refine_grid(estimator, best: dict, steps: dict, valid=None, factors: dict | None = None) -> list:
    """Neighbourhood grid around the best values: ``steps = {name: [deltas]}``,
    ``factors = {name: [multipliers]}``; the other best values stay as they
    are; values failing ``valid(name, value)`` are dropped."""
    b = ParamGridBuilder()
    near = {n: {type(best[n])(best[n] + d) for d in deltas} for n, deltas in steps.items()}
    near |= {n: {type(best[n])(best[n] * f) for f in fs} for n, fs in (factors or {}).items()}
    b.baseOn({estimator.getParam(n): v for n, v in best.items() if n not in near})
    for name, vals in near.items():
        b = b.addGrid(estimator.getParam(name), [v for v in sorted(vals) if not valid or valid(name, v)])
    return b.build()


def learning_curve(fit_fn, score_fn, df: DataFrame, size_col: str, fold_col: str):
    """Train / validation score mean and std per nested training size, over
    every size and every fold of the frame."""
    spark = df.sparkSession
    rows = []
    sizes, folds = _values(df, size_col), _values(df, fold_col)
    for s in sizes:
        for fold in folds:
            tr = df.where((F.col(fold_col) != fold) & (F.col(size_col) <= s))
            va = df.where(F.col(fold_col) == fold)
            m = fit_fn(tr)
            rows.append((s, fold, "train", float(score_fn(m, tr))))
            rows.append((s, fold, "validation", float(score_fn(m, va))))
    t = spark.createDataFrame(rows, "size_index int, fold int, part string, score double")
    return t.groupBy("size_index", "part").agg(F.round(F.avg("score"), 6).alias("mean"),
                                               F.round(F.stddev_pop("score"), 6).alias("std"))


def regression_scores(model, df: DataFrame, feats: list[str], label: str) -> dict:
    p = model.transform(assemble(df, feats))
    r = p.agg(F.sqrt(F.avg((F.col("prediction") - F.col(label)) ** 2)).alias("rmse"),
              F.avg(F.abs(F.col("prediction") - F.col(label))).alias("mae"),
              (1 - F.sum((F.col("prediction") - F.col(label)) ** 2) /
               (F.count(F.lit(1)) * F.var_pop(label))).alias("r2")).first()
    return r.asDict()


def auc_evaluator(label: str):
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")


def rmse_evaluator(label: str):
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
