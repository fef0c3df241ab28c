"""Fitted steps as Spark ML ``Estimator`` / ``Model`` pairs with writable state
(M36), so that one ``PipelineModel`` holds imputer, encoders, scaler and
predictor, is saved as a whole, and scores raw rows after it is read again.

State of bounded size (a number per column, the categories of a column within
the routing limit) is kept as params, in the model's JSON metadata; frequency
dictionaries, which grow with the data, are a Parquet table beside it and are
joined at scoring.  Fits of the predictors are those of ``operators.models``."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCols, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, functions as F

from lathe.functions.text import safe_names
from lathe.operators import encode, profile, scale
from lathe.operators.evaluate import balanced_weights
from lathe.operators.joins import map_encode_join
from lathe.operators.models import spread_rows
from lathe.operators.trees import ForestClassifier


def _param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc)


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """Saved as JSON metadata: everything the stage knows is a param."""


# -- imputing and scaling ----------------------------------------------------

class MedianImputer(Estimator, HasInputCols, _Saved):
    """Exact train medians; ``flags`` names a 0/1 column "was present" for each
    input column that gets one."""
    flags = _param("flags", "{column: name of its presence flag}")

    def __init__(self, inputCols=None, flags=None):
        super().__init__()
        self._setDefault(flags={})
        if inputCols is not None:
            self._set(inputCols=list(inputCols), flags=dict(flags or {}))

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        medians = encode.fit_medians(dataset, self.getInputCols())
        return MedianImputerModel(self.getInputCols(), self.getOrDefault("flags"), medians)


class MedianImputerModel(Model, HasInputCols, _Saved):
    flags = MedianImputer.flags
    medians = _param("medians", "{column: train median}")

    def __init__(self, inputCols=None, flags=None, medians=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols), flags=dict(flags), medians=dict(medians))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        flags, medians, cols = self.getOrDefault("flags"), self.getOrDefault("medians"), self.getInputCols()
        flagged = encode.missing_flags(dataset, list(flags), flags)
        return flagged.select(*[F.coalesce(F.col(c), F.lit(medians.get(c))).alias(c) if c in cols else F.col(c)
                                for c in flagged.columns])


class PopulationScaler(Estimator, HasInputCols, _Saved):
    """(x - mean) / population std of the train rows; constant columns are only centred."""

    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        fitted = scale.fit_standard_scaler(dataset, self.getInputCols()).collect()  # a row a column
        return PopulationScalerModel(self.getInputCols(), {r["feature"]: [r["mean"], r["std"]] for r in fitted})


class PopulationScalerModel(Model, HasInputCols, _Saved):
    moments = _param("moments", "{column: [mean, std]}")

    def __init__(self, inputCols=None, moments=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols), moments=dict(moments))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return scale.apply_scaler(dataset, self.getOrDefault("moments"))


# -- categories --------------------------------------------------------------

class CategoryEncoder(Estimator, HasInputCols, _Saved):
    """Encodes each string column by its number of distinct train values (NULL is
    one): up to ``mid`` -> ``<column>_ordinal`` (position by frequency, ties by
    value, unseen -1); up to ``high`` -> 0/1 columns of the ``topK`` most
    frequent values and ``<column>_other``; more -> ``<column>_freq`` (train
    count, unseen 0); one value -> dropped.  Distinct values are counted only
    as far as ``high``."""
    mid = _param("mid", "most values of an ordinal column")
    high = _param("high", "most values of a one-hot column")
    topK = _param("topK", "values with a 0/1 column of their own")

    def __init__(self, inputCols=None, mid=10, high=30, topK=10):
        super().__init__()
        self._setDefault(mid=10, high=30, topK=10)
        if inputCols is not None:
            self._set(inputCols=list(inputCols), mid=mid, high=high, topK=topK)

    def _fit(self, dataset: DataFrame) -> CategoryEncoderModel:
        cols, mid, high = self.getInputCols(), self.getOrDefault("mid"), self.getOrDefault("high")
        seen = profile.distinct_up_to(dataset, cols, high + 1)
        routes, values, counted = {}, {}, None
        for c in cols:
            routes[c] = ("drop" if seen[c] < 2 else "ordinal" if seen[c] <= mid else
                         "one_hot" if seen[c] <= high else "frequency")
            if routes[c] in ("ordinal", "one_hot"):
                values[c] = encode.fit_top_k(dataset, c, mid if routes[c] == "ordinal" else self.getOrDefault("topK"))
            elif routes[c] == "frequency":
                part = encode.fit_frequency(dataset, c).select(F.lit(c).alias("column"), F.col("key").cast("string"), "value")
                counted = part if counted is None else counted.unionByName(part)
        if counted is None:
            counted = dataset.sparkSession.createDataFrame([], CategoryEncoderModel.SCHEMA)
        return CategoryEncoderModel(cols, routes, values, counted)


class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.frequencies.write.parquet(f"{path}/frequencies")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls()
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        instance.frequencies = self.sparkSession.read.parquet(f"{path}/frequencies")
        return instance


class CategoryEncoderModel(Model, HasInputCols, MLReadable, MLWritable):
    SCHEMA = "column string, key string, value double"
    routes = _param("routes", "{column: drop, ordinal, one_hot or frequency}")
    values = _param("values", "{column: its values, most frequent first}")

    def __init__(self, inputCols=None, routes=None, values=None, frequencies: DataFrame | None = None):
        super().__init__()
        self.frequencies = frequencies
        if inputCols is not None:
            self._set(inputCols=list(inputCols), routes=dict(routes), values=dict(values))

    def output_columns(self) -> list[str]:
        out = []
        for c, route in self.getOrDefault("routes").items():
            if route == "ordinal":
                out.append(f"{c}_ordinal")
            elif route == "one_hot":
                known = [v for v in self.getOrDefault("values")[c] if v is not None]
                out += [f"{c}_{n}" for n in safe_names(known, 50)] + [f"{c}_other"]
            elif route == "frequency":
                out.append(f"{c}_freq")
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c, route in self.getOrDefault("routes").items():
            values = self.getOrDefault("values").get(c, [])
            known = [v for v in values if v is not None]
            if route == "ordinal":
                code = F.lit(-1)
                for i, v in enumerate(values):
                    code = F.when(F.col(c).eqNullSafe(F.lit(v)), F.lit(i)).otherwise(code)
                out = out.withColumn(f"{c}_ordinal", code)
            elif route == "one_hot":
                flags = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{n}")
                         for v, n in zip(known, safe_names(known, 50))]
                top = F.coalesce(F.col(c).isin(known), F.lit(False)) | (F.col(c).isNull() & F.lit(None in values))
                out = out.select("*", *flags, (~top).cast("int").alias(f"{c}_other"))
            elif route == "frequency":
                # columns are read by name through F.col, so the model's table never clashes
                mine = self.frequencies.where(F.col("column") == c).select("key", "value")
                out = map_encode_join(out, c, mine, f"{c}_freq", default=0.0)
        return out

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


# -- predictors ----------------------------------------------------------------

class RidgeRegression(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, _Saved):
    """min ||y - Xw - b||^2 + alpha ||w||^2, as a Spark ``LinearRegressionModel``."""
    alpha = _param("alpha", "penalty of the squared coefficients")

    def __init__(self, labelCol="label", alpha=1.0, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(labelCol=labelCol, alpha=alpha, featuresCol=featuresCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame):
        y = self.getLabelCol()
        st = dataset.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(y).alias("s")).first()
        reg = self.getOrDefault("alpha") * (st["s"] or 0.0) / max(st["n"], 1)
        return LinearRegression(featuresCol=self.getFeaturesCol(), labelCol=y, predictionCol=self.getPredictionCol(),
                                regParam=reg, elasticNetParam=0.0, standardization=False, solver="normal").fit(dataset)


class BalancedLogistic(Estimator, HasFeaturesCol, HasLabelCol, _Saved):
    """Logistic regression with class weights n / (classes * n_c) and an L2
    penalty of 1 / (2 n), as a Spark ``LogisticRegressionModel``."""
    maxIter = _param("maxIter", "iterations")

    def __init__(self, labelCol="label", maxIter=1000, featuresCol="features"):
        super().__init__()
        self._set(labelCol=labelCol, maxIter=maxIter, featuresCol=featuresCol)

    def _fit(self, dataset: DataFrame):
        rows = balanced_weights(dataset, self.getLabelCol(), "_weight")
        return LogisticRegression(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), weightCol="_weight",
                                  regParam=1.0 / max(dataset.count(), 1), elasticNetParam=0.0, standardization=False,
                                  maxIter=self.getOrDefault("maxIter")).fit(rows)


class BalancedForest(Estimator, HasFeaturesCol, HasLabelCol, HasSeed, _Saved):
    """Random forest with class weights n / (classes * n_c), as a Spark
    ``RandomForestClassificationModel``."""
    numTrees = _param("numTrees", "trees")
    maxDepth = _param("maxDepth", "depth")
    minLeaf = _param("minLeaf", "rows of a leaf at least")

    def __init__(self, labelCol="label", numTrees=200, maxDepth=15, minLeaf=5, seed=42, featuresCol="features"):
        super().__init__()
        self._set(labelCol=labelCol, numTrees=numTrees, maxDepth=maxDepth, minLeaf=minLeaf, seed=seed,
                  featuresCol=featuresCol)

    def _fit(self, dataset: DataFrame):
        rows = balanced_weights(dataset, self.getLabelCol(), "_weight")
        est = ForestClassifier(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), weightCol="_weight",
            numTrees=self.getOrDefault("numTrees"), maxDepth=self.getOrDefault("maxDepth"),
            minInstancesPerNode=self.getOrDefault("minLeaf"), featureSubsetStrategy="sqrt", seed=self.getSeed(),
            maxMemoryInMB=1024)
        forest = est.grown(rows)
        return forest.to_spark() if forest else est.on_spark(spread_rows(rows))


class StackingRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Bases predict each fold from the other folds; the meta regressor learns
    from these predictions (and, with ``passthrough``, the features); bases
    are then fitted on all rows.  The fits do not depend on each other, and up
    to ``parallelism`` run at once."""

    def __init__(self, bases: list, meta: Estimator, foldCol: str, labelCol="label", featuresCol="features",
                 predictionCol="prediction", passthrough: bool = True, parallelism: int = 4):
        super().__init__()
        self._set(labelCol=labelCol, featuresCol=featuresCol, predictionCol=predictionCol)
        self.bases, self.meta, self.fold_col = list(bases), meta, foldCol
        self.passthrough, self.parallelism = passthrough, parallelism

    def _fit(self, dataset: DataFrame) -> StackingRegressorModel:
        x, y, fold = self.getFeaturesCol(), self.getLabelCol(), F.col(self.fold_col)
        folds = sorted(r[0] for r in dataset.select(self.fold_col).distinct().collect())
        session = dataset.sparkSession
        jobs = [(base, dataset.where(fold != f)) for f in folds for base in self.bases]
        jobs += [(base, dataset) for base in self.bases]
        with ThreadPoolExecutor(max(1, self.parallelism)) as pool:
            fitted = list(pool.map(inheritable_thread_target(session)(lambda job: job[0].fit(job[1])), jobs))
        n = len(self.bases)
        names = [f"_base_{i}" for i in range(n)]
        guesses = None
        for k, f in enumerate(folds):
            part = dataset.where(fold == f).select(x, y)
            for name, model in zip(names, fitted[k * n:(k + 1) * n]):
                part = _predict(model, part, x, name)
            guesses = part if guesses is None else guesses.unionByName(part)
        held = VectorAssembler(inputCols=[*names, *([x] if self.passthrough else [])], outputCol="_meta")
        meta = self.meta.copy()
        meta._set(featuresCol="_meta", labelCol=y, predictionCol=self.getPredictionCol())
        model = StackingRegressorModel(fitted[len(folds) * n:], meta.fit(held.transform(guesses).drop(x)))
        return model._set(featuresCol=x, predictionCol=self.getPredictionCol(), passthrough=self.passthrough)


def _predict(model, df: DataFrame, features: str, out: str) -> DataFrame:
    return model.copy().setFeaturesCol(features).setPredictionCol(out).transform(df)


class _StackingWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"bases": len(self.instance.bases)})
        for i, base in enumerate(self.instance.bases):
            base.write().save(f"{path}/base-{i}")
        self.instance.meta.write().save(f"{path}/meta")


class _StackingReader(MLReader):
    def load(self, path: str) -> StackingRegressorModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        bases = [DefaultParamsReader.loadParamsInstance(f"{path}/base-{i}", self.sparkSession)
                 for i in range(metadata["bases"])]
        instance = StackingRegressorModel(bases, DefaultParamsReader.loadParamsInstance(f"{path}/meta", self.sparkSession))
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance


class StackingRegressorModel(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    passthrough = _param("passthrough", "whether the meta regressor sees the features")

    def __init__(self, bases=None, meta=None):
        super().__init__()
        self.bases, self.meta = bases, meta

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x, out = self.getFeaturesCol(), dataset
        names = [f"_base_{i}" for i in range(len(self.bases))]
        for name, base in zip(names, self.bases):
            out = _predict(base, out, x, name)
        held = VectorAssembler(inputCols=[*names, *([x] if self.getOrDefault("passthrough") else [])], outputCol="_meta")
        return _predict(self.meta, held.transform(out), "_meta", self.getPredictionCol()).drop("_meta", *names)

    def write(self) -> MLWriter:
        return _StackingWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StackingReader()
