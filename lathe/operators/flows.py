"""End-to-end flows (M36): a feature pipeline fitted on the train rows, several
predictors on top of it, each saved as one ``PipelineModel`` that scores raw rows,
and their metrics in one JSON file."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from lathe.operators import stages
from lathe.operators.models import few_tasks
from lathe.session import stage_table
from lathe.sources import files


def fit_features(train: DataFrame, before: list[Transformer], impute: list[str], flags: dict[str, str],
                 after: list[Transformer], categories: list[str], numbers: list[str]) -> tuple[PipelineModel, list[str]]:
    """Row-wise steps, median imputing, more row-wise steps, category encoding
    and population scaling as one fitted pipeline ending in the column
    ``features``, and the names of its features in order."""
    front = list(before)
    rows = PipelineModel(front).transform(train)
    imputer = stages.MedianImputer(impute, flags).fit(rows)
    front += [imputer, *after]
    rows = PipelineModel([imputer, *after]).transform(rows)
    encoder = stages.CategoryEncoder(categories).fit(rows)
    front.append(encoder)
    names = [*numbers, *encoder.output_columns()]
    scaler = stages.PopulationScaler(names).fit(encoder.transform(rows))
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
    return PipelineModel([*front, scaler, assembler]), names


def fit_rows(df: DataFrame, keep: list[str], rows_per_task: int = 50_000) -> DataFrame:
    """The rows of a fit, staged once.  Iterative fits read them hundreds of
    times, so they are read by few tasks (``models.few_tasks``)."""
    return few_tasks(stage_table(df.select("features", *keep), "fit-rows"), rows_per_task)


def fit_and_save(features: PipelineModel, rows: DataFrame, predictors: dict, path: str,
                 parallelism: int = 3) -> dict[str, PipelineModel]:
    """Fits every predictor on the prepared rows, ``parallelism`` at once, saves
    ``<path>/<name>`` as features + predictor, and returns the models as read
    back from there."""
    def one(item):
        name, predictor = item
        whole = PipelineModel([*features.stages, predictor.fit(rows)])
        whole.write().overwrite().save(f"{path}/{name}")
        return name, PipelineModel.load(f"{path}/{name}")
    held = rows.persist()
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        out = dict(pool.map(inheritable_thread_target(rows.sparkSession)(one), predictors.items()))
    held.unpersist()
    return out


def score_all(models: dict[str, PipelineModel], raw: DataFrame, metrics, path: str) -> DataFrame:
    """``metrics(scored rows, name)`` of every model over the raw rows, written as
    ``<path>/metrics.json`` and read back."""
    out = None
    for name, model in models.items():
        one = metrics(model.transform(raw), name)
        out = one if out is None else out.unionByName(one)
    files.write_metrics(out, f"{path}/metrics.json")
    return raw.sparkSession.read.schema(out.schema).json(f"{path}/metrics.json")
