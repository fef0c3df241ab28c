"""Shapley values of tree ensembles (M29-M33 for boosted trees and forests).

The fitted model is turned into a table of leaves.  For each leaf and each
feature on its path it has the interval of values that stay on the path, and
the share of the training rows that do (path-dependent conditional
expectations).  For a row, a leaf's value is divided among the path's features by
Shapley's formula in closed form: with o_j = 1 where the row stays on the path at
feature j and z_j the share, feature i receives

    value * (o_i - z_i) * sum_k  k! (D - 1 - k)! / D! * [t^k] prod_{j != i} (z_j + o_j t)

over the D features of the path.  Rows with the same pattern of o share the
work.  The attributions of a row add up to its prediction minus the
model's mean over the training rows, and are the same long table (id, feature,
attr) as those of linear models, so every aggregate of ``explain`` takes them.

The table of leaves grows with the model, not with the data; rows stay
distributed and are explained batch by batch."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lathe.session import checkpoint_dir


@dataclass
class Leaves:
    """One entry a leaf: its weighted value, and (feature, low, high, share) of its
    path; a row stays on the path where low < x <= high.  ``base`` is the mean
    prediction over the training rows."""
    values: np.ndarray
    paths: list[list[tuple[int, float, float, float]]]
    base: float


def _leaf_value(node, probability: bool) -> float:
    if probability:
        stats = node["impurityStats"]
        return float(stats[1] / sum(stats)) if sum(stats) else 0.0
    return float(node["prediction"])


def leaf_table(model) -> Leaves:
    """Leaves of a fitted gradient-boosted or random-forest model (its raw score
    for a boosted classifier, the probability of class 1 for a forest)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.active()
    path = f"{checkpoint_dir(spark)}/lathe-models/explained-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # the model's own size
    weights = list(model.treeWeights)
    forest = "RandomForest" in type(model).__name__
    if forest:
        weights = [1.0 / len(weights)] * len(weights)
    probability = type(model).__name__ == "RandomForestClassificationModel"
    trees: dict[int, dict[int, object]] = {}
    for n in nodes:
        trees.setdefault(n["treeID"], {})[n["id"]] = n
    values, paths, base = [], [], 0.0
    for tree_id, tree in sorted(trees.items()):
        todo = [(0, {})]
        while todo:
            at, path_ = todo.pop()
            node = tree[at]
            if node["leftChild"] < 0:
                value = weights[tree_id] * _leaf_value(node, probability)
                steps = [(f, *box) for f, box in sorted(path_.items())]
                values.append(value)
                paths.append(steps)
                base += value * math.prod(s[3] for s in steps)
                continue
            split = node["split"]
            if split["numCategories"] > 0:
                raise ValueError("categorical splits have no interval; encode categories as numbers first")
            f, cut = split["featureIndex"], float(split["leftCategoriesOrThreshold"][0])
            low, high, share = path_.get(f, (-math.inf, math.inf, 1.0))
            for child, a, b in ((node["leftChild"], low, min(high, cut)), (node["rightChild"], max(low, cut), high)):
                part = tree[child]["rawCount"] / node["rawCount"]
                todo.append((child, {**path_, f: (a, b, share * part)}))
    return Leaves(np.array(values), paths, base)


def _shares(on: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Shapley shares (patterns x features) of a leaf of value 1."""
    d = len(z)
    weight = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
    out = np.empty(on.shape)
    for i in range(d):
        poly = np.zeros((len(on), d))
        poly[:, 0] = 1.0
        for j in range(d):
            if j != i:
                poly[:, 1:] = poly[:, 1:] * z[j] + poly[:, :-1] * on[:, j:j + 1]
                poly[:, 0] *= z[j]
        out[:, i] = (on[:, i] - z[i]) * (poly @ weight)
    return out


#: a leaf with more features on its path is worked out by the patterns of its rows
TABLE_FEATURES = 8


class Explained:
    """Leaves made ready for many batches of rows: per leaf the attributions of all
    2^D patterns of its path, and per feature of the path which of the model's
    intervals stay on it."""

    def __init__(self, leaves: Leaves, width: int):
        cuts = [{v for path in leaves.paths for s in path if s[0] == f for v in s[1:3] if math.isfinite(v)} for f in range(width)]
        self.cuts = [np.array(sorted(c)) for c in cuts]
        self.steps = []
        for value, path in zip(leaves.values, leaves.paths):
            if not path or not value:
                continue
            at, z = [s[0] for s in path], np.array([s[3] for s in path])
            bits = np.uint8 if len(at) <= TABLE_FEATURES else np.int64
            on = []
            for j, (f, low, high, _) in enumerate(path):
                cut = self.cuts[f]    # interval i is (cut[i - 1], cut[i]]; the last one is a missing value
                i = np.arange(len(cut) + 1)
                stays = (i > np.searchsorted(cut, low) if math.isfinite(low) else i >= 0) & (
                    i <= np.searchsorted(cut, high) if math.isfinite(high) else i >= 0)
                on.append(np.append(stays, False).astype(bits) << bits(j))
            table = None
            if len(at) <= TABLE_FEATURES:
                patterns = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
                table = np.ascontiguousarray((value * _shares(patterns.astype(float), z)).T)
            self.steps.append((value, at, z, on, table))

    def values(self, x: np.ndarray) -> np.ndarray:
        """Attributions (rows x features) of the rows of a matrix."""
        out = np.zeros((x.shape[1], len(x)))
        inside = [np.where(np.isnan(x[:, f]), len(cut) + 1, np.searchsorted(cut, x[:, f])) for f, cut in enumerate(self.cuts)]
        for value, at, z, on, table in self.steps:
            code = on[0].take(inside[at[0]])
            for f, bit in zip(at[1:], on[1:]):
                code |= bit.take(inside[f])
            if table is None:
                patterns, which = np.unique(code, return_inverse=True)
                table = value * _shares(((patterns[:, None] >> np.arange(len(at))) & 1).astype(float), z).T
                code = which
            code = code.astype(np.intp)
            for f, shares in zip(at, table):
                out[f] += shares.take(code)
        return out.T


def shapley_values(leaves: Leaves, x: np.ndarray) -> np.ndarray:
    """Attributions (rows x features) of the rows of a matrix."""
    return Explained(leaves, x.shape[1]).values(x)


def tree_attribution(df: DataFrame, id_col: str, feats: list[str], leaves: Leaves) -> DataFrame:
    """Long table (id, feature, attr) of every row of ``df``."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        explained = Explained(leaves, len(feats))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:]])
            values = explained.values(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), len(feats)))),
                 pa.array(feats * len(x)), pa.array(values.ravel())], names=[id_col, "feature", "attr"])
    narrow = df.select(F.col(id_col), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(feats)])
    return narrow.mapInArrow(run, f"`{id_col}` {kind}, feature string, attr double")
