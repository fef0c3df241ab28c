"""Ridge and least-squares fits from Gram blocks.

A ridge fit needs of its rows only n, the sums of the features and the label
and their products.  One pass over the data adds these up for every cell of
a partitioning (fold, or fold and training size); tasks send one matrix a cell,
whatever their number of rows.  Any training set that is a union of cells is
then the sum of its blocks, and its fit a d x d system that the driver
solves.  Squared errors of a fit on any union of cells follow from the same
blocks; only absolute errors need a second pass, which scores all fits at
once.

Rows are shifted by one row of the data before their products are taken, so
that large means do not cancel digits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F


@dataclass
class GramBlocks:
    """``blocks[cell]``: the Gram matrix of (1, features, label) over the rows of
    a cell, all shifted by ``shift``; a cell is a tuple of its columns' values."""
    feats: list[str]
    shift: np.ndarray
    blocks: dict[tuple, np.ndarray]

    def total(self, chosen=lambda cell: True) -> np.ndarray:
        """The block of the union of the chosen cells."""
        d = len(self.feats) + 2
        return sum((b for c, b in self.blocks.items() if chosen(c)), np.zeros((d, d)))


def _matrix(batch, feats: list[str], label: str, shift: np.ndarray) -> np.ndarray:
    columns = [batch.column(c) for c in (*feats, label)]
    if any(c.null_count for c in columns):
        raise ValueError("null in a feature or label; impute or drop it before the fit")
    rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns])
    return np.column_stack([np.ones(len(rows)), rows - shift])


def _partial_blocks(feats, label, cells, shift):
    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            z = _matrix(batch, feats, label, shift)
            keys = list(zip(*[batch.column(f"_c{i}").to_pylist() for i in range(len(cells))])) or [()] * len(z)
            ids: dict[tuple, int] = {}
            code = np.fromiter((ids.setdefault(k, len(ids)) for k in keys), np.int64, len(keys))
            for cell, i in ids.items():
                part = z[code == i]
                held[cell] = held.get(cell, 0) + part.T @ part
        for cell, block in held.items():
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([v] * len(block), pa.int64()) for v in cell], pa.array(range(len(block)), pa.int32()),
                 pa.array(block.tolist(), pa.list_(pa.float64()))],
                names=[*[f"_c{i}" for i in range(len(cells))], "_row", "_values"])
    return run


def _narrow(df: DataFrame, feats: list[str], label: str, cells: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(f"_c{i}") for i, c in enumerate(cells)],
                     *[F.col(c).cast("double").alias(c) for c in (*feats, label)])


def gram_blocks(df: DataFrame, feats: list[str], label: str, cells: list[str] | None = None) -> GramBlocks:
    """One pass: a block for every combination of the integer columns ``cells``
    (a bounded number: folds, sizes).  Partial blocks are summed in Spark,
    row by row of the matrix."""
    cells = list(cells or [])
    narrow = _narrow(df, feats, label, cells)
    first = narrow.select(*feats, label).first()
    if first is None:
        return GramBlocks(list(feats), np.zeros(len(feats) + 1), {})
    shift = np.array([0.0 if v is None else float(v) for v in first])
    names = [f"_c{i}" for i in range(len(cells))]
    schema = ", ".join([f"{c} long" for c in names] + ["_row int", "_values array<double>"])
    partial = narrow.mapInArrow(_partial_blocks(list(feats), label, cells, shift), schema)
    summed = (partial.groupBy(*names, "_row").agg(Summarizer.sum(array_to_vector("_values")).alias("_s"))
              .select(*names, "_row", vector_to_array("_s").alias("_s")).collect())  # cells x (d + 2) rows
    blocks: dict[tuple, np.ndarray] = {}
    for r in summed:
        block = blocks.setdefault(tuple(r[c] for c in names), np.zeros((len(feats) + 2, len(feats) + 2)))
        block[r["_row"]] = r["_s"]
    return GramBlocks(list(feats), shift, blocks)


@dataclass
class LinearFit:
    coefficients: np.ndarray
    intercept: float
    n: int


def solve_ridge(blocks: GramBlocks, block: np.ndarray, alpha: float = 1.0) -> LinearFit:
    """The minimum of ||y - Xw - b||^2 + alpha ||w||^2 over a block's rows; with
    ``alpha`` 0 and dependent features, the least squares fit of least norm."""
    n = block[0, 0]
    if n == 0:
        raise ValueError("no rows to fit")
    mean = block[0, 1:] / n
    centred = block[1:, 1:] - n * np.outer(mean, mean)
    xx, xy = centred[:-1, :-1], centred[:-1, -1]
    if alpha:
        w = np.linalg.solve(xx + alpha * np.eye(len(xx)), xy)
    else:
        w = np.linalg.lstsq(xx, xy, rcond=1e-12)[0]
    centre = mean + blocks.shift
    return LinearFit(w, float(centre[-1] - w @ centre[:-1]), int(round(n)))


def squared_scores(blocks: GramBlocks, fit: LinearFit, block: np.ndarray) -> dict[str, float]:
    """rmse and r2 of a fit on the rows of a block, without reading them."""
    n = block[0, 0]
    if n == 0:
        return {"rmse": float("nan"), "r2": float("nan")}
    # residual of a shifted row (1, x, y): y - w.x - (b + w.shift - shift of y)
    v = np.concatenate([[-(fit.intercept + fit.coefficients @ blocks.shift[:-1] - blocks.shift[-1])],
                        -fit.coefficients, [1.0]])
    sse = max(float(v @ block @ v), 0.0)
    spread = float(block[-1, -1] - block[0, -1] ** 2 / n)
    return {"rmse": (sse / n) ** 0.5, "r2": 1 - sse / spread if spread > 0 else float("nan")}


def absolute_errors(df: DataFrame, feats: list[str], label: str, cells: list[str], fits: list[LinearFit]) -> DataFrame:
    """(cells..., fit, n, abs_sum): the sums of absolute residuals of every fit
    over every cell, from one pass over the rows."""
    w = np.column_stack([f.coefficients for f in fits])
    b = np.array([f.intercept for f in fits])
    names = [f"_c{i}" for i in range(len(cells))]

    def run(batches):
        for batch in batches:
            z = _matrix(batch, list(feats), label, np.zeros(len(feats) + 1))[:, 1:]
            error = np.abs(z[:, -1:] - z[:, :-1] @ w - b)
            keys = list(zip(*[batch.column(c).to_pylist() for c in names])) or [()] * len(z)
            ids: dict[tuple, int] = {}
            code = np.fromiter((ids.setdefault(k, len(ids)) for k in keys), np.int64, len(keys))
            rows = [(*cell, j, int((code == i).sum()), float(s))
                    for cell, i in ids.items() for j, s in enumerate(error[code == i].sum(axis=0))]
            if rows:
                kinds = [pa.int64()] * len(cells) + [pa.int32(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows), kinds)],
                                                 names=[*names, "fit", "n", "abs_sum"])
    schema = ", ".join([f"{c} long" for c in names] + ["fit int, n long, abs_sum double"])
    sums = _narrow(df, feats, label, cells).mapInArrow(run, schema).groupBy(*names, "fit").agg(
        F.sum("n").alias("n"), F.sum("abs_sum").alias("abs_sum"))
    return sums.select(*[F.col(n).alias(c) for n, c in zip(names, cells)], "fit", "n", "abs_sum")


def cross_validate_ridge(df: DataFrame, feats: list[str], label: str, fold_col: str, alpha: float = 1.0) -> DataFrame:
    """Train and validation rmse, mae and r2 of every fold: (fold, part, metric,
    value), as ``models.cross_validate`` gives them for a ridge fit."""
    g = gram_blocks(df, feats, label, [fold_col])
    folds = sorted(c[0] for c in g.blocks)
    fits = [solve_ridge(g, g.total(lambda c: c[0] != f), alpha) for f in folds]
    rows = []
    if folds:
        error = {(r[fold_col], r["fit"]): (r["n"], r["abs_sum"])
                 for r in absolute_errors(df, feats, label, [fold_col], fits).collect()}  # folds squared
    for i, fold in enumerate(folds):
        for part, inside in (("train", lambda f: f != fold), ("validation", lambda f: f == fold)):
            scores = squared_scores(g, fits[i], g.total(lambda c: inside(c[0])))
            held = [error[(f, i)] for f in folds if inside(f)]
            scores["mae"] = sum(s for _, s in held) / sum(n for n, _ in held) if held else float("nan")
            rows += [(fold, part, metric, float(v)) for metric, v in scores.items()]
    return df.sparkSession.createDataFrame(rows, "fold int, part string, metric string, value double")


def learning_curve_ridge(df: DataFrame, feats: list[str], label: str, size_col: str, fold_col: str,
                         alpha: float = 1.0) -> DataFrame:
    """Mean and population std over the folds of the train and validation r2
    for every nested training size, all fits from one pass.  Rows without a
    size belong to no training set, but are validated."""
    g = gram_blocks(df, feats, label, [size_col, fold_col])
    sizes = sorted({c[0] for c in g.blocks if c[0] is not None})
    folds = sorted({c[1] for c in g.blocks})
    rows = []
    for size in sizes:
        for fold in folds:
            train = g.total(lambda c: c[1] != fold and c[0] is not None and c[0] <= size)
            fit = solve_ridge(g, train, alpha)
            rows.append((size, fold, "train", squared_scores(g, fit, train)["r2"]))
            rows.append((size, fold, "validation", squared_scores(g, fit, g.total(lambda c: c[1] == fold))["r2"]))
    t = df.sparkSession.createDataFrame(rows, "size_index int, fold int, part string, score double")
    return t.groupBy("size_index", "part").agg(F.round(F.avg("score"), 6).alias("mean"),
                                               F.round(F.stddev_pop("score"), 6).alias("std"))
